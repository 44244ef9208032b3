"""Models, samplers and the whole pipeline against plain computations; skew, clashes, long texts."""

import hashlib
import math
import random
import time
import zlib
from fractions import Fraction
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline

from textward.llm import bpe, common, divergence, lines, minhash, mixing, quality, queries, substrings
from textward.sources.store import materialize


def shared_words(t):
    words = t.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    a, b = shared_words(a), shared_words(b)
    return bool(a and b) and 5 * len(a & b) >= 4 * len(a | b)


def cut_chunks(text):
    """Line chunks as ``(start, lines)`` by the rule of ``lines``."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    parts = text.split("\n")
    hashes = [md5(p) for p in parts]
    between = [md5(a + b) for a, b in zip(hashes, hashes[1:])]
    inner = range(2, len(parts) - 1)
    starts = [0] + [i for i in inner if between[i - 2] > between[i - 1] <= between[i]]
    return [(a, parts[a:b]) for a, b in zip(starts, starts[1:] + [len(parts)])]


def without_repeats(texts):
    """Line dedup of ``{id: text}``."""
    seen, out = set(), {}
    for key in sorted(texts):
        kept = []
        for _, chunk in cut_chunks(texts[key]):
            if len(chunk) < 2 or tuple(chunk) not in seen:
                kept += chunk
            if len(chunk) >= 2:
                seen.add(tuple(chunk))
        out[key] = "\n".join(kept)
    return out


def discriminant(stats, labels, shrinkage=0.01):
    """Scores of all rows of ``stats`` from the rows with a label (else None), in plain NumPy."""
    stats = np.array(stats, float)
    known = np.array([y is not None for y in labels])
    y = np.array([y for y in labels if y is not None])
    at = quality.STATISTICS.index
    sums = stats[known].sum(axis=0)
    share = lambda x, of: sums[at(x)] / max(sums[at(of)], 1.0)
    col = lambda x: stats[:, at(x)]
    x = [np.sqrt((col(a) + w * share(a, of)) / (col(of) + w)) for a, of, w in quality._RATES]
    words = col("words")
    x += [
        np.log1p(words + 20),
        np.log((col("bytes") + 20 * share("bytes", "words")) / (words + 20)),
        np.log((col("distinct") + 20) / (words + 20)),
        np.log((words + 4 * share("words", "lines")) / (col("lines") + 4)),
    ]
    x = np.stack(x, axis=1)
    parts = [x[known][y == k] for k in (0, 1)]
    scale = np.sqrt(np.maximum(sum(len(p) * p.var(axis=0) for p in parts) / len(y), 1e-12))
    odds = []
    for p in parts:
        z = (x - p.mean(axis=0)) / scale
        c = np.cov(p / scale, rowvar=False, bias=True)
        c = (1 - shrinkage) * c + shrinkage * np.trace(c) / len(c) * np.eye(len(c))
        far = np.einsum("ni,ij,nj->n", z, np.linalg.inv(c), z)
        odds.append(np.log(len(p) / len(y)) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * far)
    return 1 / (1 + np.exp(odds[0] - odds[1]))


def test_discriminant_as_in_numpy(rows):
    r = random.Random(4)
    texts = [
        " ".join(r.choices(["the", "and", "Of", "word", "x1", "!!", "a\nb"], k=r.randint(3, 60)))
        if i % 3
        else " ".join(r.choices(["AAA", "9 9", "##", "zz"], k=r.randint(3, 60)))
        for i in range(300)
    ] + ["", "word"]
    labels = [None if i % 7 == 0 else int(bool(i % 3)) ^ (i % 11 == 0) for i in range(len(texts))]
    docs = rows(list(zip(range(len(texts)), texts, labels)), "id int, text string, y int")
    stats = materialize(docs.select("id", "y", quality.statistics(F.col("text")).alias("s")))
    model = quality.fit(stats, stats_col="s", label_col="y")
    got = stats.select("id", quality.score(F.col("s"), model).alias("p")).orderBy("id").collect()
    want = discriminant([quality.count_statistics(t) for t in texts], labels)
    assert np.allclose([g.p for g in got], want, atol=1e-6)


@pytest.mark.parametrize("white, both, drawn", [(3, 10, 4), (50, 120, 60), (7, 7, 3), (900, 1000, 2)])
def test_sampler_has_its_distribution(spark, white, both, drawn):
    n = 4000
    draw = mixing._hypergeometric("white", "balls", "drawn", "place")
    got = (
        spark.range(n)
        .selectExpr(
            f"{white}L AS white", f"{both}L AS balls", f"{drawn}L AS drawn", f"(id + 0.5D) / {n} AS place"
        )
        .selectExpr(f"{draw} AS k")
        .groupBy("k")
        .count()
    )
    share = {r["k"]: r["count"] / n for r in got.collect()}
    ways = lambda k: math.comb(white, k) * math.comb(both - white, drawn - k)
    for k in range(max(0, drawn - both + white), min(white, drawn) + 1):
        assert abs(share.pop(k, 0) - ways(k) / math.comb(both, drawn)) <= 2 / n
    assert not share


def test_estimates_of_union_sketches():
    r = np.random.default_rng(2)
    base = np.unique(r.integers(0, 2**63, 3000).astype(np.uint64))
    sets = [base, base[::2], np.sort(r.choice(base, 1800, replace=False))]
    sets += [np.sort(r.choice(base, n, replace=False)) for n in (100, 85)]
    sets.append(np.unique(r.integers(0, 2**63, 900).astype(np.uint64)))
    sketches = minhash._Sketches(sets)
    of = np.arange(len(sets))
    for other in sets:
        got = sketches.estimate(other, of)
        for s, e in zip(sets, got):
            exact = len(np.intersect1d(s, other)) / len(np.union1d(s, other))
            assert abs(e - exact) <= (0.16 if max(len(s), len(other)) > minhash.ESTIMATE else 1e-12)


def test_links_don_t_depend_on_the_unit():
    r = np.random.default_rng(3)
    base = np.unique(r.integers(0, 2**63, 400).astype(np.uint64))
    hubs = [np.sort(r.choice(base, n, replace=False)) for n in r.integers(300, 400, 12)]
    visitors = [np.sort(r.choice(base, n, replace=False)) for n in r.integers(300, 400, 12)]
    names = np.arange(100, 112)
    for i, v in enumerate(visitors):
        root = np.array([500 + i])
        whole = minhash.links_of_unit(hubs, names, [v], root, Fraction(4, 5))
        alone = [
            h
            for h in range(12)
            if minhash.links_of_unit(hubs[h : h + 1], names[h : h + 1], [v], root, Fraction(4, 5))
        ]
        assert sorted(h for _, h in whole) == alone


def test_bands_meet_at_the_threshold_and_hardly_with_a_passage():
    bands, rows = minhash.band_shape(Fraction(4, 5))
    assert (1 - 0.8**rows) ** bands <= minhash.MISS
    assert minhash.band_shape(Fraction(1, 2)) == (208, 3)
    r = np.random.default_rng(5)

    def shared(union, both):
        values = np.unique(r.integers(0, 2**63, union).astype(np.uint64))
        of = r.permutation(union)
        sets = [np.sort(values[np.r_[of[:both], part]]) for part in np.array_split(of[both:], 2)]
        keys = [set(minhash.band_keys(s, bands, rows).tolist()) for s in sets]
        return len(keys[0] & keys[1])

    near = [shared(100, 80) for _ in range(100)]
    assert min(near) > 0 and abs(np.mean(near) - bands * 0.8**rows) < 2
    assert sum(shared(300, 75) for _ in range(100)) <= 3


def test_a_quoted_passage_doesn_t_bring_all_documents_together(spark, rows, monkeypatch):
    passage = " ".join(f"p{j}" for j in range(60))
    text = lambda i: f"{passage} " + " ".join(f"w{i}x{j}" for j in range(50))
    data = [(i, text(i)) for i in range(240)] + [(1000 + i, f"{text(i)} new") for i in range(0, 240, 12)]
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "WIDE", 16)
    seen, units = [], minhash._units

    def counted(*given, **named):
        found = units(*given, **named)
        seen.append(found.count())
        return found

    monkeypatch.setattr(minhash, "_units", counted)
    made = {}
    for n in (120, 240):
        docs = materialize(rows([d for d in data if d[0] % 1000 < n], "doc_id long, text string"))
        seen.clear()
        got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs, length=2).collect()}
        assert got == {i: i % 1000 for i in got}
        made[n] = sum(seen)
    assert made[240] <= 2.5 * made[120]


def test_links_of_near_copies_grow_with_their_number(spark, rows, monkeypatch):
    r = random.Random(2)

    def copy(i, words=100):
        # Copies with three new words aren't linked with each other, but with those of two.
        new = set(r.sample(range(1, words - 1), 2 + (i % 8 > 0)))
        return " ".join(f"n{i}x{j}" if j in new else f"w{j}" for j in range(words))

    data = [(i, copy(i)) for i in range(320)]
    monkeypatch.setattr(minhash, "BLOCK", 8)
    seen, connected = [], minhash.connected

    def counted(edges):
        seen.append(edges.count())
        return connected(edges)

    monkeypatch.setattr(minhash, "connected", counted)
    made = {}
    for n in (160, 320):
        docs = materialize(rows(data[:n], "doc_id long, text string"))
        sets = {}
        for i, text in data[:n]:
            words = text.split()
            sets[i] = set(zip(words, words[1:]))
        root = {i: i for i in sets}

        def find(i, root=root):
            while root[i] != i:
                i = root[i]
            return i

        for i in sets:
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    low, high = sorted((find(i), find(j)))
                    root[high] = low
        seen.clear()
        got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs, length=2).collect()}
        assert got == {i: find(i) for i in sets}
        made[n] = sum(seen)
    assert made[320] <= 2.5 * made[160]


def test_texts_stay_in_their_buckets_and_sets_of_far_sizes_don_t_meet(spark, rows, monkeypatch):
    passage = " ".join(f"p{j}" for j in range(100))
    long = lambda i: " ".join(f"w{i}x{j}" for j in range(1000))
    data = [(0, passage), (1, f"{passage} new"), *((i, f"{passage} {long(i)}") for i in range(2, 12))]
    docs = materialize(rows(data, "doc_id long, text string"))
    seen, verified = [], minhash._verified

    def counted(units, texts, *rest):
        plan = texts.groupBy("node").count()._jdf.queryExecution().executedPlan().toString()
        seen.append((units.select("node").distinct().count(), "Exchange" in plan))
        return verified(units, texts, *rest)

    monkeypatch.setattr(minhash, "_verified", counted)
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs, length=2).collect()}
    assert got == {i: 0 if i == 1 else i for i in range(12)}
    assert not any(moved for _, moved in seen)
    # The hub is of one kind, and only documents of its kind meet it.
    assert seen[0][0] in (0, 2, 10)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("textward_")]


def test_workers_send_a_row_per_source_and_term():
    texts = [("s", "Word, word (WORD) two,Two\x85 3"), ("t", "word"), ("s", "word. Größe größe! ..."), ("u", "4 ...")]
    docs = pa.RecordBatch.from_pylist([{"lang": "l", "source": s, "text": t.encode()} for s, t in texts])
    # The next-line character is no term's end, and no lower case is made beyond ASCII.
    want = {("s", "word"): (4, 2), ("s", "two"): (1, 1), ("s", "two\x85"): (1, 1), ("s", "größe"): (2, 1), ("t", "word"): (1, 1)}
    sent = list(chain.from_iterable(b.to_pylist() for b in divergence._count_terms(iter([docs]))))
    assert {(x["source"], x["term"].decode()): (x["n"], x["df"]) for x in sent} == want
    assert len(sent) == len(want)


def test_skewed_join(spark, rows, monkeypatch):
    data = [(i % 7, i) for i in range(50)] + [(9, i) for i in range(500)] + [(None, 1)]
    left = materialize(rows(data, "k int, v int"))
    index = left.where("k <> 3").groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("top"))
    index = materialize(index)
    want = sorted(map(tuple, left.join(index.drop("n"), "k").collect()))
    for most in (1, 3, 50_000):
        monkeypatch.setattr(common, "HOT_KEYS", most)
        got = common.join_skewed(left, index, "k")
        assert got.columns == ["k", "v", "top"]
        assert sorted(map(tuple, got.collect())) == want
    none = materialize(index.limit(0))
    assert common.join_skewed(left, none, "k").count() == 0


def test_columns_with_the_operators_names(spark, small, rows):
    passage = "\n".join(f"line {i} of a long passage" for i in range(30))
    data = [(i, f"{i} top\n{passage}\nend {i}", "mine", i, "k") for i in range(3)]
    docs = rows(data, "doc_id bigint, text string, _line_marks string, _row int, _kept string")
    done = lines.dedup_lines(docs)
    assert done.columns == ["doc_id", "text", "_line_marks", "_row", "_kept", "_n_lines", "_n_removed"]
    got = {r.doc_id: r for r in done.collect()}
    assert got[0]._kept == data[0][1] and got[1]._n_removed >= 20
    assert all(r._line_marks == "mine" and r._row == i for i, r in got.items())
    lined = corpus_pipeline.line_stage(spark, docs, small)
    assert lined.columns == docs.columns and {r._kept for r in lined.collect()} == {"k"}
    near = corpus_pipeline.near_stage(spark, docs, small)
    assert [tuple(r) for r in near.collect()] == [data[0]]


def test_very_long_texts(rows):
    r = random.Random(9)
    words = [f"w{r.randrange(10**6)}" for _ in range(200_000)]
    long, other = " ".join(words), " ".join(words[:120_000] + [f"v{i}" for i in range(80_000)])
    by_line = "\n".join(" ".join(words[i : i + 8]) for i in range(0, len(words), 8))
    docs = rows([(1, long), (2, other), (3, long + " tail"), (4, by_line)], "doc_id bigint, text string")
    start = time.monotonic()
    cut = {x.doc_id: x.n_removed for x in substrings.dedup_substrings(docs).collect()}
    assert cut == {1: 0, 2: 120_000, 3: 200_000, 4: 200_000}
    found = {x.doc_id: x.component_id for x in minhash.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 1, 4: 1}
    lined = {x.doc_id: x._n_lines for x in lines.dedup_lines(docs).collect()}
    assert lined == {1: 1, 2: 1, 3: 1, 4: 25_000}
    stats = {x.doc_id: x.s for x in docs.select("doc_id", quality.statistics(F.col("text")).alias("s")).collect()}
    assert stats[1][quality.STATISTICS.index("words")] == 200_000
    assert time.monotonic() - start < 120


def test_pipeline_by_plain_steps(spark, tmp_path):
    r = random.Random(11)
    good = lambda i: "\n".join(
        " ".join(["the", "and"] + [f"{r.choice('abcdefgh')}{r.randrange(3000)}ing" for _ in range(9)])
        for _ in range(r.randint(3, 9))
    )
    bad = lambda i: " ".join(r.choices(["##", "$$", "99", "ZZZ", "!!!"], k=r.randint(20, 60)))
    texts, labels = {}, []
    for i in range(240):
        texts[i] = bad(i) if i % 4 == 3 else good(i)
        labels.append(int(i % 4 != 3))
    passage = "\n".join(good(0).split("\n")[:3] + good(1).split("\n")[:3] + good(2).split("\n")[:3])
    for i in (10, 40, 41, 200):
        texts[i] = f"{texts[i]}\n{passage}\nend {i}"
    for i in (50, 90, 150):
        texts[i] = texts[20]
    texts[61] = texts[60].replace("\n", " ") + " more"
    ids = list(texts)
    source = [("web", "web", "book", None)[(i // 4) % 4] for i in ids]
    table = {
        "doc_id": ids, "text": [texts[i] for i in ids], "lang": ["en"] * len(ids), "source": source,
        "n_chars": [len(texts[i]) for i in ids],
    }
    pq.write_table(pa.table(table), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"doc_id": ids, "quality": labels}), tmp_path / "labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    learns = [None if zlib.crc32(str(i).encode()) % 5 == 0 else labels[i] for i in ids]
    scores = discriminant([quality.count_statistics(texts[i]) for i in ids], learns)
    left = {i: texts[i] for i, p in zip(ids, scores) if p >= queries.THRESHOLD}
    assert len(left) == 180
    left = {i: t for i, t in without_repeats(left).items() if t.strip() or t == texts[i]}
    first = []
    for i in sorted(left):
        if not any(alike(left[i], left[j]) for j in first):
            first.append(i)
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        special_tokens={},
    )
    taken = {}
    for row in got:
        assert row.doc_id in first and row.round_trip and row.source == source[row.doc_id]
        assert row.ids == library.encode_ordinary(left[row.doc_id])
        taken[row.doc_id] = taken.get(row.doc_id, 0) + 1
    assert max(taken.values()) <= 2
    size = {i: len(left[i].split()) for i in first}
    weights = {"book": 3, "web": 1, None: 2}
    whole = {s: sum(size[i] for i in first if source[i] == s) for s in weights}
    full = set()
    while True:
        rest = 1.5 * sum(whole.values()) - sum(2 * whole[s] for s in full)
        each = rest / sum(w for s, w in weights.items() if s not in full)
        want = {s: 2 * whole[s] if s in full else each * w for s, w in weights.items()}
        above = {s for s in weights if want[s] > 2 * whole[s]}
        if not above:
            break
        full |= above
    for s in weights:
        mixed = sum(size[i] * n for i, n in taken.items() if source[i] == s)
        assert abs(mixed - want[s]) <= max(size[i] for i in first if source[i] == s)
