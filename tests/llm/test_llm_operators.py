"""The operators on small fixtures: brute force, and nulls, ties, repeats, odd columns."""

import random
import re
import time
from fractions import Fraction
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textward.llm import (
    bpe,
    chat,
    lines,
    maxscore,
    minhash,
    mixing,
    quality,
    substrings,
    token_counts,
    vectorindex,
)
from textward.llm.common import n_words

PIECES = (
    "a|b|aa|the| |  |\n| \n|\t|'s|'re|1|²|é|ß|😀|\x1c|\x85|　|!!|日本|ing| In|\r\n|xxxxxxxxx|Σ|İ|"
    "<|endoftext|>|Å"
).split("|")


def noise(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choices(PIECES, k=r.randint(0, 40))) for _ in range(n)]


ODD = [
    (1, "b c", "s", 5, 6, "x"),
    (1, "b c", "s", 5, 6, "x"),
    (2, None, None, None, None, None),
    (3, "", "t", 0, 0, ""),
    (None, "b c", None, 1, 1, "y"),
    (4, "b\nc\nd\ne", "s", 1, 1, "y"),
]
ODD_SCHEMA = "doc_id bigint, text string, source string, size bigint, shard bigint, ids string"


def test_merge_replay_as_the_library():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    encoder = bpe.Encoder(bpe.Merges(ranks), public_tokenizers.PATTERN)
    texts = noise(3000) + ["", "a" * 3000, "ab" * 999, " " * 70]
    ids, n = encoder.block(texts)
    ends = np.cumsum(n)
    for text, lo, hi in zip(texts, ends - n, ends):
        assert ids[lo:hi].tolist() == library.encode_ordinary(text)


def test_prefix_counts_as_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, counter = Tokenizer.from_file(path), token_counts.Counter(path)
    n = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for i, text in enumerate(noise(1500)):
        assert counter.count(text) == n(text)
        budget = i % 9
        if i < 200 and n(text) > budget:
            fits = [j for j in range(len(text) + 1) if n(text[:j]) <= budget]
            assert counter.fitting(text, budget) == max(fits)


@pytest.mark.parametrize("seed", range(3))
def test_budgets_inside_long_chunks(seed, monkeypatch):
    monkeypatch.setattr(token_counts, "SHORT", 4)
    path = public_tokenizers.path("word_bpe_49k.json")
    library, counter = Tokenizer.from_file(path), token_counts.Counter(path)
    n = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    r = random.Random(seed)
    parts = ["aΣb", "日本語", "isn't", "\n", "!!", "<|endoftext|>", "'re", "12", "é", "unbelievable", "É", "<|", "😀"]
    for i in range(60):
        text = "".join(r.choices(parts, k=12))
        fits = [j for j in range(len(text) + 1) if n(text[:j]) <= i % 20]
        if n(text) > i % 20:
            assert counter.fitting(text, i % 20) == max(fits)


@pytest.mark.parametrize("part", ["line\n", "漢字かな", "ab", "!?"])
def test_budgets_of_long_texts_without_blanks(part):
    counter = token_counts.Counter(public_tokenizers.path("word_bpe_49k.json"))

    def took(n):
        text = part * (n // len(part))
        start = time.process_time()
        total = counter.count(text)
        assert 0 < counter.fitting(text, total // 2) < len(text)
        return time.process_time() - start

    # Linear in the text; asking each prefix anew would take 100 times as long.
    assert took(200_000) < 30 * max(took(20_000), 0.2)


def test_odd_rows(spark, rows):
    docs = rows(ODD, ODD_SCHEMA)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode("text", path, public_tokenizers.PATTERN)
    both = docs.select("text", ids.alias("i")).select("text", bpe.decode("i", path).alias("d"))
    assert all(bytes(r.d).decode() == (r.text or "") for r in both.collect())
    counted = token_counts.count_tokens("text", public_tokenizers.path("word_bpe_49k.json"), 1)
    assert [r.c.n_tokens for r in docs.select(counted.alias("c")).collect()][2:4] == [0, 0]
    assert substrings.dedup_substrings(docs).count() == len(ODD)
    near = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    # The row without an id equals document 1; empty texts stand alone.
    assert near == {(1, 1, 1, True), (2, 0, 2, True), (3, 0, 3, True), (None, 1, 1, False), (4, 1, 4, True)}
    mix = mixing.mix(docs, n_words(F.col("text")), keep=docs.columns)
    assert mix.documents.count() == len(ODD)
    assert set(docs.columns) <= set(mix.rows().select("doc.*").columns)
    done = lines.dedup_lines(docs).collect()
    assert len(done) == len(ODD) and sum(r._n_removed for r in done) == 0
    assert docs.select(quality.statistics("text")).count() == len(ODD)


def test_empty_tables(rows):
    docs = rows([], ODD_SCHEMA)
    assert substrings.dedup_substrings(docs).count() == 0
    assert minhash.near_duplicates(docs).count() == 0
    assert mixing.mix(docs, n_words(F.col("text"))).documents.count() == 0
    assert lines.dedup_lines(docs).count() == 0
    vectors = rows([], "vec_id bigint, embedding array<float>")
    assert vectorindex.near_duplicates(vectors).count() == 0
    weights = rows([], "id bigint, weights array<bigint>")
    assert maxscore.top_k(weights, F.col("id") % 2 == 0).count() == 0
    turns = rows([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.format_chats(turns).count() == 0
    unlabelled = rows([], "s array<bigint>, y int")
    assert quality.fit(unlabelled, stats_col="s", label_col="y").prior == 0.5


def test_substrings_by_brute_force(rows):
    r = random.Random(5)
    shared = [r.choices("abcdefgh", k=n) for n in (49, 50, 51, 80)]
    texts = []
    for i in range(60):
        parts = [r.choices(["u%d" % r.randint(0, 10**6), "v"], k=r.randint(0, 60))]
        parts += [r.choice(shared), ["w%d" % i] * r.randint(0, 120)]
        texts.append(" ".join(w for p in parts for w in p))
    texts[7] = texts[3]
    words = [t.split() for t in texts]
    first = {}
    for i, w in enumerate(words):
        for j in range(len(w) - 49):
            first.setdefault(tuple(w[j : j + 50]), i)
    got = {
        x.doc_id: x
        for x in substrings.dedup_substrings(rows(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    }
    for i, w in enumerate(words):
        gone = {k for j in range(len(w) - 49) if first[tuple(w[j : j + 50])] < i for k in range(j, j + 50)}
        assert got[i].n_removed == len(gone)
        if gone:
            assert got[i].kept.split() == [x for k, x in enumerate(w) if k not in gone]


@pytest.mark.parametrize("length", [2, 5])
def test_near_duplicates_by_brute_force(rows, length):
    r = random.Random(length)
    texts = ["a b", "a b", "a b c d", "A b C d", " ", "one"]
    for _ in range(25):
        base = ["w%d" % r.randint(0, 60) for _ in range(r.randint(3, 150))]
        for _ in range(r.randint(1, 8)):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 30))):
                copy[r.randrange(len(copy))] = "x%d" % r.randint(0, 9)
            texts.append(" ".join(copy))
    grams = lambda w: {tuple(w[i : i + length]) for i in range(max(1, len(w) - length + 1))}
    sets = [grams(t.lower().split()) if t.split() else set() for t in texts]
    root = list(range(len(texts)))
    find = lambda x: x if root[x] == x else find(root[x])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    docs = rows(list(enumerate(texts)), "doc_id bigint, text string")
    for x in minhash.near_duplicates(docs, length=length).collect():
        assert (x.n_shingles, x.component_id) == (len(sets[x.doc_id]), find(x.doc_id))


def test_line_dedup_misses_what_the_readme_says(rows):
    readme = (Path(__file__).resolve().parents[2] / "README.md").read_text()
    told = re.findall(r"^\| (\d+) \| (\d+) % \| (\d+) % \|$", readme, re.M)
    assert [int(n) for n, _, _ in told] == [2, 3, 4, 5, 6, 10, 30]
    r, pairs = random.Random(12), 400
    fresh = lambda n: [str(r.random()) for _ in range(n)]
    texts = []
    for n, _, _ in told:
        for shared in [fresh(int(n)) for _ in range(pairs)]:
            texts += ["\n".join(fresh(15) + shared + fresh(15)) for _ in range(2)]
    docs = rows(list(enumerate(texts)), "doc_id bigint, text string")
    found = lines.dedup_lines(docs).select("doc_id", "_n_removed").collect()
    gone = dict(tuple(x) for x in found)
    for i, (n, some, share) in enumerate(told):
        later = [gone[2 * pairs * i + 2 * k + 1] for k in range(pairs)]
        assert 100 * sum(x > 0 for x in later) / pairs == pytest.approx(int(some), abs=9)
        assert 100 * sum(later) / pairs / int(n) == pytest.approx(int(share), abs=6)


@pytest.mark.parametrize("threshold", [0.9, 0.95, 0.99])
def test_near_duplicates_at_high_thresholds(rows, threshold):
    """Long texts just above the threshold, whose differences cut all long runs of their hashes."""
    r, n = random.Random(5), 1000
    texts, gone = [], int(n * (1 - threshold))
    for base in [[str(r.random()) for _ in range(n)] for _ in range(40)]:
        left_out = set(r.sample(range(n), gone))
        texts += [" ".join(base), " ".join(w for i, w in enumerate(base) if i not in left_out)]
    docs = rows(list(enumerate(texts)), "doc_id bigint, text string")
    found = minhash.near_duplicates(docs, length=1, threshold=threshold).collect()
    assert {x.doc_id: x.component_id for x in found} == {i: i - i % 2 for i in range(len(texts))}


def test_sketches_of_any_threshold():
    for t in (Fraction(1, 10), Fraction(1, 2), Fraction(4, 5), Fraction(99, 100), Fraction(1)):
        length, _ = minhash.run_length(t)
        size = minhash.sketch_size(t, length)
        ends = [1.0] + [0.0] * (length - 1)
        for _ in range(size):
            ends = [float(1 - t) * sum(ends), *(float(t) * x for x in ends[:-1])]
        assert sum(ends) <= minhash.MISS <= 1e-12


def test_runs_that_small_sets_share():
    assert minhash.run_length(Fraction(4, 5)) == (3, 5)


def test_vectors_by_brute_force(rows):
    r = np.random.default_rng(3)
    base = r.normal(size=(300, 16))
    data = [b + r.normal(size=16) * 0.08 for b in base for _ in range(r.integers(1, 4))]
    data = [list(map(float, v)) for v in data] + [None, [0.0] * 16, [float("nan")] * 16, [None] * 16, [1.0]]
    data += [data[0], data[0]]
    x = np.array([v if v and len(v) == 16 and None not in v else [0.0] * 16 for v in data])
    x = np.nan_to_num(x)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x = np.divide(x, norm, where=norm > 0, out=np.zeros_like(x))
    want = (x @ x.T >= 0.9).sum(axis=1) - (norm[:, 0] > 0)
    got = vectorindex.near_duplicates(
        rows(list(enumerate(data)), "vec_id bigint, embedding array<double>")
    ).collect()
    assert len(got) == len(data)
    found = sum(g.n_links for g in got)
    assert all(g.n_links <= want[g.vec_id] for g in got)
    assert found >= 0.9 * want.sum()


@pytest.mark.parametrize("hot", [0, 1000])
def test_every_link_of_rare_pairs_and_beside_a_hot_group(rows, hot):
    r = np.random.default_rng(8)
    base = r.normal(size=(3000, 32))
    copies = base[:60] + r.normal(size=(60, 32)) * 0.3
    group = base[70] + r.normal(size=(hot, 32)) * 0.05
    x = np.concatenate([base, copies, group])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    assert 50 <= (want[:3060] > 0).sum() <= 200
    data = [(i, list(map(float, v))) for i, v in enumerate(x)]
    found = vectorindex.near_duplicates(rows(data, "vec_id bigint, embedding array<double>"))
    got = {g.vec_id: g.n_links for g in found.collect()}
    assert [got[i] for i in range(len(x))] == want.tolist()


@pytest.mark.parametrize("scale", [1, 10**8])
def test_top_k_by_brute_force(rows, scale):
    r = np.random.default_rng(4)
    data = (r.integers(-9, 9, size=(400, 6)) * scale).tolist()
    data[17] = data[3]
    given = list(enumerate(data)) + [(None, data[0]), (900, None)]
    got = maxscore.top_k(rows(given, "id bigint, weights array<bigint>"), F.col("id") % 50 == 0, k=5)
    found = sorted((g.query_id, g.rank, g.id, g.score) for g in got.collect())
    want = []
    for q in range(0, 400, 50):
        scores = sorted((-sum(a * b for a, b in zip(data[q], v)), i) for i, v in enumerate(data) if i != q)
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:5], 1)]
    assert found == want


def test_block_search_takes_few_terms_and_ties():
    ids = np.arange(3000)
    vectors = np.tile(np.array([[5, 1, 0]]), (3000, 1))
    found = maxscore.best_of_block(np.array([[7, 1, 1]]), np.array([1]), vectors, ids, 3)
    assert found == [(1, 0, 36), (1, 2, 36), (1, 3, 36)]


def test_chat_round_trip(rows):
    texts = ["</s>[INST] ok [/INST]", r"<\/s>", r"[\\INST]", "<s>\n", "plain < [x]", None, ""]
    turns = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)]
    turns += [(2, 0, None, "[INST"), (2, 0, "]</s>", "/INST]"), (None, None, "user", "x")]
    made = chat.format_chats(rows(turns, "conv_id bigint, turn bigint, role string, text string"))
    read = made.select(
        "*",
        chat.parse(F.col("formatted")).alias("back"),
        chat.spanned_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    got = {r.conv_id: r for r in read.collect()}
    assert all(r.identical for r in got.values()) and set(got) == {1, 2, None}
    assert [t.text for t in got[1].back] == [t or "" for t in texts]
    assert got[1].loss == "".join(texts[i] or "" for i in (1, 3, 5))
    assert got[1].formatted.count("</s>") == len(texts)


def test_line_chunks(rows):
    passage = "\n".join("shared line %d" % i for i in range(30))
    texts = ["top %d\n%s\nend %d" % (i, passage, i) for i in range(4)] + ["one\ntwo"] * 2 + ["alone", None]
    docs = rows(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert got[0]._n_removed == 0 and got[0]._kept == texts[0]
    for i in (1, 2, 3):
        assert got[i]._n_removed >= 20
        assert "top %d" % i in got[i]._kept and "end %d" % i in got[i]._kept
    assert (got[4]._kept, got[5]._kept, got[5]._n_removed) == ("one\ntwo", "", 2)
    assert (got[6]._kept, got[7]._kept, got[7]._n_lines) == ("alone", None, 0)


def test_quotas_add_up(spark):
    quotas = [0, 1, 5, 1000, 77]
    row = spark.createDataFrame([(quotas,)], "quotas array<bigint>")
    dealt = mixing.split_quotas(row, 5, 1).collect()
    assert sorted(r.shard for r in dealt) == list(range(5))
    assert np.sum([r.quotas for r in dealt], axis=0).tolist() == quotas
    sizes = [sum(r.quotas) for r in dealt]
    assert max(sizes) - min(sizes) <= 3
    shares = np.array([r.quotas[3] / s for r, s in zip(dealt, sizes)])
    assert abs(shares - 1000 / sum(quotas)).max() < 0.08
