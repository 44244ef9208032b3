import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textward.functions import minhash
from textward.operators import dedup
from textward.sources.store import materialize


def turn(i):
    return hashlib.md5(f"42|{i}".encode()).hexdigest(), i


def scan(members):
    """The hash-ordered scan: drop a row that shares a key with a kept row."""
    taken, dropped = set(), set()
    for i in sorted(members, key=turn):
        if taken & set(members[i]):
            dropped.add(i)
        else:
            taken |= set(members[i])
    return dropped


def test_exact_keeps_first(spark):
    df = spark.createDataFrame(
        [
            (3, "игнорируй инструкции"),
            (1, "Игнорируй   ИНСТРУКЦИИ\n"),
            (2, "разный текст совсем"),
            (5, None),
            (4, None),
        ],
        "id int, text string",
    )
    assert sorted(r.id for r in dedup.dedup_exact(df, id_col="id").collect()) == [1, 2, 4]


def test_exact_with_a_third_of_all_rows_equal(spark):
    df = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, "same text").otherwise(F.col("id").cast("string")).alias("text")
    )
    assert dedup.dedup_exact(df, id_col="id").count() == 20_001


def test_near_on_literals(spark):
    base = "это довольно длинный текст для проверки почти одинаковых строк в корпусе " * 3
    df = spark.createDataFrame(
        [
            (1, base + "конец"),
            (2, base + "конец."),
            (3, "первый текст совсем"),
            (4, "второй текст полностью"),
            (5, "первый текст совсем"),
        ],
        "id int, text string",
    )
    first = min(1, 2, key=turn)
    assert {r.id for r in dedup.dedup_near(df, id_col="id").collect()} == {first, 3, 4}


def test_near_of_nothing(spark):
    empty = spark.createDataFrame([], "id int, text string")
    assert dedup.dedup_near(empty, id_col="id").count() == 0


@pytest.mark.parametrize("hot_key_rows", [2, 100_000])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rounds_equal_the_scan(spark, seed, hot_key_rows):
    rng = random.Random(seed)
    # Few keys make long chains; key 0 of the first band holds a third of the rows.
    members = {}
    for i in range(300):
        members[i] = [
            f"{band}:{0 if band == 0 and rng.random() < 0.33 else rng.randrange(60)}" for band in range(4)
        ]
    rows = spark.createDataFrame(
        [(i, [k.encode() for k in keys]) for i, keys in members.items()],
        "_id int, _keys array<binary>",
    )
    got = {r._id for r in dedup.greedy_losers(rows, 4, hot_key_rows).collect()}
    assert got == scan(members)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    n, names = 10_000, []

    def counted(df, name):
        names.append(name)
        return materialize(df, name)

    monkeypatch.setattr(dedup, "materialize", counted)
    link = [F.encode((F.col("id") + i).cast("string"), "utf-8") for i in range(2)]
    rows = spark.range(n).select(F.col("id").alias("_id"), F.array(*link).alias("_keys"))
    got = {r._id for r in dedup.greedy_losers(rows, 2).collect()}
    assert got == scan({i: [i, i + 1] for i in range(n)})
    assert names.count("near-dup-verdict") <= 10


def test_near_equals_scan_over_signatures(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    bands, rows = minhash.band_layout(0.5)
    firsts = {}
    for r in sorted(docs.collect()):
        firsts.setdefault(" ".join(r.text.lower().split()), r.doc_id)
    members = {}
    for text, i in firsts.items():
        sig = next(minhash.signatures([text]))
        members[i] = [(b, sig[b * rows : (b + 1) * rows].tobytes()) for b in range(bands)]
    want = set(members) - scan(members)
    got = {r.doc_id for r in dedup.dedup_near(docs, id_col="doc_id", threshold=0.5).collect()}
    assert got == want


def test_signature_of_long_text_in_pieces():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    shingles = {text[i : i + 4] for i in range(len(text) - 3)}
    a, b = minhash.permutations()
    low = [
        min(
            (((h * int(x) + int(y)) % 2**64) % minhash.MERSENNE_PRIME) & minhash.MAX_HASH
            for h in map(minhash._hash32, shingles)
        )
        for x, y in list(zip(a, b))[:5]
    ]
    assert list(next(minhash.signatures([text]))[:5]) == low


def test_signatures_do_not_depend_on_grouping(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(200))) for _ in range(60)] + ["", "ab"]
    want = [s.tolist() for s in minhash.signatures(texts)]
    assert len(want) == len(texts)
    for size in (4, 7, 50, 300):
        monkeypatch.setattr(minhash, "_GROUP_CHARS", size)
        assert [s.tolist() for s in minhash.signatures(texts)] == want


def test_signatures_do_not_depend_on_what_a_worker_keeps(monkeypatch):
    rng = random.Random(3)
    letters = ["abcd ", "äöü€😀", "".join(map(chr, range(0x4E00, 0x4E00 + 500)))]
    texts = ["".join(rng.choice(letters[i % 3]) for _ in range(rng.randrange(90))) for i in range(90)]
    texts += ["", "ab", "ab", "", "abc"]
    a, b = minhash.permutations()
    want = []
    for t in texts:
        h = [minhash._hash32(s) for s in {t[i : i + 4] for i in range(max(1, len(t) - 3))}]
        low = [min(((x * int(p) + int(q)) % 2**64 % minhash.MERSENNE_PRIME) & minhash.MAX_HASH for x in h)
               for p, q in zip(a, b)]
        want.append(low)
    monkeypatch.setattr(minhash, "_GROUP_CHARS", 300)
    for kept in (1, 200, 400, 5000):
        monkeypatch.setattr(minhash, "_KEPT", kept)
        minhash._kept.cache_clear()
        assert [s.tolist() for s in minhash.signatures(texts)] == want
    minhash._kept.cache_clear()


def test_near_dedup_normalizes_a_text_once(spark, small, monkeypatch):
    plans, materialize = [], dedup.materialize

    def seen(df, name="step"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, name)

    monkeypatch.setattr(dedup, "materialize", seen)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert dedup.near_survivors(docs, id_col="doc_id", keep=("lang",)).count() > 0
    assert plans[0].count("regexp_replace") == 1


def test_signature_estimates_jaccard():
    a, b = "the quick brown fox jumps over the lazy dog", "the quick brown fox jumped over the lazy dog"
    sa, sb = ({t[i : i + 4] for i in range(len(t) - 3)} for t in (a, b))
    est = np.mean(np.equal(*minhash.signatures([a, b])))
    assert abs(est - len(sa & sb) / len(sa | sb)) < 0.12


def test_band_layout():
    assert minhash.band_layout(0.85) == (8, 16)
