import random
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from textward.functions import text as tx

ODD = [
    "",
    "a",
    "abc",
    "  Mixed CASE text\x1c\x1d\n\n tail 　",
    "\t\x85 ",
    "İstanbul ΟΔΟΣ ß ǅ",
    "x² ³ ① ⁴₅ ٣ 7",
    "emoji 😀 ok 😀😀",
    "привет мир, Hello ҂ Ӿ",
    "snake_case don't a1 b2c ab-cd",
    "é combining",
]


def python_words(t):
    return re.findall(r"\b\w\w+\b", t.lower())


@pytest.fixture(scope="module")
def texts(spark, request):
    rng = random.Random(5)
    alphabet = "aB é\n\tЖя 9²_-  😀."
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(200)]
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    return ODD + made + docs


def evaluate(spark, texts, **columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    out = df.select("i", *[c.alias(n) for n, c in columns.items()])
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out)
    return sorted(out.collect(), key=lambda r: r.i)


def test_columns_equal_python(spark, texts):
    got = evaluate(
        spark,
        texts,
        norm=tx.normalize("text"),
        strip=tx.strip("text"),
        shingles=tx.char_shingles("text"),
        letters=tx.letter_script_ratio("text"),
        chars=tx.char_script_ratio("text"),
        feats=tx.char_features("text"),
        toks=tx.tokens("text"),
        preview=tx.preview("text"),
        first=tx.first_paragraph("text"),
        est=tx.token_estimate("text"),
        valid=tx.valid_input("text"),
    )
    for t, r in zip(texts, got):
        norm = " ".join(t.lower().split())
        assert r.norm == norm
        assert r.strip == t.strip()
        want = {norm[i : i + 4] for i in range(len(norm) - 3)} or {norm}
        assert len(r.shingles) == len(want) and set(r.shingles) == want
        alpha = [c for c in t if c.isalpha()]
        cyr = [c for c in t if "Ѐ" <= c <= "ӿ"]
        in_range = sum("Ѐ" <= c <= "ӿ" for c in alpha)
        assert r.letters == (in_range / len(alpha) if alpha else 0.0)
        assert r.chars == (len(cyr) / len(t) if t else 0.0)
        assert r.feats == [len(t), len(alpha), len(cyr), sum(c.isdigit() for c in t)]
        assert r.toks == python_words(t)
        assert r.preview == t[:80] + ("..." if len(t) > 80 else "")
        assert r.first == t.split("\n\n")[0]
        assert r.est == len(t) / 4
        assert r.valid == (1 <= len(t) <= 10_000)


def test_group_hash_and_bucket(spark, texts):
    import hashlib

    got = evaluate(
        spark, texts, h=tx.group_hash("text"), b=tx.hash_bucket(tx.group_hash("text"))
    )
    for t, r in zip(texts, got):
        h = hashlib.sha256(" ".join(t.lower().split()).encode()).hexdigest()[:16]
        assert (r.h, r.b) == (h, int(h, 16) % 10_000)


def test_ngrams_and_term_counts(spark, texts):
    from collections import Counter

    grams = tx.word_ngrams(tx.tokens("text"))
    got = evaluate(
        spark,
        texts,
        grams=grams,
        trigrams=tx.word_ngrams(tx.tokens("text"), 3, 3),
        counts=tx.term_counts(grams),
    )
    for t, r in zip(texts, got):
        w = python_words(t)
        want = w + [f"{a} {b}" for a, b in zip(w, w[1:])]
        assert r.grams == want
        assert r.trigrams == [" ".join(x) for x in zip(w, w[1:], w[2:])]
        assert {c.term: c.tf for c in r.counts} == dict(Counter(want))


def test_script_ratio_cases(spark):
    got = evaluate(
        spark,
        ["привет мир", "hello world", "hello привет", ""],
        r=tx.letter_script_ratio("text"),
        ok=tx.is_script("text"),
    )
    assert got[0].r > 0.9 and got[1].r < 0.1 and 0.3 < got[2].r < 0.7 and got[3].r == 0.0
    assert [g.ok for g in got] == [True, False, True, False]
    all_chars = evaluate(spark, ["привет", "abcабв", ""], r=tx.char_script_ratio("text"))
    assert [g.r for g in all_chars] == [1.0, 0.5, 0.0]


def test_length_limits(spark):
    got = evaluate(spark, ["short text", "hi", "x" * 200], ok=tx.length_ok("text", 5, 100))
    assert [g.ok for g in got] == [True, False, False]


def test_decode(spark):
    df = spark.createDataFrame([(0.5,), (0.9,), (0.1,)], "p double")
    got = df.select(tx.decode_label("p").alias("l"), F.round(tx.decode_confidence("p"), 6).alias("c"))
    assert [tuple(r) for r in got.collect()] == [
        ("jailbreak", 0.5),
        ("jailbreak", 0.9),
        ("benign", 0.9),
    ]
