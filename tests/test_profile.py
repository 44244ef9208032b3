import random

import numpy as np
import pytest

from textward.operators import ordered, profile


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    data = [
        (i, "é" * rng.randrange(5) + "x" * rng.randrange(2000), rng.choice([0, 0, 0, 1]), f"s{rng.randrange(3)}", f"c{i % 2}", rng.choice(["train", "val", "test"]))
        for i in range(301)
    ]
    return spark.createDataFrame(
        data, "id int, text string, label tinyint, source string, subcategory string, split string"
    )


def test_counts_and_samples(spark):
    df = spark.createDataFrame(
        [(1, "a", 1, "s1"), (2, "b", 0, "s2"), (3, "c", 1, "s1")], "id int, text string, label tinyint, source string"
    )
    assert profile.row_count(df).first().n_rows == 3
    assert [tuple(r) for r in profile.class_counts(df).collect()] == [(0, 1), (1, 2)]
    assert [tuple(r) for r in profile.source_counts(df).collect()] == [("s1", 2), ("s2", 1)]
    first = profile.sample_per_label(df, 1, id_col="id")
    assert sorted(r.id for r in first.collect()) == [1, 2]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    assert profile.row_count(df.limit(0)).first().n_rows == 0


def test_length_stats(corpus):
    n = sorted(len(r.text) for r in corpus.collect())
    got = profile.length_stats(corpus).first()
    last = len(n) - 1
    assert tuple(got) == (n[0], n[int(last * 0.25 + 0.5)], float(np.median(n)), n[int(last * 0.75 + 0.5)], n[-1])


def test_length_percentiles_and_ratio(corpus):
    rows = corpus.collect()
    got = {r.label: r for r in profile.length_percentiles(corpus).collect()}
    ratios = {r.label: r for r in profile.script_ratio_stats(corpus, script="À-ɏ").collect()}
    for label in (0, 1):
        texts = [r.text for r in rows if r.label == label]
        n = [len(t) for t in texts]
        assert (got[label].median, got[label].p95) == (int(np.median(n)), int(np.percentile(n, 95)))
        x = [t.count("é") / len(t) if t else 0.0 for t in texts]
        want = (np.mean(x), np.median(x), np.std(x, ddof=1))
        assert tuple(ratios[label])[1:] == pytest.approx(want, abs=6e-4)


def test_histogram(corpus):
    got = {(r.label, r.bin): r["count"] for r in profile.length_histogram(corpus).collect()}
    for label in (0, 1):
        n = [len(r.text) for r in corpus.collect() if r.label == label]
        want, _ = np.histogram(np.clip(n, 0, 1500), bins=40, range=(0, 1500))
        assert [got.get((label, i + 1), 0) for i in range(40)] == list(want)


def test_histogram_over_the_data_range(spark, corpus):
    got = profile.length_histogram(corpus, data_range=True).collect()
    for label in (0, 1):
        n = [len(r.text) for r in corpus.collect() if r.label == label]
        want, _ = np.histogram(np.clip(n, 0, 1500), bins=40)
        counts = {r.bin: r["count"] for r in got if r.label == label}
        assert [counts.get(i + 1, 0) for i in range(40)] == list(want)
    one = spark.createDataFrame([(0, "abc")] * 3, "label int, text string")
    want, _ = np.histogram([3, 3, 3], bins=40)
    assert [tuple(r) for r in profile.length_histogram(one, data_range=True).collect()] == [
        (0, int(want.argmax()) + 1, 3)
    ]


def test_pivots(corpus):
    rows = corpus.collect()
    for r in profile.split_by_label(corpus).collect():
        assert r.label_1 == sum(x.split == r.split and x.label == 1 for x in rows)
    for r in profile.source_by_split(corpus).collect():
        assert r.val == sum(x.source == r.source and x.split == "val" for x in rows)
    got = {r.subcategory: r["count"] for r in profile.subcategory_counts(corpus, "s1").collect()}
    assert sum(got.values()) == sum(x.source == "s1" for x in rows)


@pytest.mark.parametrize("kind", ["unique", "few", "hot"])
def test_exact_quantiles_on_doubles(spark, kind):
    rng = random.Random(7)
    make = {
        "unique": rng.random,
        "few": lambda: rng.randrange(4) / 4,
        "hot": lambda: 0.5 if rng.random() < 0.4 else rng.gauss(0, 1e-9),
    }[kind]
    data = [(rng.choice("ab"), make()) for _ in range(3001)]
    df = spark.createDataFrame(data, "g string, x double")
    wanted = {f"q{int(q * 100)}": (q, "linear") for q in (0.0, 0.05, 0.5, 0.95, 0.99, 1.0)}
    for r in ordered.exact_quantiles(df, "x", wanted, by=["g"]).collect():
        x = [v for g, v in data if g == r.g]
        for name, (q, _) in wanted.items():
            assert r[name] == pytest.approx(np.percentile(x, q * 100), abs=1e-15, rel=1e-12)


def test_quantiles_with_null_group_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None)], "g string, x double")
    got = ordered.exact_quantiles(df, "x", {"m": (0.5, "linear")}, by=["g"])
    assert {r.g: r.m for r in got.collect()} == {None: 2.0, "a": 5.0}
    assert ordered.exact_quantiles(df.limit(0), "x", {"m": (0.5, "linear")}).first().m is None
