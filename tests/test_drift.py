import itertools
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from textward.functions import pvalues
from textward.operators import drift
from textward.sources import readers


def p_values(spark, rows, schema, p):
    return [r.p for r in spark.createDataFrame(rows, schema).select(p.alias("p")).collect()]


def test_ks_tail(spark):
    # The usual quantiles of the Kolmogorov distribution at 10, 5 and 1 percent.
    lambdas = [1.22385, 1.35810, 1.62762, 0.0, 0.1, 9.0]
    rows = [(x / math.sqrt(n / 2), n, n) for n in (50, 20_000) for x in lambdas]
    got = p_values(
        spark, rows, "d double, a bigint, b bigint", pvalues.ks_p_value(F.col("d"), F.col("a"), F.col("b"))
    )
    assert got == pytest.approx([0.10, 0.05, 0.01, 1.0, 1.0, 0.0] * 2, abs=1e-5)


def test_ks_tail_is_continuous_and_falls(spark):
    rows = [(0.002 * i, 5_000, 5_000) for i in range(100)]
    got = p_values(
        spark, rows, "d double, a bigint, b bigint", pvalues.ks_p_value(F.col("d"), F.col("a"), F.col("b"))
    )
    assert all(0 <= y <= x + 1e-12 <= 1 + 1e-12 for x, y in zip(got, got[1:]))


def test_exact_ks_counts_orders(spark):
    """All orders of two small samples, one by one."""
    rows, want = [], []
    for n1, n2 in ((1, 1), (1, 4), (3, 3), (4, 2), (5, 4), (3, 7)):
        gaps = []
        for first in itertools.combinations(range(n1 + n2), n1):
            i = j = top = 0
            for at in range(n1 + n2):
                i, j = (i + 1, j) if at in first else (i, j + 1)
                top = max(top, abs(i * n2 - j * n1))
            gaps.append(top)
        for gap in {0, *gaps}:
            rows.append((gap / (n1 * n2), n1, n2))
            want.append(sum(g >= gap for g in gaps) / len(gaps))
    rows.append((0.5, 0, 3))
    exact = pvalues.ks_exact_p_value(F.col("d"), F.col("a"), F.col("b"))
    got = p_values(spark, rows, "d double, a bigint, b bigint", exact)
    assert got[-1] is None or got[-1] != got[-1]
    assert got[:-1] == pytest.approx(want, abs=1e-13)


def test_exact_ks_of_large_samples():
    """Steps grow with the band; all diagonals in full would be 10^11 here."""
    start = time.process_time()
    series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k) for k in range(1, 9))
    gap = round(math.sqrt(200_000 * 600_000 * 800_000))
    assert pvalues._path_leaves(gap, 200_000, 600_000) == pytest.approx(series, abs=2e-3)
    assert pvalues._path_leaves(30 * gap, 200_000, 600_000) == 0
    assert pvalues._path_leaves(600 * 600 // 2, 600, 600) == pytest.approx(
        2 * math.comb(1200, 300) / math.comb(1200, 600), rel=1e-9
    )
    assert time.process_time() - start < 60


def test_exact_ks_nears_the_series_and_is_asked_for(spark):
    rows = [(x / math.sqrt(1000), 2000, 2000) for x in (0.6, 0.9, 1.2, 1.6)]
    d, a, b = F.col("d"), F.col("a"), F.col("b")
    schema = "d double, a bigint, b bigint"
    near = p_values(spark, rows, schema, pvalues.ks_p_value(d, a, b))
    assert p_values(spark, rows, schema, pvalues.ks_exact_p_value(d, a, b)) == pytest.approx(near, abs=0.02)
    rng = random.Random(8)
    prod, train = lengths(rng, 100, 200), lengths(rng, 103, 200)
    plain, exact = (report(spark, prod, train, method=m) for m in ("asymptotic", "exact"))
    assert plain.p_value_length != exact.p_value_length
    assert plain.p_value_length == pytest.approx(exact.p_value_length, abs=0.02)


def test_chi2_tail(spark):
    xs = [0.0, 0.01, 1.0, 7.814728, 11.344867, 60.0, 1e6]
    got = p_values(spark, [(x,) for x in xs], "x double", pvalues.chi2_p_value(F.col("x")))
    want = [
        math.erfc(math.sqrt(x / 2)) + 2 * math.sqrt(x / 2 / math.pi) * math.exp(-x / 2) for x in xs
    ]
    assert got == pytest.approx(want, abs=1e-10)


def frames(spark, prod, train, family="f"):
    return (
        spark.createDataFrame([(family, t) for t in prod], "family string, text string"),
        spark.createDataFrame([(t,) for t in train], "text string"),
    )


def report(spark, prod, train, **kw):
    return drift.detect_drift(*frames(spark, prod, train), ["f"], **kw).first()


def lengths(rng, mean, n=500):
    return ["x" * max(1, int(rng.gauss(mean, 10))) for _ in range(n)]


def test_length_drift(spark):
    rng = random.Random(42)
    train = lengths(rng, 100)
    same = report(spark, lengths(rng, 100), train)
    assert same.p_value_length > 0.01 and not same.drift_detected
    moved = report(spark, lengths(rng, 200), train)
    assert moved.p_value_length < 0.001 and moved.drift_detected


def test_ks_statistic_equals_numpy(spark):
    rng = random.Random(1)
    a, b = lengths(rng, 100, 300), lengths(rng, 103, 200)
    la, lb = sorted(map(len, a)), sorted(map(len, b))
    grid = np.array(sorted(set(la + lb)))
    want = np.abs(np.searchsorted(la, grid, "right") / 300 - np.searchsorted(lb, grid, "right") / 200).max()
    got = drift.length_statistic(*frames(spark, a, b), ["f"]).first()
    assert got.ks_d == pytest.approx(want, abs=1e-12)


def test_charset_drift(spark):
    ru, en = ["привет"] * 100, ["hello!"] * 100
    assert report(spark, ru, ru).p_value_charset > 0.01
    got = report(spark, ru, en)
    assert got.p_value_charset < 0.01 and got.drift_detected


def test_too_few_rows(spark):
    got = report(spark, ["привет"] * 50, ["x" * 500] * 200)
    assert (got.drift_detected, got.skipped_reason) == (False, "insufficient_samples")
    assert (got.p_value_length, got.p_value_charset, got.cosine_distance) == (1.0, 1.0, 0.0)
    assert (got.n_production, got.n_training) == (50, 200)
    four = report(spark, ["привет"] * 4, ["x" * 500] * 200, min_production=0)
    assert (four.p_value_length, four.p_value_charset) == (1.0, 1.0)


def test_family_without_production(spark):
    prod, train = frames(spark, ["a" * 10] * 200, ["a" * 10] * 200)
    got = {r.family: r for r in drift.detect_drift(prod, train, ["f", "g"]).collect()}
    assert got["g"].skipped_reason == "insufficient_samples" and got["g"].n_production == 0
    assert got["f"].skipped_reason is None and not got["f"].drift_detected
    assert drift.family_names(prod) == ["f"]


def test_families_missing_or_not_named(spark):
    prod = spark.createDataFrame(
        [(f, "a" * 10) for f in ("f", "g", None) for _ in range(150)], "family string, text string"
    )
    train = spark.createDataFrame([("a" * 10,)] * 200, "text string")
    got = {r.family: r.n_production for r in drift.detect_drift(prod, train, ["f", "h"]).collect()}
    assert got == {"f": 150, "g": 150, "h": 0, drift.NO_FAMILY: 150}


def test_family_without_a_log(spark, tmp_path):
    schema = "id int, text string, date date, family string"
    log = readers.recent_predictions(spark, str(tmp_path / "none"), "f", schema=schema)
    train = spark.createDataFrame([("a" * 10,)] * 200, "text string")
    got = drift.detect_drift(log, train, ["f"]).first()
    assert (got.n_production, got.skipped_reason) == (0, "insufficient_samples")


def vectors(spark, data):
    return spark.createDataFrame([(v,) for v in data], "embedding array<float>")


@pytest.mark.parametrize(
    ("p", "t", "want"),
    [
        ([[1.0, 2.0], [3.0, 4.0]], [[1.0, 2.0], [3.0, 4.0]], 0.0),
        ([[1.0, 0.0]], [[0.0, 1.0]], 1.0),
        ([[0.0, 0.0]], [[0.0, 1.0]], 0.0),
        ([], [[0.0, 1.0]], 0.0),
    ],
)
def test_centroid_distance(spark, p, t, want):
    got = drift.centroid_distance(vectors(spark, p), vectors(spark, t)).first()
    assert got.cosine_distance == pytest.approx(want, abs=1e-6)


def test_gauge(spark):
    rng = random.Random(3)
    out = drift.detect_drift(*frames(spark, lengths(rng, 300), lengths(rng, 100)), ["f"])
    got = drift.drift_gauge(out, F.current_timestamp()).first()
    assert (got.family, got.value) == ("f", 1.0)
