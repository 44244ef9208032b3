import random

import numpy as np
import pytest

from textward.operators import evaluate as ev


def frame(spark, y, p, s=None):
    s = s or [float(v) for v in p]
    return spark.createDataFrame(list(zip(y, p, s)), "y int, p int, s double")


def metrics(df):
    return ev.binary_metrics(df, true_col="y", pred_col="p", score_col="s").first()


def test_perfect_and_inverted(spark):
    assert set(metrics(frame(spark, [0, 0, 1, 1], [0, 0, 1, 1]))) == {1.0}
    bad = metrics(frame(spark, [0, 0, 1, 1], [1, 1, 0, 0]))
    assert (bad.f1, bad.accuracy, bad.auroc) == (0.0, 0.0, 0.0)


def test_undefined_is_zero_and_one_class_has_no_area(spark):
    got = metrics(frame(spark, [0, 0], [0, 0]))
    assert (got.f1, got.precision, got.recall, got.accuracy, got.auroc) == (0.0, 0.0, 0.0, 1.0, None)


@pytest.mark.parametrize("levels", [3, 10_000])
def test_auroc_counts_pairs(spark, levels):
    rng = random.Random(levels)
    data = [(int(rng.random() < 0.4), rng.randrange(levels) / levels) for _ in range(600)]
    df = spark.createDataFrame([(y, 0, s) for y, s in data], "y int, p int, s double")
    pos = np.array([s for y, s in data if y])
    neg = np.array([s for y, s in data if not y])
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    assert metrics(df).auroc == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


def test_confusion_has_all_cells(spark):
    got = ev.confusion_matrix(frame(spark, [1, 1], [1, 0]), true_col="y", pred_col="p")
    assert {(r.y_true, r.y_pred): r["count"] for r in got.collect()} == {
        (0, 0): 0,
        (0, 1): 0,
        (1, 0): 1,
        (1, 1): 1,
    }


def test_per_source(spark):
    df = spark.createDataFrame(
        list(zip([1, 1, 0, 0, 1, 0], "aaabbb", [1, 0, 0, 0, 1, 1])), "y int, source string, p int"
    )
    got = {r.source: r.f1 for r in ev.per_source_f1(df, true_col="y", pred_col="p").collect()}
    assert got == pytest.approx({"a": 2 / 3, "b": 2 / 3})
    models = ev.per_source_f1_models(df, {"m": "p"}, true_col="y", min_rows=4)
    assert models.count() == 0
    models = ev.per_source_f1_models(df, {"m": "p", "self": "y"}, true_col="y", min_rows=3)
    assert {(r.source, r.n, r.m_f1, r.self_f1) for r in models.collect()} == {
        ("a", 3, 0.667, 1.0),
        ("b", 3, 0.667, 1.0),
    }


def test_classification_report(spark):
    # Hand-computed for y = 0,0,0,1,1 and p = 0,0,1,1,0.
    df = frame(spark, [0, 0, 0, 1, 1], [0, 0, 1, 1, 0])
    got = {
        r["class"]: tuple(round(x, 4) for x in (r.precision, r.recall, r.f1)) + (r.support,)
        for r in ev.classification_report(df, true_col="y", pred_col="p").collect()
    }
    assert got == {
        "0": (0.6667, 0.6667, 0.6667, 3),
        "1": (0.5, 0.5, 0.5, 2),
        "accuracy": (0.6, 0.6, 0.6, 5),
        "macro avg": (0.5833, 0.5833, 0.5833, 5),
        "weighted avg": (0.6, 0.6, 0.6, 5),
    }


def test_compare_models(spark):
    long = spark.createDataFrame(
        [("a", "f1", 0.123456), ("b", "f1", 1.0), ("a", "auc", 0.5)], "model string, metric string, value double"
    )
    got = {r.metric: (r.a, r.b) for r in ev.compare_models(long, ["a", "b"]).collect()}
    assert got == {"f1": (0.1235, 1.0), "auc": (0.5, None)}


def test_latency(spark):
    rng = random.Random(2)
    ms = [rng.expovariate(0.1) for _ in range(500)]
    df = spark.createDataFrame([(v * 4, 4) for v in ms], "batch double, n int")
    each = ev.request_latency(df, batch_ms="batch", batch_size="n")
    got = ev.latency_summary(each).first()
    want = [*np.percentile(ms, [50, 95, 99]), np.mean(ms)]
    assert [got.p50_ms, got.p95_ms, got.p99_ms, got.mean_ms] == pytest.approx(want)
    assert got.p50_ms <= got.p95_ms <= got.p99_ms


def test_one_read_serves_all_models(spark):
    """Counts of two halves add up to those of the whole, and every metric follows from them."""
    rng = random.Random(5)
    data = []
    for i in range(800):
        y, p = rng.choice([0, 1, 1, None]), rng.choice([0, 1, None])
        s = rng.choice([None, float("nan"), float("inf"), 0.0, -0.0, rng.random(), rng.randrange(9) / 9])
        data.append((i, rng.choice(["g", "h", None]), y, p, s, rng.randrange(4)))
    df = spark.createDataFrame(data, "id int, score string, y int, p int, s double, model int")
    models = {"m": ("p", "s"), "n": ("y", "model")}
    counts = [
        ev.score_counts(df.where(half), models, true_col="y", by=["score"]).toDF("g", "model", "v", *ev._COUNTS)
        for half in ("id < 300", "id >= 300")
    ]
    both = counts[0].unionAll(counts[1]).groupBy("g", "model", "v").sum(*ev._COUNTS)
    both = both.toDF("g", "model", "score", *ev._COUNTS)
    got = {(r.g, r.model): r for r in ev.metrics_of_counts(both, ["g", "model"]).collect()}
    assert len(got) == 6
    for (g, model), r in got.items():
        rows = [x for x in data if x[1] == g]
        pred, at = (3, 4) if model == "m" else (2, 5)
        pairs = [(x[2], x[at]) for x in rows if x[at] is not None]
        up = lambda v: float("inf") if v != v else v
        key = lambda v: (v != v, up(v))
        pos, neg = [key(v) for y, v in pairs if y == 1], [key(v) for y, v in pairs if y == 0]
        wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
        assert r.auroc == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)
        tp = sum(x[2] == 1 and x[pred] == 1 for x in rows)
        wrong = sum(x[2] is not None and x[pred] is not None and x[2] != x[pred] for x in rows)
        assert r.f1 == pytest.approx(2 * tp / (2 * tp + wrong))


def test_no_rows(spark):
    empty = frame(spark, [0], [0]).where("y > 5")
    got = metrics(empty)
    assert (got.f1, got.precision, got.recall, got.accuracy, got.auroc) == (0.0, 0.0, 0.0, 0.0, None)
    assert ev.auroc(empty, true_col="y", score_col="s", by=["p"]).count() == 0
    assert ev.latency_summary(empty, "s").first().mean_ms is None
