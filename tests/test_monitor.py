import datetime as dt
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from textward.operators import monitor
from textward.operators.monitor import HOUR, MINUTE

DDL = "s bigint, family string, label string, confidence double, latency_s double, text string, is_error boolean, namespace string"


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    return [
        (
            rng.randrange(0, 4 * HOUR),
            f"fam{rng.randrange(2)}",
            rng.choice(["jailbreak", "benign", "benign"]),
            0.5 + rng.random() / 2,
            rng.expovariate(4),
            rng.choice(["abcабв", "", "hello", "привет " * 9]),
            rng.random() < 0.1,
            "model-a",
        )
        for _ in range(400)
    ]


@pytest.fixture(scope="module")
def preds(spark, data):
    return spark.createDataFrame(data, DDL).withColumn("ts", F.timestamp_seconds("s"))


def seconds(df, *names):
    return df.withColumns({n: F.unix_seconds(n) for n in names}).collect()


def test_trailing_share_equals_brute_force(preds, data):
    out = monitor.trailing_share(preds, F.col("label") == "jailbreak", ["family"], range_s=HOUR)
    got = {(r.eval_ts, r.family): r.value for r in seconds(out, "eval_ts")}
    for at in range(MINUTE, 5 * HOUR + MINUTE, MINUTE):
        for fam in ("fam0", "fam1"):
            inside = [r for r in data if r[1] == fam and at - HOUR <= r[0] < at]
            if inside:
                assert got[at, fam] == sum(r[2] == "jailbreak" for r in inside) / len(inside)
            else:
                assert (at, fam) not in got


def promql_quantile(q, cum, total, edges):
    rank = q * total
    for i, c in enumerate(cum):
        if c >= rank:
            low, below = (edges[i - 1], cum[i - 1]) if i else (0.0, 0)
            return low + (edges[i] - low) * (rank - below) / (c - below)
    return edges[-1]


def test_trailing_quantile_equals_brute_force(preds, data):
    edges = monitor.LATENCY_EDGES
    out = monitor.trailing_quantile(
        preds, F.col("latency_s"), edges, 0.95, by=["family"], range_s=5 * MINUTE
    )
    got = seconds(out, "eval_ts")
    assert got
    for r in got:
        x = [d[4] for d in data if d[1] == r.family and r.eval_ts - 5 * MINUTE <= d[0] < r.eval_ts]
        cum = [sum(v <= e for v in x) for e in edges]
        assert r.value == pytest.approx(promql_quantile(0.95, cum, len(x), edges))


def test_quantile_edges(spark):
    df = spark.createDataFrame([(0, 0, 0), (2, 2, 4), (0, 3, 3)], "b0 int, b1 int, n int")
    q = monitor.bucket_quantile(0.5, [F.col("b0"), F.col("b1")], F.col("n"), (1.0, 2.0))
    top = monitor.bucket_quantile(0.99, [F.col("b0"), F.col("b1")], F.col("n"), (1.0, 2.0))
    assert [tuple(r) for r in df.select(q, top).collect()] == [
        (None, None),
        (1.0, 2.0),
        (1.5, pytest.approx(1.99)),
    ]


def test_counters_and_histograms(preds, data):
    counts = seconds(monitor.prediction_counts(preds), "window_start")
    assert sum(r["count"] for r in counts) == len(data)
    hist = monitor.prediction_histograms(preds, "1 day").collect()
    assert len(hist) == 2 * (11 + 10 + 9 + 7 + 4)
    for r in hist:
        rows = [d for d in data if d[1] == r.family]
        x = {
            "confidence": [d[3] for d in rows],
            "latency_s": [d[4] for d in rows],
            "tokens": [len(d[5]) / 4 for d in rows],
            "script_ratio": [sum("Ѐ" <= c <= "ӿ" for c in d[5]) / len(d[5]) if d[5] else 0.0 for d in rows],
        }[r.metric]
        assert (r.bucket, r["count"]) == (sum(v <= r.le for v in x), len(x))
        assert r.sum == pytest.approx(sum(x))


def test_windows_are_built_from_tiles(preds):
    """Rows are reduced before they are repeated."""
    plan = plan_of(monitor.rates(preds, ["family"], range_s=HOUR))
    assert plan.index("Generate explode") < plan.rindex("HashAggregate")
    below = plan[plan.index("Generate explode") :]
    assert below.count("HashAggregate") == 2


def evaluations(spark, spans):
    rows = [("a", s, at, active) for s, at, active in spans]
    df = spark.createDataFrame(rows, "alert string, series string, m int, active boolean")
    return df.select("alert", "series", F.timestamp_seconds(F.col("m") * 60).alias("eval_ts"), "active")


SPANS = [
    *[("x", m, True) for m in range(0, 8)],
    ("x", 8, False),
    *[("x", m, True) for m in range(9, 12)],
    *[("y", m, True) for m in (0, 1, 2, 4, 5, 6, 7, 8, 9)],
    ("z", 3, None),
]


def test_hold_resets_on_false_and_on_gaps(spark):
    got = monitor.hold(evaluations(spark, SPANS), 5 * MINUTE)
    firing = {(r.series, r.eval_ts // 60, r.pending_since // 60) for r in seconds(got.where("firing"), "eval_ts", "pending_since")}
    assert firing == {("x", 5, 0), ("x", 6, 0), ("x", 7, 0), ("y", 9, 4)}


def test_alert_evaluations(spark, preds):
    assert monitor.high_error_rate(preds).where("active").count() > 0
    for out in (monitor.high_latency(preds), monitor.confidence_collapse(preds), monitor.class_imbalance(preds)):
        assert out.columns == ["alert", "series", "eval_ts", "value", "active"]
    both = monitor.class_imbalance(preds)
    assert both.where("alert = 'class_imbalance_high' and active and value <= 0.8").count() == 0
    assert both.where("alert = 'class_imbalance_low' and active and value >= 0.05").count() == 0


def test_drift_alert_uses_last_value(spark):
    day = 24 * HOUR
    rows = [(0, "old", "j", 1.0), (9 * day, "f", "j", 1.0), (9 * day + 5, "g", "j", 1.0), (9 * day + 9, "g", "j", 0.0)]
    gauge = spark.createDataFrame(rows, "s bigint, family string, job string, value double").withColumn(
        "ts", F.timestamp_seconds("s")
    )
    now = F.timestamp_seconds(F.lit(9 * day + 100))
    assert [r.family for r in monitor.drift_alert(gauge, now, series=["job"]).collect()] == ["f"]


def test_disagreements(spark):
    rows = [
        (1, "a", "jailbreak", 0), (1, "b", "benign", 1), (1, "c", "benign", 2),
        (2, "a", "benign", 0), (2, "b", "benign", 1), (2, "c", None, 2),
        (3, "a", "benign", 1), (3, "b", "jailbreak", 0), (3, "c", None, 2),
        (4, "a", None, 0),
    ]
    df = spark.createDataFrame(rows, "request_id int, family string, label string, seq int")
    got = {tuple(r) for r in monitor.disagreements(df).collect()}
    assert got == {("benign", "a", "jailbreak", 1), ("jailbreak", "a", "benign", 1)}


def test_recent_log_and_versions(spark):
    rows = [
        (i, dt.datetime(2024, 1, 1, 0, i % 60, i // 60), "f", "benign", 0.9, 1.0, "1" if i < 50 else "2", "d", "t" * 100, i == 69)
        for i in range(70)
    ]
    df = spark.createDataFrame(
        rows,
        "request_id int, ts timestamp, family string, label string, confidence double, latency_ms double, "
        "version string, data_version string, text string, is_error boolean",
    )
    log = monitor.recent_log(df, 50).collect()
    assert len(log) == 50 and {r.text for r in log} == {"t" * 80 + "..."}
    failed = monitor.recent_log(df.where("is_error"), 5).first()
    assert (failed.label, failed.confidence, failed.latency_ms, failed.version) == ("ERR", 0.0, 0.0, "?")
    assert monitor.deployed_versions(df).first().asDict() == {"family": "f", "version": "2", "data_version": "d"}
