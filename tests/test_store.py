import datetime as dt
from pathlib import Path

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from textward.sources import readers, store


def splits(spark, n):
    return spark.range(n).select(
        "id", F.when(F.col("id") % 2 == 0, "train").otherwise("test").alias("split")
    )


def test_publish_is_idempotent(spark, tmp_path):
    base = str(tmp_path / "s")
    first = store.publish_splits(splits(spark, 10), base, "v1")
    assert [tuple(r) for r in first.collect()] == [("test", 5, "uploaded"), ("train", 5, "uploaded")]
    again = store.publish_splits(splits(spark, 10), base, "v1")
    assert {r.status for r in again.collect()} == {"skipped"}
    assert readers.read_splits(spark, f"{base}/data", "v1").count() == 10


def test_publish_replaces_a_changed_split_only(spark, tmp_path):
    base = str(tmp_path / "s")
    store.publish_splits(splits(spark, 10), base, "v1")
    store.publish_splits(splits(spark, 4), base, "v2")
    changed = store.publish_splits(splits(spark, 11), base, "v1")
    assert {r.split: r.status for r in changed.collect()} == {"test": "skipped", "train": "uploaded"}
    assert readers.read_splits(spark, f"{base}/data", "v1", "train").count() == 6
    assert readers.read_splits(spark, f"{base}/data", "v2").count() == 4
    again = store.publish_splits(splits(spark, 11), base, "v1")
    assert {r.status for r in again.collect()} == {"skipped"}


def test_publish_replaces_changed_content_of_equal_size(spark, tmp_path):
    base = str(tmp_path / "s")
    rows = splits(spark, 10).withColumn("text", F.lit("old"))
    store.publish_splits(rows, base, "v1")
    new = F.when(F.col("split") == "train", "new").otherwise(F.col("text"))
    changed = store.publish_splits(rows.withColumn("text", new), base, "v1")
    assert {r.split: r.status for r in changed.collect()} == {"test": "skipped", "train": "uploaded"}
    train = readers.read_splits(spark, f"{base}/data", "v1", "train")
    assert {r.text for r in train.collect()} == {"new"}


def test_compute_once(spark, tmp_path):
    base = str(tmp_path / "f")
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    key = store.feature_key("v1", "org/model", None, "train")
    assert "/" not in key
    for _ in range(2):
        assert store.compute_once(spark, base, key, compute).count() == 3
    assert len(calls) == 1
    store.compute_once(spark, base, store.feature_key("v1", "org/model", "r2", "train"), compute)
    assert len(calls) == 2


def test_compute_once_after_a_failure(spark, tmp_path):
    base = str(tmp_path / "f")
    with pytest.raises(Exception, match="boom"):
        store.compute_once(
            spark, base, "k", lambda: spark.range(3).select(F.raise_error(F.lit("boom")).alias("x"))
        )
    assert store.compute_once(spark, base, "k", lambda: spark.range(3)).count() == 3


def test_write_stage_replaces(spark, tmp_path):
    path = str(tmp_path / "a" / "b" / "all.parquet")
    store.write_stage(spark.range(5), path)
    store.write_stage(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_shared_dir_is_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    where = store.shared_dir(spark)
    if configured:
        assert configured in where
    assert store.materialize(spark.range(4)).count() == 4


def test_temporary_tables_go_with_their_block(spark):
    folders = lambda: {p.name for p in Path(store.shared_dir(spark).removeprefix("file:")).glob("tmp-*")}
    assert not folders()
    with store.temporary() as keep:
        with store.temporary() as keep_inner:
            inner = keep_inner(store.materialize(spark.range(5), "tmp-a").where("id > 1"), "tmp-b")
            assert len(folders()) == 2
        assert len(folders()) == 1 and inner.count() == 3
        kept = keep(inner.where("id > 2"), "tmp-c")
    assert {f[:5] for f in folders()} == {"tmp-c"} and kept.count() == 2
    with pytest.raises(ZeroDivisionError), store.temporary():
        store.materialize(spark.range(5), "tmp-d")
        1 / 0
    assert {f[:5] for f in folders()} == {"tmp-c"}


def test_gauge_table_keeps_runs_apart_and_lists_recent_days_only(spark, tmp_path):
    base = str(tmp_path / "gauge")
    now = dt.datetime(2024, 3, 20, 12, tzinfo=dt.UTC)
    assert store.read_gauge(spark, base, now).count() == 0

    def sample(days, value, job="a", families=("f", "g")):
        ts = F.timestamp_seconds(F.lit(int((now - dt.timedelta(days=days)).timestamp())))
        rows = spark.createDataFrame([(f, value) for f in families], "family string, value double")
        store.append_gauge(rows.withColumn("ts", ts), base, job)

    for days in (30, 20, 9, 8, 3, 0):
        sample(days, float(days))
    sample(3, 4.0)
    sample(3, 5.0, job="b", families=("f",))
    got = store.read_gauge(spark, base, now)
    assert sorted((r.family, r.job, r.value) for r in got.collect()) == [
        ("f", "a", 0.0), ("f", "a", 4.0), ("f", "a", 8.0), ("f", "b", 5.0),
        ("g", "a", 0.0), ("g", "a", 4.0), ("g", "a", 8.0),
    ]
    assert "InMemoryFileIndex(3 paths)" in plan_of(got)
