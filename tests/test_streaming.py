import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textward.operators import models, monitor
from textward.operators.monitor import HOUR, MINUTE
from textward.plans import serving
from textward.plans.catalog import scoring
from textward.plans.catalog.tables import as_predictions, predictions, stream_of, table
from textward.sources import readers
from textward.streaming import holds, sinks
from textward.streaming import predictions as sp


def finish(stream, tmp_path, **kw):
    query = sp.start_table_sink(
        stream, str(tmp_path / "rows"), str(tmp_path / "state"), available_now=True, **kw
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / "rows"))


def as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture
def stream(spark, small):
    return as_predictions(stream_of(spark, small, "events"))


def closed(spark, small):
    last = predictions(spark, small).agg(F.max("ts")).first()[0]
    return F.lit(last - dt.timedelta(minutes=10))


def test_counts_equal_batch(spark, small, stream, tmp_path):
    got = finish(sp.stream_counts(stream), tmp_path)
    batch = monitor.prediction_counts(predictions(spark, small))
    want = batch.where(F.col("window_start") + F.expr("INTERVAL 1 HOUR") <= closed(spark, small))
    assert as_set(got) == as_set(want) and got.count() > 100


def test_shares_over_trailing_windows_equal_batch(spark, small, stream, tmp_path):
    def share(df, sums_of):
        return monitor.trailing_share(
            df, F.col("label") == "jailbreak", ["family"], range_s=HOUR, step_s=15 * MINUTE, sums_of=sums_of
        )

    got = finish(share(stream, sp.stream_trailing_sums), tmp_path)
    batch = share(predictions(spark, small), monitor.trailing_sums)
    assert as_set(got) == as_set(batch.where(F.col("eval_ts") <= closed(spark, small)))


@pytest.mark.parametrize(
    "name", ["c14_rejects_stream", "g05_prediction_records_stream", "g05_serving_stream"]
)
def test_streams_of_a_table_in_several_files(spark, small, tmp_path, name):
    folder = str(tmp_path)
    docs = table(spark, small, "documents").select("doc_id", "text")
    long = docs.where("doc_id < 7").withColumn("text", F.repeat("text", 10_000))
    docs = docs.where("doc_id >= 7").unionByName(long)
    docs.where("doc_id < 50").coalesce(1).write.parquet(f"{folder}/one/documents.parquet")
    (part,) = (tmp_path / "one" / "documents.parquet").glob("part-*")
    part.rename(tmp_path / "documents.parquet")
    docs.where("doc_id < 50").repartition(3).write.parquet(f"{folder}/more/documents.parquet")
    query = scoring.QUERIES[name]
    got = as_set(query(spark, f"{folder}/more"))
    assert got and got == as_set(query(spark, folder))


@pytest.mark.parametrize("name", ["g05_prediction_records_stream", "g05_serving_stream"])
def test_streams_without_rows(spark, tmp_path, name):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    none.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert scoring.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_late_rows_are_dropped(spark, tmp_path):
    source = tmp_path / "in"
    ddl = "s bigint, family string, label string"
    # A batch drops what was already behind the watermark one batch earlier.
    for batch in ([0, 3600], [7500], [7600], [10, 7300], [20_000]):
        data = [(s, "f", "l") for s in batch]
        spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(str(source))
    stream = (
        spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(source))
        .select(F.timestamp_seconds("s").alias("ts"), "family", "label")
    )
    got = finish(sp.stream_counts(stream), tmp_path)
    counts = {r.w // 3600: r["count"] for r in got.withColumn("w", F.unix_seconds("window_start")).collect()}
    assert counts == {0: 1, 1: 1, 2: 3}


def test_log_read_back(spark, small, stream, tmp_path):
    path = str(tmp_path / "log")
    for _ in range(2):  # the second run finds nothing new
        sp.log_predictions(
            stream, path, str(tmp_path / "state"), id_col="event_id", rate=0.3, available_now=True
        ).awaitTermination()
    batch = sp.sampled_log(predictions(spark, small), 0.3, id_col="event_id")
    assert as_set(spark.read.parquet(path).select("event_id")) == as_set(batch.select("event_id"))
    day = batch.agg(F.max("date")).first()[0]
    recent = readers.recent_predictions(spark, path, "fam2", as_of=day, days=3)
    want = batch.where((F.col("family") == "fam2") & (F.col("date") > F.date_sub(F.lit(day), 3)))
    assert as_set(recent.select("event_id")) == as_set(want.select("event_id"))
    assert sp.sampled_log(predictions(spark, small), 0.0, id_col="event_id").count() == 0


def test_hold_chain_from_stream(spark, small, stream, tmp_path):
    """Alert evaluations from one stream feed the hold times of a second."""
    evaluations = finish(monitor.class_imbalance(stream, sums_of=sp.stream_trailing_sums), tmp_path / "e")
    session = holds.stateful_session(spark)
    again = session.readStream.schema(evaluations.schema).parquet(str(tmp_path / "e" / "rows"))
    got = finish(holds.stream_hold(again, 10 * MINUTE), tmp_path / "h")
    want = monitor.hold(evaluations, 10 * MINUTE)
    assert as_set(got) == as_set(want) and got.where("firing").count() > 0


def test_hold_state_survives_micro_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    minutes = [(0, True), (1, True), (2, True), (3, False), (4, True), (5, True), (6, True), (7, True), (9, True)]
    for m, active in minutes:
        spark.createDataFrame([("a", "s", m, active)], "alert string, series string, m int, active boolean").select(
            "alert", "series", F.timestamp_seconds(F.col("m") * 60).alias("eval_ts"), "active"
        ).coalesce(1).write.mode("append").parquet(source)
    evaluations = spark.read.parquet(source)
    session = holds.stateful_session(spark)
    stream = session.readStream.schema(evaluations.schema).option("maxFilesPerTrigger", 1).parquet(source)
    got = finish(holds.stream_hold(stream, 2 * MINUTE), tmp_path)
    assert as_set(got) == as_set(monitor.hold(evaluations, 2 * MINUTE))


def test_scores_and_rejects(spark, small, tmp_path):
    def records(df):
        scored = models.score_batches(
            sp.accepted(df.select("doc_id", "text")), lambda: lambda ts: [len(t) % 100 / 100 for t in ts]
        )
        return models.prediction_records(scored.drop("text"), family="f", model_version="1", data_version="v")

    docs = table(spark, small, "documents")
    got = finish(records(stream_of(spark, small, "documents")), tmp_path)
    assert as_set(got) == as_set(records(docs))
    bad = spark.createDataFrame([(1, ""), (2, None), (3, "x" * 10_001), (4, "ok")], "id int, text string")
    assert as_set(sp.rejected(bad).select("id")) == {(1,), (2,), (3,)}
    assert as_set(sp.accepted(bad).select("id")) == {(4,)}


def evaluation_stream(spark, tmp_path, batches, watermark=None):
    """A micro-batch per list of (series, minute, active)."""
    source = str(tmp_path / "in")
    for data in batches:
        rows = [("a", *row) for row in data]
        spark.createDataFrame(rows, "alert string, series string, m int, active boolean").select(
            "alert", "series", F.timestamp_seconds(F.col("m") * 60).alias("eval_ts"), "active"
        ).coalesce(1).write.mode("append").parquet(source)
    evaluations = spark.read.parquet(source)
    stream = (
        holds.stateful_session(spark).readStream.schema(evaluations.schema)
        .option("maxFilesPerTrigger", 1).parquet(source)
    )
    return evaluations, stream.withWatermark("eval_ts", watermark) if watermark else stream


def test_late_evaluations_are_a_second_output(spark, tmp_path):
    batches = [[("s", 0, True), ("s", 1, True)], [("s", 2, True), ("t", 9, True)], [("s", 1, False), ("s", 3, True), ("s", 3, True)]]
    _, stream = evaluation_stream(spark, tmp_path, batches)
    got = finish(holds.stream_hold_marked(stream, 2 * MINUTE), tmp_path)
    rows = [(r.series, r.m, r.firing, r.late) for r in got.withColumn("m", (F.unix_seconds("eval_ts") / 60).cast("int")).collect()]
    assert sorted(rows, key=str) == sorted(
        [("s", 0, False, False), ("s", 1, False, False), ("s", 2, True, False), ("s", 3, True, False),
         ("t", 9, False, False), ("s", 1, None, True), ("s", 3, None, True)], key=str
    )


def test_state_of_an_ended_series_expires(spark, tmp_path):
    batches = [[("s", 0, True), ("s", 1, True), ("t", 1, True)], [("t", 2, True)], [("t", 30, True)], [("t", 31, True)]]
    evaluations, stream = evaluation_stream(spark, tmp_path, batches, watermark="1 minute")
    held = holds.stream_hold_marked(stream, MINUTE, expire=True)
    query = sp.start_table_sink(held, str(tmp_path / "rows"), str(tmp_path / "state"), available_now=True)
    query.awaitTermination()
    got = spark.read.schema(held.schema).parquet(str(tmp_path / "rows"))
    assert as_set(got.where(~F.col("late")).drop("late")) == as_set(monitor.hold(evaluations, MINUTE))
    state = [p["stateOperators"][0] for p in query.recentProgress]
    assert sum(o["numRowsRemoved"] for o in state) == 1 and state[-1]["numRowsTotal"] == 1


def test_run_starts_by_brute_force():
    r = random.Random(2)
    for _ in range(300):
        at = np.cumsum(r.choices([60, 120], k=12))
        active = np.array(r.choices([True, False], weights=[3, 1], k=12))
        last, pending = r.choice([(holds._NEVER, holds._NEVER), (0, holds._NEVER), (0, -180)])
        want, before, since = [], last, pending
        for t, on in zip(at.tolist(), active.tolist()):
            if not on:
                since = holds._NEVER
            elif since == holds._NEVER or t - before != 60:
                since = t
            want.append(since)
            before = t
        assert holds.run_starts(at, active, last, pending, 60).tolist() == want


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    base = str(tmp_path / "out")
    rows = spark.range(20).select("id", (F.col("id") % 2 == 0).alias("even"), F.lit("x").alias("day"))
    parts = {"even": lambda b: b.where("even"), "odd": lambda b: b.where("NOT even")}
    for number in (0, 1, 0, 1, 1):
        sinks.write_parts(rows.where(F.floor(F.col("id") % 4 / 2) == number), number, base, parts, {"odd": ("day",)})
    schema = rows.schema
    assert sorted(r.id for r in sinks.read_part(spark, base, "even", schema).collect()) == list(range(0, 20, 2))
    assert sorted(r.id for r in sinks.read_part(spark, base, "odd", schema).collect()) == list(range(1, 20, 2))


def test_serving_from_one_read(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    data = [(1, "ab"), (2, ""), (3, None), (4, "x" * 10_001), (5, "y" * 600), (6, "ab")]
    requests = spark.createDataFrame(data, "id bigint, text string").select(
        "id", F.timestamp_seconds(F.col("id") * 1800).alias("ts"), "text", F.lit(0.02).alias("latency_s")
    )
    seen = []

    def scorer():
        return lambda texts: [len(t) % 1000 / 1000 for t in texts]

    def serve():
        stream = spark.newSession().readStream.schema(requests.schema).option("maxFilesPerTrigger", 1).parquet(source)
        query = serving.start_serving(
            stream, scorer, base, f"{base}/state", id_col="id", family="f", model_version="1",
            data_version="d", rate=1.0, available_now=True,
        )
        query.awaitTermination()
        seen.append(query.lastProgress)

    requests.where("id <= 4").coalesce(1).write.parquet(source)
    serve()
    requests.where("id > 4").coalesce(1).write.mode("append").parquet(source)
    serve()
    serve()  # nothing new
    read = lambda name: spark.read.parquet(f"{base}/{name}")
    assert {tuple(r) for r in read("records").select("id", "label").collect()} == {(1, "benign"), (5, "jailbreak"), (6, "benign")}
    assert {tuple(r) for r in read("rejects").select("id", "reason", "n_chars").collect()} == {
        (2, "empty", 0), (3, "missing", None), (4, "too long", 10_001)
    }
    assert sorted(r.id for r in read("log").collect()) == [1, 5, 6]
    counts = serving.total_counts(read("counts"))
    assert sorted(counts.agg(F.sum("count")).first()) == [3]
    whole = serving.total_histograms(read("histograms")).where("metric = 'latency_s' AND le > 1e9")
    assert whole.agg(F.sum("bucket")).first()[0] == 3
