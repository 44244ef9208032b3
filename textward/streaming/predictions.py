"""Streams of predictions: windowed counters and histograms, trailing sums, the sampled log.

The windowed operators are the batch ones with a watermark in front, so a closed window holds the
same rows in both forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textward.functions.sampling import bernoulli
from textward.functions.text import CYRILLIC, valid_input
from textward.operators import monitor

DELAY = "10 minutes"


def stream_counts(predictions: DataFrame, *, delay: str = DELAY, width: str = "1 hour") -> DataFrame:
    return monitor.prediction_counts(predictions.withWatermark("ts", delay), width)


def stream_histograms(
    predictions: DataFrame, *, delay: str = DELAY, width: str = "1 hour", script: str = CYRILLIC
) -> DataFrame:
    return monitor.prediction_histograms(predictions.withWatermark("ts", delay), width, script)


def stream_trailing_sums(
    predictions: DataFrame,
    sums: dict[str, Column],
    by: list[str],
    *,
    range_s: int,
    step_s: int = monitor.MINUTE,
    delay: str = DELAY,
) -> DataFrame:
    """Streaming form of ``monitor.trailing_sums``: tiles first, then the windows over tiles."""
    step = f"{step_s} seconds"
    tiles = (
        predictions.withWatermark("ts", delay)
        .groupBy(F.window("ts", step), *by)
        .agg(*[c.alias(n) for n, c in sums.items()])
    )
    hop = F.window(F.window_time("window"), f"{range_s} seconds", step)
    return (
        tiles.groupBy(hop.alias("w"), *by)
        .agg(*[F.sum(n).alias(n) for n in sums])
        .select(F.col("w.end").alias("eval_ts"), *by, *sums)
    )


def accepted(requests: DataFrame, text_col: str = "text") -> DataFrame:
    """Requests that may be scored."""
    return requests.where(valid_input(text_col))


def rejected(requests: DataFrame, text_col: str = "text") -> DataFrame:
    """Requests to report back, for a side table."""
    return requests.where(~valid_input(text_col))


def sampled_log(
    predictions: DataFrame, rate: float = 0.01, *, id_col: str, seed: int = 42
) -> DataFrame:
    """The share of predictions to log, with the partition date; works on tables and streams."""
    utc_date = F.date_from_unix_date(F.floor(F.unix_seconds("ts") / 86_400).cast("int"))
    return predictions.where(bernoulli(id_col, rate, seed)).withColumn("date", utc_date)


def start_table_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    partition_by: tuple[str, ...] = (),
    available_now: bool = False,
) -> StreamingQuery:
    """Append a stream to a Parquet table exactly once.

    ``available_now`` stops after the data present at the start.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def log_predictions(
    predictions: DataFrame,
    path: str,
    checkpoint: str,
    *,
    id_col: str,
    rate: float = 0.01,
    seed: int = 42,
    available_now: bool = False,
) -> StreamingQuery:
    """Sampled predictions as ``<path>/date=<UTC date>/family=<family>/``."""
    return start_table_sink(
        sampled_log(predictions, rate, id_col=id_col, seed=seed),
        path,
        checkpoint,
        partition_by=("date", "family"),
        available_now=available_now,
    )
