"""Requests to scored predictions: one read of each request, four tables.

A micro-batch is scored once. Its records, the sampled log, the rejected requests and the counters
are written from the cached rows, keyed by the batch's number, so a batch that is run again adds
nothing. Counters are sums per batch: adding up the batches of a window gives the window, late
requests included.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textward.functions.text import valid_input
from textward.operators import models, monitor
from textward.streaming.predictions import sampled_log
from textward.streaming.sinks import start_fanout


def reject_reason(text: Column) -> Column:
    """Why a request isn't scored; null if it is."""
    missing = F.when(text.isNull(), "missing").when(F.length(text) == 0, "empty")
    return F.when(~valid_input(text), missing.otherwise("too long"))


def scored_requests(
    requests: DataFrame,
    make_scorer: Callable[[], Callable[[Sequence[str]], Sequence]],
    *,
    text_col: str = "text",
) -> DataFrame:
    """Requests with ``reason`` and ``score``; rejected ones aren't sent to the model as they are."""
    text = F.col(text_col)
    marked = requests.withColumn("reason", reject_reason(text)).withColumn(
        "_valid_text", F.when(F.col("reason").isNull(), text).otherwise("")
    )
    scored = models.score_batches(marked, make_scorer, text_col="_valid_text")
    return scored.withColumn("score", F.when(F.col("reason").isNull(), F.col("score"))).drop("_valid_text")


def start_serving(
    requests: DataFrame,
    make_scorer: Callable[[], Callable[[Sequence[str]], Sequence]],
    base: str,
    checkpoint: str,
    *,
    id_col: str,
    family: str,
    model_version: str,
    data_version: str,
    rate: float = 0.01,
    seed: int = 42,
    width: str = "1 hour",
    available_now: bool = False,
) -> StreamingQuery:
    """Serve ``id, ts, text, latency_s`` into ``records, log, rejects, counts`` and ``histograms``."""

    def records(rows: DataFrame) -> DataFrame:
        accepted = rows.where("reason IS NULL").drop("reason")
        return models.prediction_records(
            accepted, family=family, model_version=model_version, data_version=data_version
        )

    def observed(rows: DataFrame) -> DataFrame:
        return records(rows).withColumnRenamed("model_family", "family")

    return start_fanout(
        scored_requests(requests, make_scorer),
        base,
        checkpoint,
        {
            "records": lambda rows: records(rows).drop("text"),
            "log": lambda rows: sampled_log(observed(rows), rate, id_col=id_col, seed=seed),
            "rejects": lambda rows: rows.where("reason IS NOT NULL").select(
                id_col, "ts", "reason", F.length("text").alias("n_chars")
            ),
            "counts": lambda rows: monitor.prediction_counts(observed(rows), width),
            "histograms": lambda rows: monitor.prediction_histograms(observed(rows), width),
        },
        partition_by={"log": ("date", "family")},
        available_now=available_now,
    )


def total_counts(counts: DataFrame) -> DataFrame:
    """Predictions per window, family and label over all batches."""
    return counts.groupBy("window_start", "family", "label").agg(F.sum("count").alias("count"))


def total_histograms(histograms: DataFrame) -> DataFrame:
    """Cumulative histograms over all batches."""
    return histograms.groupBy("window_start", "family", "metric", "le").agg(
        *[F.sum(c).alias(c) for c in ("bucket", "sum", "count")]
    )
