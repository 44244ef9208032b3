"""One stream into several tables, exactly once.

Each micro-batch is computed once, cached on disk, and written to every table under
``batch=<its number>``. A batch that is run again after a failure has the same number and replaces
what it wrote, so a table never holds a row twice, whichever of its writes had been done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

Part = Callable[[DataFrame], DataFrame]


def write_parts(
    batch: DataFrame, number: int, base: str, parts: dict[str, Part], partition_by: dict[str, tuple[str, ...]]
) -> None:
    """Write ``<base>/<name>/batch=<number>`` for each part of a micro-batch."""
    rows = batch.persist(StorageLevel.DISK_ONLY)
    try:
        for name, part in parts.items():
            writer = part(rows).write.mode("overwrite")
            if name in partition_by:
                writer = writer.partitionBy(*partition_by[name])
            writer.parquet(f"{base}/{name}/batch={number}")
    finally:
        rows.unpersist()


def start_fanout(
    stream: DataFrame,
    base: str,
    checkpoint: str,
    parts: dict[str, Part],
    *,
    partition_by: dict[str, tuple[str, ...]] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Write every part of the stream to its table below ``base``.

    A part is a function of a micro-batch's rows. ``partition_by`` names the columns that a table
    is partitioned by below its batches.
    """
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(
        lambda batch, number: write_parts(batch, number, base, parts, partition_by or {})
    ).start()


def read_part(spark: SparkSession, base: str, name: str, schema: StructType | str) -> DataFrame:
    """A table of the fan-out, without its ``batch`` column."""
    path = f"{base}/{name}"
    return spark.read.schema(schema).option("basePath", path).parquet(path).drop("batch")


def dropped_rows(query: StreamingQuery, *, since_batch: int = 0) -> DataFrame:
    """``batch, operator, n_rows``: rows that came behind the watermark and were dropped by Spark.

    From the progress that the session keeps of the query's latest batches.
    """
    spark = query.sparkSession if hasattr(query, "sparkSession") else SparkSession.active()
    rows = [
        (p["batchId"], s["operatorName"], s["numRowsDroppedByWatermark"])
        for p in query.recentProgress
        for s in p["stateOperators"]
        if s["numRowsDroppedByWatermark"] and p["batchId"] >= since_batch
    ]
    return spark.createDataFrame(rows, "batch bigint, operator string, n_rows bigint").groupBy(
        "batch", "operator"
    ).agg(F.sum("n_rows").alias("n_rows"))
