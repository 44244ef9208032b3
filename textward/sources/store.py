"""Shared-storage tables: scratch results, versioned publishing, compute-once features."""

from __future__ import annotations

import atexit
import datetime as dt
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.operators.splitting import split_digests


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: the session's checkpoint directory.

    A local session without the setting uses a folder in its warehouse.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            sc.setCheckpointDir(configured)
        elif sc.master.startswith("local"):
            warehouse = spark.conf.get("spark.sql.warehouse.dir")
            sc.setCheckpointDir(f"{warehouse}/_scratch")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_scratch: list[tuple[SparkSession, str]] = []


def _drop_at_exit(spark: SparkSession, path: str) -> None:
    if not _scratch:
        atexit.register(drop_scratch)
    _scratch.append((spark, path))


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    if spark.sparkContext._jsc is None or jvm is None:
        return
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch() -> None:
    """Delete the tables that ``materialize`` has written; runs when the driver's program ends.

    Results that still read them have to be stored before.
    """
    while _scratch:
        _delete(*_scratch.pop())


# The tables of the innermost ``temporary``.
_inside: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("_inside", default=None)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and survives lost executors; unlike a checkpoint the result keeps column
    pruning and true size statistics.
    """
    path = _scratch_table(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, key: str, name: str = "step") -> DataFrame:
    """As ``materialize``, in buckets of ``key``: joins on it read the table where it lies.

    There are as many buckets as shuffle partitions, so the other side of a join meets them without
    a shuffle of this table. The name in the catalog is only needed to read the buckets as such.
    """
    spark = df.sparkSession
    path = _scratch_table(spark, name)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"textward_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .option("path", path)
        .format("parquet")
        .saveAsTable(table)
    )
    written = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return written


def _scratch_table(spark: SparkSession, name: str) -> str:
    path = scratch_path(spark, name)
    _drop_at_exit(spark, path)
    if (tables := _inside.get()) is not None:
        tables.append((spark, path))
    return path


@contextmanager
def temporary() -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Delete the tables that ``materialize`` writes inside as soon as the block ends.

    The yielded function materializes what is read after the block. Its tables belong to the
    surrounding block, if there is one.
    """
    outer, tables = _inside.get(), []

    def keep(df: DataFrame, name: str = "step") -> DataFrame:
        token = _inside.set(outer)
        try:
            return materialize(df, name)
        finally:
            _inside.reset(token)

    token = _inside.set(tables)
    try:
        yield keep
    finally:
        _inside.reset(token)
        for table in tables:
            _delete(*table)
            _scratch.remove(table)


def day_folders(spark: SparkSession, base: str, last: dt.date, days: int) -> list[str] | None:
    """Existing folders ``date=...`` of ``days`` dates up to ``last``, each asked for by name.

    None for a table that a stream's file sink has written: its own log names the committed files,
    so no folder is listed there, and files of failed attempts lie beside them.
    """
    jvm = spark.sparkContext._jvm
    path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}")
    fs = path("x").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path("_spark_metadata")):
        return None
    names = [f"date={last - dt.timedelta(days=back)}" for back in reversed(range(days))]
    return [path(n).toString() for n in names if fs.exists(path(n))]


GAUGE = "ts timestamp, family string, value double, date date, job string, run bigint"


def append_gauge(gauge: DataFrame, base: str, job: str) -> None:
    """Add a run's samples ``ts, family, value`` to the metric table ``base``.

    A partition holds one job's samples of one instant, so a run that is done again replaces its own
    rows and adds none.
    """
    second = F.unix_seconds("ts")
    (
        gauge.select(
            "ts",
            "family",
            "value",
            F.date_from_unix_date(F.floor(second / 86_400).cast("int")).alias("date"),
            F.lit(job).alias("job"),
            second.alias("run"),
        )
        .write.partitionBy("date", "job", "run")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(base)
    )


def read_gauge(spark: SparkSession, base: str, now: dt.datetime, days: int = 8) -> DataFrame:
    """Samples that can lie within ``days`` times 24 hours before ``now``; no other date is listed.

    A table that doesn't exist yet has none.
    """
    folders = day_folders(spark, base, now.astimezone(dt.UTC).date(), days + 1)
    if not folders:
        return spark.createDataFrame([], GAUGE)
    return spark.read.schema(GAUGE).option("basePath", base).parquet(*folders)


def write_stage(df: DataFrame, path: str) -> None:
    """A stage's canonical output, replacing an earlier one."""
    df.write.mode("overwrite").parquet(path)


def _read_manifest(spark: SparkSession, base: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(f"{base}/manifest")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


_PUBLISHED = (
    "data_version string, split string, n_rows bigint, digest string, published_at timestamp"
)


def publish_splits(
    df: DataFrame, base: str, data_version: str, *, split_col: str = "split"
) -> DataFrame:
    """Publish the splits of one version, skipping those already committed with equal content.

    Content is compared by a digest that doesn't depend on row order. A split counts as committed
    only once the manifest names it, and a partition is replaced as a whole, so a job that died
    half-way is simply run again. Returns ``split, n_rows, status``.
    """
    spark = df.sparkSession
    row = F.to_json(F.struct(*sorted(df.columns))).alias("_row")
    sizes = split_digests(df.select(split_col, row), ["_row"], split_col=split_col).collect()
    counts = {r[split_col]: r["n_rows"] for r in sizes}
    digests = {r[split_col]: r["digest"] for r in sizes}
    done = {
        r["split"]: r["digest"]
        for r in _read_manifest(spark, base, _PUBLISHED)
        .where(F.col("data_version") == data_version)
        .groupBy("split")
        .agg(F.max_by("digest", "published_at").alias("digest"))
        .collect()
    }
    todo = sorted(s for s, digest in digests.items() if done.get(s) != digest)
    if todo:
        (
            df.where(F.col(split_col).isin(todo))
            .withColumnRenamed(split_col, "split")
            .withColumn("data_version", F.lit(data_version))
            .write.partitionBy("data_version", "split")
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .parquet(f"{base}/data")
        )
        now = dt.datetime.now(dt.UTC)
        spark.createDataFrame(
            [(data_version, s, counts[s], digests[s], now) for s in todo], _PUBLISHED
        ).coalesce(1).write.mode("append").parquet(f"{base}/manifest")
    return spark.createDataFrame(
        [(s, n, "uploaded" if s in todo else "skipped") for s, n in sorted(counts.items())],
        "split string, n_rows bigint, status string",
    )


def feature_key(data_version: str, model: str, revision: str | None, split: str) -> str:
    return f"{data_version}__{model}__{revision or 'latest'}__{split}".replace("/", "_")


def compute_once(
    spark: SparkSession, base: str, key: str, compute: Callable[[], DataFrame]
) -> DataFrame:
    """Features stored under ``key``; ``compute`` runs only when the key is not yet committed.

    The rows carry their own id, so nothing depends on row positions.
    """
    committed = _read_manifest(spark, base, "key string").where(F.col("key") == key)
    path = f"{base}/{key}"
    if committed.isEmpty():
        compute().write.mode("overwrite").parquet(path)
        spark.createDataFrame([(key,)], "key string").coalesce(1).write.mode("append").parquet(
            f"{base}/manifest"
        )
    return spark.read.parquet(path)
