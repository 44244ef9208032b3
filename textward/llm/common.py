"""What several operators share: table reads, word splitting, connected components."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.plans.session import ship_package
from textward.sources.store import materialize

# A word is a run of characters other than the blank and the five ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"

T = TypeVar("T")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Rows of text that a Python worker gets at once.
TEXT_ROWS = 2000


def prepare(spark: SparkSession) -> None:
    """Ship the package, and bound the texts that a worker holds at once.

    A session that asks for another batch size than Spark's default keeps its own.
    """
    ship_package(spark)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(batch) == "10000":
        spark.conf.set(batch, TEXT_ROWS)


_PER_WORKER: dict[object, object] = {}


def per_worker(key: object, build: Callable[[], T]) -> T:
    """A value that a Python worker builds once and keeps for its later tasks."""
    if key not in _PER_WORKER:
        _PER_WORKER[key] = build()
    return _PER_WORKER[key]


def n_words(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also where lambdas name it many times."""
    return F.transform(F.array(value), use)[0]


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def join_on(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join on one column where a null key equals a null key; ``right`` gives its other columns."""
    other = right.withColumnRenamed(key, "_right_key")
    return left.join(other, left[key].eqNullSafe(other["_right_key"]), how).drop("_right_key")


def plain_names(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that clash with nothing, and the new name of each column."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))


# Keys that a skewed join broadcasts at most.
HOT_KEYS = 50_000


def join_skewed(rows: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """Inner join of ``rows`` with a written ``index`` of one row per key; ``n`` counts its rows.

    No task receives a hot key: of all rows that have a key in the index, a key with more than one
    in ``HOT_KEYS`` is broadcast, and there can't be more than ``HOT_KEYS`` of them. The other keys
    are shuffled. The result has no column ``n``.
    """
    total = index.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = F.col("n") * HOT_KEYS > total
    few = F.broadcast(index.where(hot).drop("n"))
    rest = rows.join(F.broadcast(index.where(hot).select(key)), key, "left_anti")
    return rows.join(few, key).unionByName(rest.join(index.where(~hot).drop("n"), key))


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges (a, b)``; root: smallest node.

    Every round gives each node the smallest label among itself and its neighbours and then follows
    that label one step further, so chains shrink geometrically; the rounds end when no label
    changes. All state is in tables of the shared folder, and a hub's neighbours are reduced to one
    row per task before they are shuffled.
    """
    both = materialize(
        edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges"
    )
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("root")
        ),
        "labels",
    )
    while True:
        seen = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        hooked = labels.join(seen, "node").select(
            "node", "root", F.least("root", "near").alias("low")
        )
        # Following the label: the root of a root.
        roots = labels.select(F.col("node").alias("low"), F.col("root").alias("far"))
        moved = materialize(
            hooked.join(roots, "low").select(
                "node", F.least("low", "far").alias("root"), F.col("root").alias("was")
            ),
            "labels",
        )
        labels = moved.select("node", "root")
        if moved.where("root <> was").isEmpty():
            return labels
