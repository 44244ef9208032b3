"""Exact-size seeded samples, class balance and stage counts.

A sample of ``n`` rows is a filter, not a sort: rows are ranked by a uniform hash of their id, the
rank-``n`` hash is located from the counts of its leading digits, and every row up to it is kept.
Text never moves, and the result keeps the input's partitioning.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from textward.functions.sampling import sample_key
from textward.sources.store import materialize

# Leading hex digits that slice the key space: 65 536 equal slices.
_SLICE_DIGITS = 4


def _first_n(df: DataFrame, n: int, id_col: str, seed: int) -> Column:
    """Condition that holds for the ``n`` rows of ``df`` with the smallest keys.

    The bound is a scalar subquery, so applying it to a table needs neither a join nor a shuffle.
    """
    if n <= 0:
        return F.lit(False)
    key = sample_key(id_col, seed)
    keyed = df.select(F.col(id_col).alias("_id"), key.alias("_key")).withColumn(
        "_slice", F.left("_key", F.lit(_SLICE_DIGITS))
    )
    # At most 65 536 rows: a running count over them is small work for one task.
    one_task = Window.partitionBy(F.lit(0))
    counts = keyed.groupBy("_slice").agg(F.count("*").alias("_cnt"))
    before = F.col("_upto") - F.col("_cnt")
    edge = (
        counts.withColumn("_upto", F.sum("_cnt").over(one_task.orderBy("_slice")))
        .where((before < n) & (F.col("_upto") >= n))
        .select("_slice", (n - before).alias("_left"))
    )
    # One slice of the keys, which are uniform: a 65 536th of the ids.
    rank = F.row_number().over(one_task.orderBy("_key", "_id"))
    cut = (
        keyed.where(F.col("_slice") == edge.select("_slice").scalar())
        .withColumn("_rank", rank)
        .where(F.col("_rank") == edge.select("_left").scalar())
        .select(F.struct("_key", "_id"))
        .scalar()
    )
    # No bound means that n reaches past the last row.
    return cut.isNull() | (F.struct(key.alias("_key"), F.col(id_col).alias("_id")) <= cut)


def sample_exact(df: DataFrame, n: int, *, id_col: str, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, without replacement; ``id_col`` must be unique."""
    return df.where(_first_n(df, n, id_col, seed))


def shuffled(
    df: DataFrame, *, id_col: str, seed: int = 42, key_col: str = "shuffle_key"
) -> DataFrame:
    """Add the key of a seeded full shuffle; order by ``key_col, id`` when writing."""
    return df.withColumn(key_col, sample_key(id_col, seed))


def balance_targets(n_pos: int, n_neg: int, target_ratio: float) -> tuple[int, int]:
    """Rows to keep of each class so that positives make up ``target_ratio``."""
    share = Fraction(str(target_ratio))
    # The class that runs out first decides how many rows there can be.
    whole = min(n_pos / share, n_neg / (1 - share))
    return math.floor(whole * share), math.floor(whole * (1 - share))


def _class_bounds(
    df: DataFrame, targets: dict[int, int], slices: DataFrame, id_col: str, label_col: str, seed: int
) -> dict[int, Column]:
    """Per class the greatest ``struct(_key, _id)`` among its first rows by key.

    ``slices`` counts the keys of each class by their leading digits. It names one slice per class,
    and one read of the table finds the bounds of all classes in theirs.
    """
    wanted = F.create_map(*[F.lit(x).cast("bigint") for pair in targets.items() for x in pair])
    label = F.col("_label").cast("bigint")
    before = F.col("_upto") - F.col("_cnt")
    upto = F.sum("_cnt").over(Window.partitionBy("_label").orderBy("_slice"))
    edges = (
        slices.where(label.isin(list(targets)))
        .withColumns({"_upto": upto, "_n": wanted[label]})
        .where((before < F.col("_n")) & (F.col("_upto") >= F.col("_n")))
        .select("_label", "_slice", (F.col("_n") - before).alias("_left"))
        .collect()
    )
    key = sample_key(id_col, seed)
    inside = F.lit(False)
    left = F.lit(None).cast("bigint")
    for e in edges:
        here = (F.col(label_col) == e["_label"]) & key.startswith(e["_slice"])
        inside, left = inside | here, F.when(here, F.lit(e["_left"])).otherwise(left)
    rank = F.row_number().over(Window.partitionBy("_label").orderBy("_key", "_id"))
    found = (
        df.where(inside)
        .select(
            F.col(label_col).alias("_label"), key.alias("_key"), F.col(id_col).alias("_id"), left.alias("_left")
        )
        .withColumn("_rank", rank)
        .where("_rank = _left")
        .collect()
    )
    kind = df.schema[id_col].dataType
    return {
        r["_label"]: F.struct(F.lit(r["_key"]).alias("_key"), F.lit(r["_id"]).cast(kind).alias("_id"))
        for r in found
    }


def balance_classes(
    df: DataFrame,
    target_ratio: float = 0.5,
    *,
    id_col: str,
    label_col: str = "label",
    seed: int = 42,
) -> DataFrame:
    """Downsample the larger class; unchanged when a class is missing.

    The smaller class is always kept whole. One aggregate over (class, slice of keys) gives the
    sizes and where each bound lies, a second read the bounds; the result is a filter with literals.
    """
    label = F.col(label_col)
    key = sample_key(id_col, seed)
    slices = materialize(
        df.where(label.isin(0, 1))
        .groupBy(label.alias("_label"), F.left(key, F.lit(_SLICE_DIGITS)).alias("_slice"))
        .agg(F.count("*").alias("_cnt")),
        "class-slices",
    )
    sizes = {r["_label"]: r["n"] for r in slices.groupBy("_label").agg(F.sum("_cnt").alias("n")).collect()}
    if len(sizes) < 2:
        return df
    keep = dict(zip((1, 0), balance_targets(sizes[1], sizes[0], target_ratio)))
    cut = {v: n for v, n in keep.items() if n < sizes[v]}
    bounds = _class_bounds(df, cut, slices, id_col, label_col, seed) if cut else {}
    place = F.struct(key.alias("_key"), F.col(id_col).alias("_id"))

    def kept(value: int) -> Column:
        if value not in cut:
            return label == value
        return (label == value) & (place <= bounds[value] if value in bounds else F.lit(False))

    return df.where(kept(1) | kept(0))


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows left after each stage, one row per stage in order."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), "n_rows"
        )
        for i, (name, df) in enumerate(stages.items())
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def observed_counts(spark: SparkSession, stages: dict[str, Observation]) -> DataFrame:
    """As ``stage_counts`` from ``n_rows`` that the stages' own writes have observed.

    An observation has to sit in the stage that writes, where a task counts once however often it
    is tried.
    """
    rows = [(i, name, seen.get["n_rows"]) for i, (name, seen) in enumerate(stages.items())]
    return spark.createDataFrame(rows, "step int, stage string, n_rows bigint")
