"""Leakage-free splits by text hash, and dataset versions from content."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textward.functions.text import group_hash, hash_bucket

SPLITS = ("train", "val", "test")


# The usual parts of train, val and test.
PARTS = (0.7, 0.15, 0.15)


def split_of(text: Column | str, parts: Sequence[float] = PARTS) -> Column:
    """Split of a text; texts that normalize alike always share it. A narrow expression.

    The hash places a text between 0 and 1; each split owns a stretch as long as its part.
    """
    if len(parts) != len(SPLITS) or min(parts) < 0 or not math.isclose(math.fsum(parts), 1):
        raise ValueError(f"one part of the whole for each of {SPLITS}, not {tuple(parts)}")
    place = hash_bucket(group_hash(text)) / F.lit(10_000.0)
    owner = F.lit(SPLITS[-1])
    for name, end in reversed([*zip(SPLITS, accumulate(parts))][:-1]):
        owner = F.when(place < F.lit(end), name).otherwise(owner)
    return owner


def assign_split(
    df: DataFrame,
    parts: Sequence[float] = PARTS,
    *,
    text_col: str = "text",
    split_col: str = "split",
) -> DataFrame:
    return df.withColumn(split_col, split_of(text_col, parts))


def leaked_groups(df: DataFrame, *, text_col: str = "text", split_col: str = "split") -> DataFrame:
    """Groups of equal text found in more than one split; empty when there is no leakage."""
    return (
        df.groupBy(group_hash(text_col).alias("group_hash"))
        .agg(F.min(split_col).alias("first_split"), F.max(split_col).alias("last_split"))
        .where(F.col("first_split") != F.col("last_split"))
    )


def split_digests(df: DataFrame, content: list[str], *, split_col: str = "split") -> DataFrame:
    """``split, digest, n_rows``: a content hash per split, independent of row order and partitioning.

    Row hashes are summed, so the reduction happens before the shuffle and equal rows count twice.
    """
    joined = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in content])
    row_hash = F.conv(F.left(F.sha2(joined, 256), F.lit(15)), 16, 10).cast("decimal(38,0)")
    return (
        df.groupBy(split_col)
        .agg(F.sum(row_hash).alias("_sum"), F.count("*").alias("_n"))
        .select(
            split_col,
            F.sha2(
                F.concat_ws(":", F.col("_sum").cast("string"), F.col("_n").cast("string")), 256
            ).alias("digest"),
            F.col("_n").alias("n_rows"),
        )
    )


def data_version(df: DataFrame, content: list[str], *, split_col: str = "split") -> DataFrame:
    """Twelve hex digits that change when any split's content does (one row)."""
    digests = split_digests(df, content, split_col=split_col)
    return digests.agg(
        F.left(
            F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), "|"), 256), F.lit(12)
        ).alias("data_version")
    )
