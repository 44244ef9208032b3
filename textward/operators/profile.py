"""Corpus profile: counts, length statistics, samples, pivots and histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textward.functions.text import CYRILLIC, char_script_ratio
from textward.operators.ordered import exact_quantiles


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def class_counts(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.groupBy(label_col).agg(F.count("*").alias("count")).orderBy(label_col)


def source_counts(df: DataFrame, source_col: str = "source") -> DataFrame:
    return (
        df.groupBy(source_col)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), source_col)
    )


def length_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Min, quartiles and max of the text length; quartiles are observed values, the median is not."""
    return exact_quantiles(
        df.select(F.length(text_col).alias("chars")),
        "chars",
        {
            "min": (0.0, "nearest"),
            "q25": (0.25, "nearest"),
            "median": (0.5, "linear"),
            "q75": (0.75, "nearest"),
            "max": (1.0, "nearest"),
        },
        whole_numbers=True,
    )


def sample_per_label(
    df: DataFrame, n: int = 5, *, id_col: str, label_col: str = "label"
) -> DataFrame:
    """First ``n`` rows per label by id; every task passes on at most ``n`` rows per label."""
    rank = F.row_number().over(Window.partitionBy(label_col).orderBy(id_col))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def split_by_label(df: DataFrame, labels: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Rows per split, one column per label; a missing combination is null."""
    return (
        df.groupBy("split").pivot("label", list(labels)).agg(F.count(F.lit(1))).orderBy("split")
    ).select("split", *[F.col(str(x)).alias(f"label_{x}") for x in labels])


def source_by_split(
    df: DataFrame, splits: tuple[str, ...] = ("train", "val", "test")
) -> DataFrame:
    """Rows per source, one column per split; a missing combination is 0."""
    return (
        df.groupBy("source")
        .pivot("split", list(splits))
        .agg(F.count(F.lit(1)))
        .fillna(0, list(splits))
        .orderBy("source")
    )


def subcategory_counts(df: DataFrame, source: str) -> DataFrame:
    return (
        df.where(F.col("source") == source)
        .groupBy("subcategory")
        .agg(F.count("*").alias("count"))
        .orderBy("subcategory")
    )


def length_histogram(
    df: DataFrame,
    *,
    by: str = "label",
    text_col: str = "text",
    upper: int = 1500,
    bins: int = 40,
    data_range: bool = False,
) -> DataFrame:
    """Rows per length bin 1..``bins``; longer texts count as ``upper``.

    The bins divide [0, ``upper``], so groups compare bin by bin; with ``data_range`` they divide
    each group's own range instead. Lengths are counted first, at most ``upper + 1`` per group.
    """
    clipped = F.least(F.length(text_col), F.lit(upper)).alias("chars")
    counts = df.select(by, clipped).groupBy(by, "chars").agg(F.count("*").alias("n"))
    lo, hi = F.lit(0.0), F.lit(float(upper))
    if data_range:
        group = Window.partitionBy(by)
        low, high = F.min("chars").over(group), F.max("chars").over(group)
        # A single value gets a range of 1 around it.
        pad = F.when(low == high, 0.5).otherwise(0.0)
        counts = counts.withColumns({"_lo": low - pad, "_hi": high + pad})
        lo, hi = F.col("_lo"), F.col("_hi")
    bin_no = F.least(F.width_bucket(F.col("chars").cast("double"), lo, hi, F.lit(bins)), F.lit(bins))
    return counts.groupBy(by, bin_no.cast("int").alias("bin")).agg(F.sum("n").alias("count"))


def length_percentiles(df: DataFrame, *, by: str = "label", text_col: str = "text") -> DataFrame:
    """Median and 95th percentile of the length per group, truncated to whole characters."""
    q = exact_quantiles(
        df.select(by, F.length(text_col).alias("chars")),
        "chars",
        {"median": (0.5, "linear"), "p95": (0.95, "linear")},
        by=[by],
        whole_numbers=True,
    )
    return q.select(by, F.col("median").cast("int").alias("median"), F.col("p95").cast("int").alias("p95"))


def script_ratio_stats(
    df: DataFrame, *, by: str = "label", text_col: str = "text", script: str = CYRILLIC
) -> DataFrame:
    """Mean, median and sample standard deviation of the script share per group."""
    ratios = df.select(by, char_script_ratio(text_col, script).alias("ratio"))
    wanted = {"mean": "mean", "median": (0.5, "linear"), "std": "std"}
    out = exact_quantiles(ratios, "ratio", wanted, by=[by])
    return out.select(by, *[F.round(c, 3).alias(c) for c in wanted])
