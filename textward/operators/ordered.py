"""Running totals and exact quantiles over values of any cardinality.

Rows are first counted per distinct value, which also removes hot values. The distinct values are
then cut into ordered buckets; totals run over the few buckets, and inside a bucket over its own
values, so no task ever sorts the whole value range.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textward.sources.store import materialize

_BUCKETS = 512


def integer_bucket(value: Column | str, width: int = 1024) -> Column:
    """Ordered bucket of a whole number: ``width`` neighbouring values share one."""
    v = F.col(value) if isinstance(value, str) else value
    return F.floor(v / F.lit(width))


def quantile_bucket(df: DataFrame, value: str, buckets: int = _BUCKETS) -> DataFrame:
    """``df`` with ``_bucket``: ordered buckets holding about equally many rows.

    One narrow aggregate job returns the cut points, at most ``buckets`` numbers. Infinite values
    and NaN don't shift them and fall into the outer buckets.
    """
    probs = [i / buckets for i in range(1, buckets)]
    number = F.col(value).cast("double")
    finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), F.col(value))
    cuts = df.agg(F.percentile_approx(finite, probs, 10 * buckets).alias("c")).first()["c"] or []
    inner = sorted({float(c) for c in cuts})
    splits = [float("-inf"), *inner, float("inf")]
    if len(splits) < 3:
        return df.withColumn("_bucket", F.lit(0.0))
    return Bucketizer(
        splits=splits, inputCol=value, outputCol="_bucket", handleInvalid="keep"
    ).transform(df)


def running_totals(
    counts: DataFrame, value: str, sums: list[str], by: list[str] | None = None
) -> DataFrame:
    """Per row of ``counts`` (one per ``by`` and ``value``, with ``_bucket``): running totals.

    Adds ``<c>_upto`` (this value included) and ``<c>_all`` for every column ``c`` of ``sums``.
    """
    by = list(by or [])
    totals = counts.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    # As many rows as buckets per group.
    whole = Window.partitionBy(*(by or [F.lit(0)]))
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(whole).alias(f"{c}_all") for c in sums],
    )
    inside = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    keys = [*by, "_bucket"]
    offsets = offsets.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return counts.join(offsets, same).select(
        *[c for c in counts.columns if c != "_bucket"],
        *[(F.col(f"_o_{c}") + F.sum(c).over(inside)).alias(f"{c}_upto") for c in sums],
        *[f"{c}_all" for c in sums],
    )


def bucketed_counts(counts: DataFrame, value: str) -> DataFrame:
    """``counts`` (additive columns per distinct ``value``), written once, with ordered buckets.

    Cut points come from the written table, so that what it was counted from is read once only;
    each bucket holds about equally many distinct values.
    """
    return quantile_bucket(materialize(counts, "value-counts"), value)


def value_counts(
    df: DataFrame, value: str, by: list[str] | None = None, whole_numbers: bool = False
) -> DataFrame:
    """Rows per distinct ``value`` as ``cnt``, with the ordered ``_bucket``; nulls are left out."""
    by = list(by or [])
    rows = df.select(*by, value).where(F.col(value).isNotNull())
    counts = rows.groupBy(*by, value).agg(F.count("*").alias("cnt"))
    if whole_numbers:
        return counts.withColumn("_bucket", integer_bucket(value))
    return bucketed_counts(counts, value)


def _mean(value: str) -> Column:
    return F.try_divide(F.sum(F.col(value) * F.col("cnt")), F.sum("cnt"))


def _sample_std(value: str) -> Column:
    v, n = F.col(value).cast("double"), F.sum("cnt")
    spread = F.sum(v * v * F.col("cnt")) - _mean(value) * F.sum(v * F.col("cnt"))
    return F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), n - 1))


def exact_quantiles(
    df: DataFrame,
    value: str,
    wanted: dict[str, tuple[float, str] | str],
    by: list[str] | None = None,
    whole_numbers: bool = False,
) -> DataFrame:
    """Exact quantiles and moments per group, all from one table of counts per distinct value.

    ``wanted`` maps a column name to ``(q, "linear"|"nearest")``, ``"mean"`` or ``"std"`` (sample
    standard deviation from sums of squares; null for a single row). ``df`` is read once.
    """
    by = list(by or [])
    counts = value_counts(df, value, by, whole_numbers)
    run = running_totals(counts, value, ["cnt"], by)

    def at_rank(rank: Column) -> Column:
        return F.min(F.when(F.col("cnt_upto") > rank, F.col(value)))

    last = F.col("cnt_all") - 1
    parts, outs = [], []
    for name, what in wanted.items():
        if isinstance(what, str):
            parts.append({"mean": _mean, "std": _sample_std}[what](value).alias(f"_{name}"))
            outs.append(F.col(f"_{name}").alias(name))
            continue
        q, how = what
        pos = last * F.lit(float(q))
        if how == "nearest":
            parts.append(at_rank(F.round(pos)).alias(f"_{name}"))
            outs.append(F.col(f"_{name}").alias(name))
            continue
        parts += [
            at_rank(F.floor(pos)).alias(f"_{name}_lo"),
            at_rank(F.ceil(pos)).alias(f"_{name}_hi"),
            F.max(pos - F.floor(pos)).alias(f"_{name}_w"),
        ]
        lo, hi, w = (F.col(f"_{name}_{s}") for s in ("lo", "hi", "w"))
        outs.append((lo + (hi - lo) * w).alias(name))
    grouped = run.groupBy(*by) if by else run.groupBy()
    return grouped.agg(*parts).select(*by, *outs)
