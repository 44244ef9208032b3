"""Best run per model family, champion, registered versions and deployment pins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def best_runs(
    runs: DataFrame,
    data_version: str | None = None,
    *,
    metric: str = "val_f1",
    strict: bool = False,
) -> DataFrame:
    """Best run per family: highest metric, the first run (lowest ``seq``) wins ties.

    ``runs`` has ``run_id, family, data_version, seq`` and a ``metrics`` map. Runs without a family
    or without the metric (or whose metric is NaN, a diverged run) are ignored; ``first_seq`` is the first of a family's other runs.
    ``strict`` raises when no run is left.
    """
    usable = runs if data_version is None else runs.where(F.col("data_version") == data_version)
    value = F.try_element_at("metrics", F.lit(metric))
    usable = usable.select("run_id", "family", "seq", value.alias(metric)).where(
        F.col("family").isNotNull() & (F.col("family") != "") & F.col(metric).isNotNull()
        & ~F.isnan(metric)
    )
    order = F.struct(F.col(metric), -F.col("seq"))
    best = (
        usable.groupBy("family")
        .agg(
            F.max_by(F.struct("run_id", metric, "seq"), order).alias("b"),
            F.min("seq").alias("first_seq"),
        )
        .select("family", "b.run_id", f"b.{metric}", "b.seq", "first_seq")
    )
    if strict and best.isEmpty():
        raise RuntimeError(f"no runs with a family and {metric} for data_version={data_version}")
    return best


def champion(best: DataFrame, *, metric: str = "val_f1") -> DataFrame:
    """The best of the families' best runs (at most one row); the family seen first wins ties."""
    return best.orderBy(F.desc(metric), "first_seq").limit(1)


def resolve_versions(
    best: DataFrame, versions: DataFrame, model_name: Column, *, metric: str = "val_f1"
) -> DataFrame:
    """Registered version of each family's best run, with the champion flagged.

    ``versions`` has ``run_id, model_name, version, seq``; the first match counts and families
    without one are left out.
    """
    known = versions.groupBy(F.col("run_id").alias("_run"), F.col("model_name").alias("_model")).agg(
        F.min_by("version", "seq").alias("version")
    )
    top = champion(best, metric=metric).select(F.col("family").alias("_champion"))
    return (
        best.withColumn("model_name", model_name)
        .join(known, (F.col("run_id") == F.col("_run")) & (F.col("model_name") == F.col("_model")))
        .join(top, F.col("family") == F.col("_champion"), "left")
        .select(
            "family",
            "model_name",
            "run_id",
            "version",
            F.col("_champion").isNotNull().alias("is_champion"),
        )
    )


def pin_changes(pins: DataFrame, production: DataFrame) -> DataFrame:
    """Models whose pinned version differs from the production one; both must be known.

    ``pins`` has ``model_name, pinned``, ``production`` has ``model_name, prod``.
    """
    return pins.join(production, "model_name").where(F.col("pinned") != F.col("prod"))
