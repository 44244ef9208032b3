"""From source tables to a balanced, leakage-free, split corpus."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from textward.operators.dedup import DEFAULT_THRESHOLD, near_survivors, text_digest
from textward.operators.sampling import balance_classes, observed_counts
from textward.operators.splitting import PARTS, assign_split
from textward.sources.store import materialize


@dataclass(frozen=True)
class Corpus:
    rows: DataFrame
    funnel: DataFrame


def build_corpus(
    merged: DataFrame,
    *,
    id_col: str,
    threshold: float = DEFAULT_THRESHOLD,
    near_duplicates: bool = True,
    target_ratio: float = 0.5,
    parts: Sequence[float] = PARTS,
    seed: int = 42,
) -> Corpus:
    """Dedup, balance and split a merged canonical table.

    The stages decide on ids and labels only; whole rows are joined to the final ids once, and the
    split is an expression on top of that. The funnel is counted by the tasks that write the stages.
    """
    read, left = Observation(), Observation()
    if near_duplicates:
        unique = near_survivors(
            merged, id_col=id_col, threshold=threshold, keep=("label",), observation=read
        )
    else:
        counted = materialize(
            merged.select(id_col, "label", text_digest("text").alias("_digest")).observe(
                read, F.count(F.lit(1)).alias("n_rows")
            ),
            "text-digests",
        )
        firsts = counted.groupBy("_digest").agg(F.min(id_col).alias(id_col)).select(id_col)
        unique = counted.select(id_col, "label").join(firsts, id_col, "left_semi")
    unique = materialize(unique.observe(left, F.count(F.lit(1)).alias("n_rows")), "unique-ids")
    last = Observation()
    kept = materialize(
        balance_classes(unique, target_ratio, id_col=id_col, seed=seed)
        .select(id_col)
        .observe(last, F.count(F.lit(1)).alias("n_rows")),
        "balanced-ids",
    )
    rows = assign_split(merged.join(kept, id_col, "left_semi"), parts)
    stages = {"merged": read, "deduped": left, "balanced": last}
    return Corpus(rows, observed_counts(merged.sparkSession, stages))
