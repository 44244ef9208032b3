"""Prompt variants from templates.

Templates are program configuration (a short list), so a seed is expanded inside its own row with
an array of templates and no join takes place.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

@dataclass(frozen=True)
class Template:
    """``body`` holds ``{seed}`` where the seed text goes; a None body always fails."""

    name: str
    category: str
    body: str | None
    needs_model: bool = False


def select_templates(
    templates: Iterable[Template], categories: Iterable[str] = ()
) -> list[Template]:
    """Templates without a model, of the requested categories; no categories means all."""
    wanted = set(categories)
    return [t for t in templates if not t.needs_model and (not wanted or t.category in wanted)]


def generate_variants(
    seeds: DataFrame,
    templates: Iterable[Template],
    *,
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every seed with every template; pairs without a usable result are left out."""
    rows = [
        F.struct(
            F.lit(t.category).alias("attack_name"),
            F.lit(t.name).alias("attack_class"),
            F.lit(t.body).cast("string").alias("body"),
        )
        for t in templates
    ]
    if not rows:
        rows_col = F.array().cast("array<struct<attack_name:string,attack_class:string,body:string>>")
    else:
        rows_col = F.array(*rows)
    return (
        seeds.select(*keep, F.col(text_col).alias("seed_text"), F.explode(rows_col).alias("t"))
        .select(
            *keep,
            "seed_text",
            "t.attack_name",
            "t.attack_class",
            F.replace("t.body", F.lit("{seed}"), F.col("seed_text")).alias("attack_text"),
        )
        .where(F.col("attack_text") != "")
    )
