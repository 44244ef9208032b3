"""The canonical corpus table: six fixed columns, any extra columns tolerated."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parquet cannot hold an empty struct, so the empty table's ``meta`` has one placeholder field.
CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("label", T.ByteType()),
        T.StructField("source", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("meta", T.StructType([T.StructField("orig_source", T.StringType())])),
    ]
)

CANONICAL_COLUMNS = CANONICAL_SCHEMA.fieldNames()


def empty_canonical(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CANONICAL_SCHEMA)


def schema_errors(df: DataFrame) -> list[str]:
    """What keeps ``df`` from being canonical; looks at the schema only and runs no job."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = sorted(set(CANONICAL_COLUMNS) - set(have))
    if missing:
        return [f"missing columns: {missing}"]
    errors = []
    for want in CANONICAL_SCHEMA.fields:
        got = have[want.name]
        if isinstance(want.dataType, T.StructType):
            if not isinstance(got, T.StructType):
                errors.append(f"{want.name} must be struct, got {got.simpleString()}")
        elif got != want.dataType:
            errors.append(
                f"{want.name} must be {want.dataType.simpleString()}, got {got.simpleString()}"
            )
    return errors


def validate_schema(df: DataFrame) -> DataFrame:
    """Return ``df`` unchanged, or raise ``ValueError`` naming the offending columns."""
    errors = schema_errors(df)
    if errors:
        raise ValueError("; ".join(errors))
    return df


def canonical(
    df: DataFrame,
    *,
    text: Column,
    label: Column,
    source: Column,
    subcategory: Column,
    lang: Column,
    meta: Column,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Project ``df`` to the canonical columns, plus the ``keep`` columns such as an id."""
    return validate_schema(
        df.select(
            *keep,
            text.alias("text"),
            label.cast("byte").alias("label"),
            source.cast("string").alias("source"),
            subcategory.cast("string").alias("subcategory"),
            lang.cast("string").alias("lang"),
            meta.alias("meta"),
        )
    )


def merge_all(dfs: list[DataFrame], spark: SparkSession | None = None) -> DataFrame:
    """Union by name; ``meta`` structs are merged field by field, missing fields become null."""
    if not dfs:
        return empty_canonical(spark or SparkSession.active())
    return validate_schema(
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    )


def tag_union(parts: dict[str, DataFrame], tag: str = "split") -> DataFrame:
    """Union of named tables with the name in a literal column."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
