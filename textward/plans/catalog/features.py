"""Scalar text functions and predicates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.functions import text as tx
from textward.plans.catalog.tables import (
    PREDICTIONS,
    SCRIPT,
    SQL_SCRIPT,
    predictions,
    sql_bucket,
    sql_norm,
    table,
)


def _per_document(**columns: Column) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return table(spark, sf, "documents").select(
            "doc_id", *[c.alias(name) for name, c in columns.items()]
        )

    return query


def _features(spark: SparkSession, sf: str) -> DataFrame:
    names = ("chars", "letters", "script_chars", "digits")
    feats = tx.char_features("text", SCRIPT)
    return (
        table(spark, sf, "documents")
        .select("doc_id", feats.alias("f"))
        .select("doc_id", *[F.col("f")[i].alias(n) for i, n in enumerate(names)])
    )


def _shingles(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", tx.char_shingles("text").alias("s"))
    return rows.select(
        "doc_id",
        F.size("s").cast("bigint").alias("n_shingles"),
        F.md5(F.array_join(F.sort_array("s"), "|")).alias("shingles_md5"),
    )


def _decoded(spark: SparkSession, sf: str) -> DataFrame:
    p = (F.col("value") % 100) / F.lit(100.0)
    return (
        predictions(spark, sf)
        .select("event_id", p.alias("p"))
        .select("event_id", tx.decode_label("p").alias("label"), tx.decode_confidence("p").alias("confidence"))
    )


def _token_query(column: Column) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = table(spark, sf, "documents").select("doc_id", column.alias("t"))
        return rows.select(
            "doc_id",
            F.size("t").cast("bigint").alias("n"),
            F.md5(F.array_join("t", "|")).alias("items_md5"),
        )

    return query


QUERIES = {
    "c01_normalize": lambda s, d: _per_document(norm=tx.normalize("text"))(s, d),
    "c02_char_shingles": _shingles,
    "c03_letter_script_ratio": lambda s, d: _per_document(
        ratio=tx.letter_script_ratio("text", SCRIPT)
    )(s, d),
    "c04_char_script_ratio": lambda s, d: _per_document(
        ratio=tx.char_script_ratio("text", SCRIPT)
    )(s, d),
    "c05_is_script": lambda s, d: _per_document(ok=tx.is_script("text", 0.1, SCRIPT))(s, d),
    "c06_length_ok": lambda s, d: _per_document(ok=tx.length_ok("text"))(s, d),
    "c07_char_features": _features,
    "c08_group_hash": lambda s, d: _per_document(group_hash=tx.group_hash("text"))(s, d),
    "c09_hash_bucket": lambda s, d: _per_document(bucket=tx.hash_bucket(tx.group_hash("text")))(s, d),
    "c10_token_estimate": lambda s, d: _per_document(tokens=tx.token_estimate("text"))(s, d),
    "c11_first_paragraph": lambda s, d: _per_document(
        first=tx.first_paragraph(F.replace("text", F.lit("\n"), F.lit("\n\n")))
    )(s, d),
    "c12_decode_score": _decoded,
    "c13_preview": lambda s, d: _per_document(preview=tx.preview("text"))(s, d),
    "c14_valid_input": lambda s, d: _per_document(ok=tx.valid_input("text"))(s, d),
    "c15_tokens": lambda s, d: _token_query(tx.tokens("text"))(s, d),
    "c16_word_ngrams": lambda s, d: _token_query(tx.word_ngrams(tx.tokens("text")))(s, d),
}

_LETTERS = r"regexp_replace(text, '[^\pL]+', '', 'g')"
_SCRIPT_LETTERS = f"(length({_LETTERS}) - length(regexp_replace({_LETTERS}, '[{SQL_SCRIPT}]+', '', 'g')))"
_LETTER_RATIO = f"coalesce({_SCRIPT_LETTERS} / nullif(length({_LETTERS}), 0), 0.0)"


def _count(char_class: str) -> str:
    return f"(length(text) - length(regexp_replace(text, '[{char_class}]+', '', 'g')))"


_TOKENS = r"regexp_extract_all(lower(text), '[\pL\pN_]{2,}')"

ORACLES = {
    "c01_normalize": f"SELECT doc_id, {sql_norm('text')} AS norm FROM documents",
    "c02_char_shingles": f"""
WITH n AS (SELECT doc_id, {sql_norm('text')} AS t FROM documents),
s AS (
  SELECT doc_id, CASE WHEN length(t) < 4 THEN [t]
    ELSE list_distinct([substr(t, i, 4) FOR i IN range(1, length(t) - 2)]) END AS s
  FROM n
)
SELECT doc_id, len(s) AS n_shingles, md5(array_to_string(list_sort(s), '|')) AS shingles_md5 FROM s""",
    "c03_letter_script_ratio": f"SELECT doc_id, {_LETTER_RATIO} AS ratio FROM documents",
    "c04_char_script_ratio": f"""
SELECT doc_id, coalesce({_count(SQL_SCRIPT)} / nullif(length(text), 0), 0.0) AS ratio FROM documents""",
    "c05_is_script": f"SELECT doc_id, {_LETTER_RATIO} >= 0.1::DOUBLE AS ok FROM documents",
    "c06_length_ok": "SELECT doc_id, length(text) BETWEEN 10 AND 4000 AS ok FROM documents",
    "c07_char_features": f"""
SELECT doc_id, length(text)::DOUBLE AS chars, {_count(chr(92) + 'pL')}::DOUBLE AS letters,
       {_count(SQL_SCRIPT)}::DOUBLE AS script_chars, {_count(chr(92) + 'p{Nd}' + tx.other_digits())}::DOUBLE AS digits
FROM documents""",
    "c08_group_hash": f"""
SELECT doc_id, substr(sha256({sql_norm('text')}), 1, 16) AS group_hash FROM documents""",
    "c09_hash_bucket": f"SELECT doc_id, {sql_bucket('text')} AS bucket FROM documents",
    "c10_token_estimate": "SELECT doc_id, length(text) / 4.0::DOUBLE AS tokens FROM documents",
    "c11_first_paragraph": """
SELECT doc_id, string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10))[1] AS first
FROM documents""",
    "c12_decode_score": f"""
WITH {PREDICTIONS}, p AS (SELECT event_id, (value % 100) / 100.0::DOUBLE AS p FROM predictions)
SELECT event_id, CASE WHEN p >= 0.5 THEN 'jailbreak' ELSE 'benign' END AS label,
       CASE WHEN p >= 0.5 THEN p ELSE 1.0::DOUBLE - p END AS confidence
FROM p""",
    "c13_preview": """
SELECT doc_id, substr(text, 1, 80) || CASE WHEN length(text) > 80 THEN '...' ELSE '' END AS preview
FROM documents""",
    "c14_valid_input": "SELECT doc_id, length(text) BETWEEN 1 AND 10000 AS ok FROM documents",
    "c15_tokens": f"""
WITH t AS (SELECT doc_id, {_TOKENS} AS t FROM documents)
SELECT doc_id, len(t) AS n, md5(array_to_string(t, '|')) AS items_md5 FROM t""",
    "c16_word_ngrams": f"""
WITH t AS (SELECT doc_id, {_TOKENS} AS t FROM documents),
g AS (SELECT doc_id, t || [t[i] || ' ' || t[i + 1] FOR i IN range(1, len(t))] AS t FROM t)
SELECT doc_id, len(t) AS n, md5(array_to_string(t, '|')) AS items_md5 FROM g""",
}
