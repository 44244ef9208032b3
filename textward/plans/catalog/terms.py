"""TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.operators.tfidf import Tfidf, TfidfModel, term_statistics
from textward.plans.catalog.tables import table
from textward.sources.store import scratch_path

MAX_FEATURES = Tfidf().max_features


def _fit(spark: SparkSession, sf: str) -> TfidfModel:
    return Tfidf(max_features=MAX_FEATURES).fit(table(spark, sf, "documents"), id_col="doc_id")


def _rounded(weights: DataFrame) -> DataFrame:
    return weights.withColumn("weight", F.round("weight", 6))


def statistics(spark: SparkSession, sf: str) -> DataFrame:
    return term_statistics(table(spark, sf, "documents"), id_col="doc_id")


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return _fit(spark, sf).vocab.select(
        "term", F.col("idx").cast("bigint").alias("idx"), "tf", "df", F.round("idf", 6).alias("idf")
    )


def weights(spark: SparkSession, sf: str) -> DataFrame:
    rows = _fit(spark, sf).weights(table(spark, sf, "documents"), id_col="doc_id")
    return _rounded(rows).select("doc_id", "term", "weight")


def unseen(spark: SparkSession, sf: str) -> DataFrame:
    talks = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("msg_id"), "text"
    )
    return _rounded(_fit(spark, sf).weights(talks, id_col="msg_id")).select("msg_id", "term", "weight")


def reloaded(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "vocabulary-model")
    _fit(spark, sf).save(path)
    back = TfidfModel.load(spark, path)
    rows = back.weights(table(spark, sf, "benchmark"), id_col="item_id")
    return _rounded(rows).select("item_id", "term", "weight")


def vocabulary_size(spark: SparkSession, sf: str) -> DataFrame:
    model = Tfidf().fit(table(spark, sf, "documents"), id_col="doc_id")
    return model.vocab.agg(F.count("*").alias("vocab_size"))


QUERIES = {
    "f01_term_statistics": statistics,
    "f02_vocabulary": vocabulary,
    "f03_tfidf_weights": weights,
    "f04_transform_unseen": unseen,
    "f05_saved_vocabulary": reloaded,
    "f06_vocabulary_size": vocabulary_size,
}


def _sql_terms(name: str, relation: str, id_sql: str, id_name: str) -> str:
    return rf"""{name}_tokens AS (
  SELECT {id_sql} AS {id_name}, regexp_extract_all(lower(text), '[\pL\pN_]{{2,}}') AS t FROM {relation}
),
{name} AS (
  SELECT {id_name}, term, count(*) AS tf FROM (
    SELECT {id_name}, unnest(t || [t[i] || ' ' || t[i + 1] FOR i IN range(1, len(t))]) AS term
    FROM {name}_tokens
  ) GROUP BY ALL
)"""


_STATS = (
    _sql_terms("doc_terms", "documents", "doc_id", "doc_id")
    + """,
stats AS (SELECT term, sum(tf)::BIGINT AS tf, count(*) AS df FROM doc_terms GROUP BY term)"""
)


def _sql_vocab(max_features: int) -> str:
    return f"""{_STATS},
vocab AS (
  SELECT term, tf, df, ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf
  FROM stats WHERE df >= 2 ORDER BY tf DESC, term LIMIT {max_features}
)"""


def _sql_weights(terms: str, id_name: str) -> str:
    return f"""
, raw AS (SELECT {id_name}, term, (1 + ln(t.tf)) * idf AS w FROM {terms} t JOIN vocab USING (term))
SELECT {id_name}, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY {id_name})), 6) AS weight FROM raw"""


ORACLES = {
    "f01_term_statistics": f"WITH {_STATS} SELECT term, tf, df FROM stats",
    "f02_vocabulary": f"""
WITH {_sql_vocab(MAX_FEATURES)}
SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, tf, df, round(idf, 6) AS idf FROM vocab""",
    "f03_tfidf_weights": f"WITH {_sql_vocab(MAX_FEATURES)}" + _sql_weights("doc_terms", "doc_id"),
    "f04_transform_unseen": f"WITH {_sql_vocab(MAX_FEATURES)}, "
    + _sql_terms("new_terms", "conversations", "conv_id * 1000 + turn", "msg_id")
    + _sql_weights("new_terms", "msg_id"),
    "f05_saved_vocabulary": f"WITH {_sql_vocab(MAX_FEATURES)}, "
    + _sql_terms("new_terms", "benchmark", "item_id", "item_id")
    + _sql_weights("new_terms", "item_id"),
    "f06_vocabulary_size": f"WITH {_sql_vocab(50_000)} SELECT count(*) AS vocab_size FROM vocab",
}
