"""The test tables in the roles the operators expect, in Spark and in SQL.

The tables hold no Cyrillic, so script-dependent queries look for Latin letters with diacritics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.operators.monitor import utc_timestamp

SCRIPT = "À-ɏ"
# The same in RE2 syntax.
SQL_SCRIPT = r"\x{c0}-\x{24f}"
SQL_SPACE = r"[\t-\r\x1c-\x1f\x{85}\pZ]+"

SEED = 42


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as canonical rows with ``doc_id``; unlabelled documents have a null label."""
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        "text",
        F.col("toxic").cast("byte").alias("label"),
        "source",
        F.col("lang").alias("subcategory"),
        "lang",
        F.struct(F.col("source").alias("orig_source")).alias("meta"),
    )


CORPUS = """corpus AS (
  SELECT d.doc_id, d.text, l.toxic AS label, d.source, d.lang AS subcategory, d.lang
  FROM documents d LEFT JOIN labels l USING (doc_id)
)"""


def sql_norm(text: str) -> str:
    return rf"trim(regexp_replace(lower({text}), '{SQL_SPACE}', ' ', 'g'))"


def sql_bucket(text: str) -> str:
    digest = f"substr(sha256({sql_norm(text)}), 1, 16)"
    return f"(('0x' || {digest})::UBIGINT % 10000)::INT"


def sql_split(text: str) -> str:
    share = f"{sql_bucket(text)} / 10000.0::DOUBLE"
    return (
        f"CASE WHEN {share} < 0.7 THEN 'train' WHEN {share} < {0.7 + 0.15} THEN 'val' "
        "ELSE 'test' END"
    )


def sql_sample_key(id_sql: str, seed: int = SEED) -> str:
    return f"md5('{seed}|' || ({id_sql})::VARCHAR)"


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Events in the role of predictions."""
    return as_predictions(table(spark, sf, "events"))


def as_predictions(events: DataFrame) -> DataFrame:
    family = F.concat(F.lit("fam"), (F.col("user_id") % 3).cast("string"))
    return events.select(
        "event_id",
        utc_timestamp("ts").alias("ts"),
        family.alias("family"),
        F.when(F.col("event_type") == "error", "jailbreak").otherwise("benign").alias("label"),
        (F.lit(0.5) + (F.col("value") % 50) / F.lit(100.0)).alias("confidence"),
        (F.col("value") / F.lit(100.0)).alias("latency_s"),
        F.col("props").alias("text"),
        F.concat(F.lit("model-"), family).alias("namespace"),
        (F.col("event_type") == "signup").alias("is_error"),
        F.floor(F.col("event_id") / 3).cast("bigint").alias("request_id"),
        "value",
    )


PREDICTIONS = """predictions AS (
  SELECT event_id, ts, 'fam' || (user_id % 3)::VARCHAR AS family,
         CASE WHEN event_type = 'error' THEN 'jailbreak' ELSE 'benign' END AS label,
         0.5::DOUBLE + (value % 50) / 100.0::DOUBLE AS confidence,
         value / 100.0::DOUBLE AS latency_s, props AS text,
         'model-fam' || (user_id % 3)::VARCHAR AS namespace,
         event_type = 'signup' AS is_error, event_id // 3 AS request_id, value
  FROM events
)"""


def stream_of(
    spark: SparkSession, sf: str, name: str, session: SparkSession | None = None
) -> DataFrame:
    """A table as a stream of its file, or of the files in its folder.

    The path is a pattern that only the table matches: a stream takes a plain path for a folder's,
    and a name filter on the folder above would skip the files of a table that is a folder.

    A stream's state has as many partitions as its session shuffles into; the stream gets a session
    with one per core, since the default of hundreds costs more than these streams' rows.
    """
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    if session is None:
        session = spark.newSession()
        session.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    return session.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


def scored_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with a deterministic score in thousandths, so ties occur."""
    labels = table(spark, sf, "labels")
    docs = table(spark, sf, "documents").select("doc_id", "source")
    draw = F.conv(F.left(F.md5(F.col("doc_id").cast("string")), F.lit(8)), 16, 10).cast("bigint")
    score = (draw % 1000) / F.lit(1000.0)
    other = (F.floor(draw / 1000) % 1000) / F.lit(1000.0)
    return labels.join(docs, "doc_id").select(
        "doc_id",
        "source",
        F.col("toxic").alias("y_true"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("pred_a"),
        (other >= 0.5).cast("int").alias("pred_b"),
        other.alias("score_b"),
    )


SCORED = """scored AS (
  SELECT doc_id, source, y_true, score, other AS score_b,
         (score >= 0.5)::INT AS pred_a, (other >= 0.5)::INT AS pred_b
  FROM (
    SELECT l.doc_id, d.source, l.toxic AS y_true,
           (draw % 1000) / 1000.0::DOUBLE AS score, (draw // 1000 % 1000) / 1000.0::DOUBLE AS other
    FROM (SELECT *, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT AS draw FROM labels) l
    JOIN documents d USING (doc_id)
  )
)"""
