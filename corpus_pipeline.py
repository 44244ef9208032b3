"""Documents to a token corpus: stages that each apply one operator.

A stage reads all rows that its predecessor kept and returns the columns of documents; the last one
returns token ids. Rows are whole documents throughout; a document that the mix takes twice is two
rows from there on.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.llm import bpe, lines, minhash, mixing, queries
from textward.llm.common import n_words, plain_names, prepare, table
from textward.sources.store import materialize, temporary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the table's labels."""
    prepare(spark)
    score = queries.quality_score(docs, table(spark, sf_dir, "labels"))
    return docs.where(score >= queries.THRESHOLD)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated chunks of lines; one that had nothing else goes."""
    prepare(spark)
    plain, at = plain_names(docs)
    done = lines.dedup_lines(plain, id_col=at["doc_id"], text_col=at["text"])
    emptied = (F.col("_n_removed") > 0) & (F.length(F.trim("_kept")) == 0)
    text = {"text": F.col("_kept"), "n_chars": F.length("_kept").cast("bigint")}
    changed = F.col("_n_removed") > 0
    return done.where(~emptied).select(
        *[
            (F.when(changed, text[c]).otherwise(F.col(at[c])) if c in text else F.col(at[c])).alias(c)
            for c in docs.columns
        ]
    )


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five words, similarity 0.8).

    Rows are told apart by a key of their own, since ids can be null or repeated. The row with the
    lowest id stays, one without an id only if the group has no other.
    """
    prepare(spark)
    plain, at = plain_names(docs)
    keyed = materialize(plain.withColumn("_row", F.monotonically_increasing_id()), "near-rows")
    found = minhash.near_duplicates(keyed, id_col="_row", text_col=at["text"]).select(
        F.col("doc_id").alias("_key"), "component_id"
    )
    id_col = at["doc_id"]
    place = F.struct(F.col(id_col).isNull().alias("last"), id_col, "_row")
    kept = (
        keyed.select("_row", id_col)
        .join(found, F.col("_row") == F.col("_key"))
        .groupBy("component_id")
        .agg(F.min(place).alias("first"))
        .select(F.col("first._row").alias("_row"))
    )
    return keyed.join(kept, "_row", "left_semi").drop("_row").toDF(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, in the order of its shards."""
    prepare(spark)
    mix = mixing.mix(docs, n_words(F.col("text")), keep=docs.columns)
    return mix.rows().select("doc.*").select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and whether decoding them gives the text back."""
    prepare(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    # Half the usual block: the executors still hold what the stages before have left.
    both = bpe.round_trip("text", path, public_tokenizers.PATTERN, block_chars=bpe.BLOCK_CHARS // 2)
    return docs.select("doc_id", "lang", "source", both.alias("b")).select(
        "doc_id",
        "lang",
        "source",
        F.size("b.ids").cast("bigint").alias("n_tokens"),
        F.col("b.ids").alias("ids"),
        F.col("b.same").alias("round_trip"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

# Fitting, sketches and tokens have no counterpart in SQL. The tests compare run() on a small table
# with plain Python for every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with temporary() as keep:
            docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
