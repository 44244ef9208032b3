"""Dedup, sampling, balance, split, stage counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.functions.minhash import (
    MAX_HASH,
    MERSENNE_PRIME,
    NUM_PERM,
    band_layout,
    permutations,
)
from textward.functions.sampling import bernoulli
from textward.operators import dedup, sampling, splitting
from textward.plans.catalog.tables import (
    CORPUS,
    corpus,
    sql_norm,
    sql_sample_key,
    sql_split,
    table,
)
from textward.plans.corpus import build_corpus


def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Normalize, dedup, split by hash, count by split and label."""
    rows = dedup.dedup_exact(corpus(spark, sf), id_col="doc_id")
    return (
        splitting.assign_split(rows)
        .groupBy("split", F.col("label").cast("int").alias("label"))
        .agg(F.count("*").alias("n"))
    )


def exact(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_exact(table(spark, sf, "documents"), id_col="doc_id").select("doc_id")


def near(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_near(table(spark, sf, "documents"), id_col="doc_id").select("doc_id")


def balanced(spark: SparkSession, sf: str) -> DataFrame:
    kept = sampling.balance_classes(corpus(spark, sf), 0.4, id_col="doc_id")
    return kept.select("doc_id", F.col("label").cast("int").alias("label"))


def sampled(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_exact(table(spark, sf, "documents"), 137, id_col="doc_id").select("doc_id")


def shuffled(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.shuffled(table(spark, sf, "documents"), id_col="doc_id").select(
        "doc_id", "shuffle_key"
    )


def split(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.assign_split(table(spark, sf, "documents")).select("doc_id", "split")


def leakage(spark: SparkSession, sf: str) -> DataFrame:
    """Leaks of the hash split (there are none) next to those of a split by id."""
    docs = table(spark, sf, "documents")
    by_hash = splitting.leaked_groups(splitting.assign_split(docs))
    by_id = splitting.leaked_groups(
        docs.withColumn("split", F.concat(F.lit("part"), (F.col("doc_id") % 3).cast("string")))
    )
    rows = by_hash.withColumn("kind", F.lit("hash")).unionAll(by_id.withColumn("kind", F.lit("id")))
    return rows.select("kind", "group_hash", "first_split", "last_split")


def bernoulli_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").where(bernoulli("event_id", 0.1)).select("event_id")


def permutation_prefix(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id")
    drawn = sampling.sample_exact(docs, 200, id_col="doc_id", seed=7)
    return sampling.shuffled(drawn, id_col="doc_id", seed=7)


def funnel(spark: SparkSession, sf: str) -> DataFrame:
    built = build_corpus(corpus(spark, sf), id_col="doc_id", target_ratio=0.4)
    per_split = built.rows.groupBy("split").agg(F.count("*").alias("n_rows"))
    return built.funnel.select("stage", "n_rows").unionByName(
        per_split.select(F.col("split").alias("stage"), "n_rows")
    )


QUERIES = {
    "corpus_split_counts": split_counts,
    "d01_dedup_exact": exact,
    "d02_dedup_near": near,
    "d04_balance_classes": balanced,
    "d05_sample_exact": sampled,
    "d06_seeded_shuffle": shuffled,
    "d07_hash_split": split,
    "d08_leaked_groups": leakage,
    "d09_bernoulli_sample": bernoulli_rows,
    "d10_permutation_prefix": permutation_prefix,
    "d11_stage_funnel": funnel,
}

_UNIQUE = f"""uniq AS (
  SELECT doc_id, norm FROM (
    SELECT doc_id, {sql_norm('text')} AS norm FROM documents
  ) QUALIFY row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1
)"""


def _sql_near(threshold: float = dedup.DEFAULT_THRESHOLD) -> str:
    """CTEs that end in ``near(doc_id)``: MinHash bands, then the hash-ordered scan itself.

    The scan walks the colliding rows one by one and keeps a list of kept ids.
    """
    a, b = permutations(NUM_PERM)
    bands, rows = band_layout(threshold)
    hashed = ", ".join(
        f"(((h * {a[i]}::HUGEINT + {b[i]}) % {2**64}) % {MERSENNE_PRIME}) & {MAX_HASH} AS p{i}"
        for i in range(NUM_PERM)
    )
    lows = ", ".join(f"min(p{i}) AS p{i}" for i in range(NUM_PERM))
    keys = ", ".join(
        "'" + f"{band}:' || concat_ws(',', "
        + ", ".join(f"p{i}" for i in range(band * rows, (band + 1) * rows))
        + ")"
        for band in range(bands)
    )
    return f"""{_UNIQUE},
shingle AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN length(norm) < 4 THEN [norm]
      ELSE [substr(norm, i, 4) FOR i IN range(1, length(norm) - 2)] END) AS s
    FROM uniq
  )
),
hashed AS (
  SELECT s, {hashed} FROM (
    SELECT s, ('0x' || substr(x, 7, 2) || substr(x, 5, 2) || substr(x, 3, 2) || substr(x, 1, 2))::HUGEINT AS h
    FROM (SELECT s, sha1(s) AS x FROM (SELECT DISTINCT s FROM shingle))
  )
),
sig AS (SELECT doc_id, {lows} FROM shingle JOIN hashed USING (s) GROUP BY doc_id),
member AS MATERIALIZED (
  SELECT doc_id, left({sql_sample_key('doc_id')}, {dedup.TURN_DIGITS}) AS turn, unnest([{keys}]) AS k
  FROM sig
),
edge AS MATERIALIZED (
  SELECT DISTINCT hi.doc_id AS hi, hi.turn AS turn, lo.doc_id AS lo
  FROM member hi JOIN member lo ON hi.k = lo.k
    AND (lo.turn < hi.turn OR (lo.turn = hi.turn AND lo.doc_id < hi.doc_id))
),
node AS MATERIALIZED (
  SELECT hi AS id, list(lo) AS lower_ids, row_number() OVER (ORDER BY turn, hi) AS pos
  FROM edge GROUP BY hi, turn
),
scan AS (
  SELECT 0::BIGINT AS pos, []::BIGINT[] AS dropped
  UNION ALL
  SELECT node.pos, CASE WHEN len(list_filter(lower_ids, lambda x: NOT list_contains(dropped, x))) > 0
                        THEN list_append(dropped, id) ELSE dropped END
  FROM scan JOIN node ON node.pos = scan.pos + 1
),
loser AS (SELECT unnest(dropped) AS doc_id FROM (SELECT dropped FROM scan ORDER BY pos DESC LIMIT 1)),
near AS (SELECT doc_id FROM uniq WHERE doc_id NOT IN (SELECT doc_id FROM loser))"""


def _sql_balance(rows: str, ratio: float) -> str:
    """CTEs that end in ``balanced(doc_id, text, label)`` for a relation of those columns."""
    return f"""size AS (
  SELECT count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM {rows}
),
target AS (
  SELECT floor(least(pos, neg * {ratio}::DOUBLE / {1 - ratio}::DOUBLE)) AS pos,
         floor(least(neg, pos * {1 - ratio}::DOUBLE / {ratio}::DOUBLE)) AS neg FROM size
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY {sql_sample_key('doc_id')}, doc_id) AS rn
  FROM {rows} WHERE label IN (0, 1)
),
balanced AS (
  SELECT doc_id, text, label FROM ranked, target
  WHERE rn <= CASE label WHEN 1 THEN target.pos ELSE target.neg END
)"""


def _sql_leaks(kind: str, split: str) -> str:
    return f"""
SELECT '{kind}' AS kind, g AS group_hash, min(split) AS first_split, max(split) AS last_split
FROM (SELECT substr(sha256({sql_norm('text')}), 1, 16) AS g, {split} AS split FROM documents)
GROUP BY g HAVING count(DISTINCT split) > 1"""


ORACLES = {
    "corpus_split_counts": f"""
WITH {CORPUS},
kept AS (SELECT * FROM corpus QUALIFY
  row_number() OVER (PARTITION BY {sql_norm('text')} ORDER BY doc_id) = 1)
SELECT {sql_split('text')} AS split, label, count(*) AS n FROM kept GROUP BY ALL""",
    "d01_dedup_exact": f"WITH {_UNIQUE} SELECT doc_id FROM uniq",
    "d02_dedup_near": f"WITH RECURSIVE {_sql_near()} SELECT doc_id FROM near",
    "d04_balance_classes": f"""
WITH {CORPUS}, {_sql_balance('corpus', 0.4)} SELECT doc_id, label FROM balanced""",
    "d05_sample_exact": f"""
SELECT doc_id FROM documents ORDER BY {sql_sample_key('doc_id')}, doc_id LIMIT 137""",
    "d06_seeded_shuffle": f"""
SELECT doc_id, {sql_sample_key('doc_id')} AS shuffle_key FROM documents""",
    "d07_hash_split": f"SELECT doc_id, {sql_split('text')} AS split FROM documents",
    "d08_leaked_groups": _sql_leaks("hash", sql_split("text"))
    + "\nUNION ALL"
    + _sql_leaks("id", "'part' || (doc_id % 3)::VARCHAR"),
    "d09_bernoulli_sample": f"""
SELECT event_id FROM events
WHERE ('0x' || substr({sql_sample_key('event_id')}, 1, 8))::BIGINT < {0.1 * 2**32}::DOUBLE""",
    "d10_permutation_prefix": f"""
SELECT doc_id, {sql_sample_key('doc_id', 7)} AS shuffle_key FROM documents
ORDER BY shuffle_key, doc_id LIMIT 200""",
    "d11_stage_funnel": f"""
WITH RECURSIVE {CORPUS}, {_sql_near()},
left_rows AS (SELECT * FROM corpus WHERE doc_id IN (SELECT doc_id FROM near)),
{_sql_balance('left_rows', 0.4)}
SELECT 'merged' AS stage, count(*) AS n_rows FROM corpus
UNION ALL SELECT 'deduped', count(*) FROM left_rows
UNION ALL SELECT 'balanced', count(*) FROM balanced
UNION ALL SELECT {sql_split('text')}, count(*) FROM balanced GROUP BY 1""",
}
