"""Training, scoring and prediction records."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.functions.text import char_features
from textward.operators import evaluate as ev
from textward.operators import models
from textward.operators.monitor import LATENCY_EDGES
from textward.operators.splitting import assign_split
from textward.plans import serving, training
from textward.plans.catalog.tables import (
    SCORED,
    SCRIPT,
    SQL_SCRIPT,
    corpus,
    scored_labels,
    sql_sample_key,
    sql_split,
    stream_of,
    table,
)
from textward.sources.store import scratch_path
from textward.streaming.predictions import start_table_sink
from textward.streaming.sinks import read_part


def _labelled_splits(spark: SparkSession, sf: str) -> DataFrame:
    return assign_split(corpus(spark, sf).where(F.col("label").isNotNull()))


def _long(report: DataFrame) -> DataFrame:
    names = ("f1", "precision", "recall", "accuracy", "auroc")
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), F.round(n, 6).alias("value")) for n in names])
    return report.select("split", F.inline(rows))


def logistic(spark: SparkSession, sf: str) -> DataFrame:
    splits = _labelled_splits(spark, sf)
    trained = training.train_tfidf_logreg(splits, id_col="doc_id")
    report, _ = training.held_out_report(splits, lambda df: trained.score(df, id_col="doc_id"))
    return _long(report)


NEWTON_FEATURES = ("log_chars", "letters", "script", "digits")


def newton(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of four character features, fitted on the training split."""
    train = _labelled_splits(spark, sf).where("split = 'train'")
    counted = train.select("label", char_features(F.coalesce("text", F.lit("")), SCRIPT).alias("f"))
    chars = F.greatest(F.col("f")[0], F.lit(1.0))
    shares = [(F.col("f")[i] / chars).alias(NEWTON_FEATURES[i]) for i in (1, 2, 3)]
    rows = counted.select("label", F.log1p(F.col("f")[0]).alias(NEWTON_FEATURES[0]), *shares)
    fitted = models.train_newton(rows, NEWTON_FEATURES)
    weights = zip((*NEWTON_FEATURES, "intercept"), fitted.weights)
    table_of = spark.createDataFrame(list(weights), "feature string, weight double")
    return table_of.withColumn("weight", F.round("weight", 6))


def _embedding_splits(spark: SparkSession, sf: str) -> DataFrame:
    return assign_split(
        table(spark, sf, "embeddings").select(
            "vec_id",
            F.concat(F.lit("vec "), F.col("vec_id").cast("string")).alias("text"),
            "embedding",
            (F.col("label") < 5).cast("int").alias("label"),
            F.concat(F.lit("emb"), F.col("label").cast("string")).alias("source"),
        )
    )


def boosted(spark: SparkSession, sf: str) -> DataFrame:
    splits = _embedding_splits(spark, sf)
    model = training.train_embedding_boosted(splits)

    def score(df: DataFrame) -> DataFrame:
        with_features = df.withColumn("features", training.as_vector("embedding"))
        return models.positive_score(model, with_features)

    report, _ = training.held_out_report(splits, score)
    return _long(report)


def mean_pool(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of one label in the role of a text's token vectors; label 0 is masked throughout."""
    tokens = table(spark, sf, "embeddings").select(
        F.col("label").alias("text_id"),
        F.col("embedding").alias("vector"),
        ((F.col("vec_id") % 3 != 0) & (F.col("label") != 0)).cast("int").alias("mask"),
    )
    pooled = models.mean_pool(tokens, id_col="text_id")
    return pooled.select(
        F.col("text_id").cast("bigint").alias("text_id"), F.posexplode("embedding").alias("pos", "v")
    ).select("text_id", F.col("pos").cast("bigint").alias("pos"), F.round("v", 5).alias("value"))


def length_scorer():
    """A stand-in model: depends on the whole text and needs no weights."""

    def score(texts: Sequence[str]) -> list[float]:
        return [len(t) % 1000 / 1000.0 for t in texts]

    return score


def batched(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return models.score_batches(docs, length_scorer).select("doc_id", "score")


def _records(docs: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    scored = models.score_batches(texts, length_scorer)
    return models.prediction_records(
        scored.drop("text"), family="tfidf_logreg", model_version="3", data_version="v1"
    )


def records(spark: SparkSession, sf: str) -> DataFrame:
    return _records(table(spark, sf, "documents"))


def stream_records(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "scores")
    stream = _records(stream_of(spark, sf, "documents"))
    query = start_table_sink(stream, f"{base}/rows", f"{base}/state", available_now=True)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def _served(spark: SparkSession, sf: str) -> str:
    """Documents as requests, ten minutes apart, served into the tables of a folder."""
    requests = stream_of(spark, sf, "documents").select(
        "doc_id",
        F.timestamp_seconds(F.col("doc_id") * 600).alias("ts"),
        "text",
        ((F.col("doc_id") % 300) / F.lit(100.0)).alias("latency_s"),
    )
    base = scratch_path(spark, "served")
    serving.start_serving(
        requests,
        length_scorer,
        base,
        f"{base}/state",
        id_col="doc_id",
        family="tfidf_logreg",
        model_version="3",
        data_version="v1",
        rate=0.1,
        width="1 day",
        available_now=True,
    ).awaitTermination()
    return base


def rejects_stream(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{_served(spark, sf)}/rejects")
    return rows.select("doc_id", F.unix_seconds("ts").alias("ts"), "reason", "n_chars")


def serving_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Records, sampled log, counters and one histogram bucket list, in one long table."""
    base = _served(spark, sf)
    read = lambda name: spark.read.parquet(f"{base}/{name}")
    part = lambda name, of, key, value: of.select(
        F.lit(name).alias("part"), key.cast("string").alias("key"), value.cast("double").alias("value")
    )
    # A batch without a sampled request leaves no file to take a schema from.
    log = read_part(spark, base, "log", "doc_id bigint, text string, date date")
    at = lambda *names: F.concat_ws("|", F.unix_seconds("window_start"), *names)
    hist = serving.total_histograms(read("histograms")).where("metric = 'latency_s'")
    parts = [
        part("record", read("records"), F.concat_ws("|", "doc_id", "label"), F.col("confidence")),
        part("log", log, F.concat_ws("|", "doc_id", F.col("date").cast("string")), F.length("text")),
        part("count", serving.total_counts(read("counts")), at("label"), F.col("count")),
        part("latency", hist, at(F.when(F.col("le") < 1e9, (F.col("le") * 1000).cast("int")).otherwise(-1)), F.col("bucket")),
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def held_out(spark: SparkSession, sf: str) -> DataFrame:
    splits = assign_split(corpus(spark, sf)).select("doc_id", "split")
    scored = scored_labels(spark, sf).join(splits, "doc_id")
    return _long(models.split_report(scored, label_col="y_true"))


def held_out_sources(spark: SparkSession, sf: str) -> DataFrame:
    splits = assign_split(corpus(spark, sf)).select("doc_id", "split")
    test = scored_labels(spark, sf).join(splits, "doc_id").where(F.col("split") == "test")
    f1 = ev.per_source_f1(test, true_col="y_true", pred_col="pred_a")
    return f1.withColumn("f1", F.round("f1", 6))


QUERIES = {
    "g01_train_logistic": logistic,
    "g01_newton_logistic": newton,
    "g02_train_boosted": boosted,
    "g03_mean_pool": mean_pool,
    "g04_score_batches": batched,
    "g05_prediction_records": records,
    "g05_prediction_records_stream": stream_records,
    "g05_serving_stream": serving_stream,
    "c14_rejects_stream": rejects_stream,
    "g06_held_out_report": held_out,
    "g06_test_source_f1": held_out_sources,
}

_RECORDS = """
WITH p AS (SELECT doc_id, coalesce(length(text), 0) % 1000 / 1000.0::DOUBLE AS p FROM documents)
SELECT doc_id, CASE WHEN p >= 0.5 THEN 'jailbreak' ELSE 'benign' END AS label,
       CASE WHEN p >= 0.5 THEN p ELSE 1.0::DOUBLE - p END AS confidence,
       'tfidf_logreg' AS model_family, '3' AS model_version, 'v1' AS data_version
FROM p"""

_TESTED = f"""WITH {SCORED},
tested AS (
  SELECT s.*, {sql_split('d.text')} AS split FROM scored s JOIN documents d USING (doc_id)
)"""



def _sql_newton(steps: int = 15) -> str:
    """The same steps as a recursive table; each solves its system by elimination (L D L')."""
    size = len(NEWTON_FEATURES) + 1
    every = range(size)
    w = [f"w{i}" for i in every]
    margin = " + ".join(f"w{i} * x{i}" for i in every)
    ridge = lambda i: 1.0 if i < size - 1 else 0.0
    sums = [f"sum(x{i} * (p - y)) + {ridge(i)} * w{i} AS g{i}" for i in every]
    sums += [
        f"sum(x{i} * x{j} * p * (1 - p)) + {ridge(i) if i == j else 0.0} AS h{i}{j}"
        for i in every
        for j in range(i + 1)
    ]
    solve = []
    for j in every:
        done = "".join(f" - l{j}{k} * l{j}{k} * d{k}" for k in range(j))
        solve.append(f"h{j}{j}{done} AS d{j}")
        for i in range(j + 1, size):
            done = "".join(f" - l{i}{k} * l{j}{k} * d{k}" for k in range(j))
            solve.append(f"(h{i}{j}{done}) / d{j} AS l{i}{j}")
    for i in every:
        solve.append(f"g{i}" + "".join(f" - l{i}{k} * u{k}" for k in range(i)) + f" AS u{i}")
    for i in reversed(every):
        later = "".join(f" - l{k}{i} * s{k}" for k in range(i + 1, size))
        solve.append(f"u{i} / d{i}{later} AS s{i}")
    named = ", ".join(f"('{n}', w{i})" for i, n in enumerate((*NEWTON_FEATURES, "intercept")))
    return f"""
WITH RECURSIVE counted AS (
  SELECT l.toxic::DOUBLE AS y, {sql_split('d.text')} AS split, length(coalesce(d.text, '')) AS n,
         coalesce(length(regexp_replace(d.text, '[^\\pL]+', '', 'g')), 0) AS a,
         coalesce(length(d.text) - length(regexp_replace(d.text, '[{SQL_SCRIPT}]+', '', 'g')), 0) AS b,
         coalesce(length(d.text) - length(regexp_replace(d.text, '[\\p{{Nd}}]+', '', 'g')), 0) AS c
  FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic IS NOT NULL
), r AS MATERIALIZED (
  SELECT y, ln(1 + n) AS x0, a / greatest(n, 1) AS x1, b / greatest(n, 1) AS x2,
         c / greatest(n, 1) AS x3, 1.0::DOUBLE AS x4
  FROM counted WHERE split = 'train'
), w AS (
  SELECT 0 AS step, {', '.join(f'0.0::DOUBLE AS {v}' for v in w)}
  UNION ALL
  SELECT step + 1, {', '.join(f'w{i} - s{i}' for i in every)} FROM (
    SELECT *, {', '.join(solve)} FROM (
      SELECT step, {', '.join(w)}, {', '.join(sums)}
      FROM (SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM w, r WHERE step < {steps})
      GROUP BY step, {', '.join(w)}
    )
  )
)
SELECT v.feature, round(v.weight, 6) AS weight
FROM w, LATERAL (VALUES {named}) v(feature, weight) WHERE step = {steps}"""


ORACLES = {
    "g01_newton_logistic": _sql_newton(),
    "g03_mean_pool": """
WITH t AS (
  SELECT label AS text_id, (vec_id % 3 <> 0 AND label <> 0)::INT AS mask,
         unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS pos
  FROM embeddings
)
SELECT text_id::BIGINT AS text_id, pos::BIGINT AS pos,
       round(sum(v * mask) / greatest(sum(mask), 1), 5) AS value
FROM t GROUP BY ALL""",
    "g04_score_batches": """
SELECT doc_id, length(text) % 1000 / 1000.0::DOUBLE AS score FROM documents""",
    "g05_prediction_records": _RECORDS,
    "g05_prediction_records_stream": _RECORDS,
    "g05_serving_stream": f"""
WITH r AS (
  SELECT doc_id, doc_id * 600 AS at_s, length(text) AS n, length(text) % 1000 / 1000.0::DOUBLE AS p,
         doc_id % 300 / 100.0::DOUBLE AS latency
  FROM documents WHERE length(text) BETWEEN 1 AND 10000
), s AS (
  SELECT *, CASE WHEN p >= 0.5 THEN 'jailbreak' ELSE 'benign' END AS label, at_s // 86400 * 86400 AS w FROM r
), edges(le) AS (VALUES {", ".join(f"({e}::DOUBLE)" for e in LATENCY_EDGES)}, ('inf'::DOUBLE))
SELECT 'record' AS part, doc_id || '|' || label AS key, CASE WHEN p >= 0.5 THEN p ELSE 1 - p END AS value FROM s
UNION ALL
SELECT 'log', doc_id || '|' || (DATE '1970-01-01' + (at_s // 86400)::INT)::DATE::VARCHAR, n FROM s
WHERE ('0x' || substr({sql_sample_key('doc_id')}, 1, 8))::BIGINT < {0.1 * 2**32}::DOUBLE
UNION ALL
SELECT 'count', w || '|' || label, count(*) FROM s GROUP BY ALL
UNION ALL
SELECT 'latency', w || '|' || CASE WHEN isinf(le) THEN -1 ELSE (le * 1000)::INT END,
       count(*) FILTER (latency <= le) FROM s, edges GROUP BY w, le""",
    "c14_rejects_stream": """
SELECT doc_id, doc_id * 600 AS ts,
       CASE WHEN text IS NULL THEN 'missing' WHEN text = '' THEN 'empty' ELSE 'too long' END AS reason,
       length(text) AS n_chars
FROM documents WHERE NOT coalesce(length(text) BETWEEN 1 AND 10000, false)""",
    "g06_held_out_report": f"""{_TESTED},
c AS (
  SELECT split, count(*) FILTER (y_true = 1 AND score >= 0.5) AS tp,
         count(*) FILTER (y_true = 0 AND score >= 0.5) AS fp,
         count(*) FILTER (y_true = 1 AND score < 0.5) AS fn,
         count(*) FILTER (y_true = 0 AND score < 0.5) AS tn
  FROM tested WHERE split <> 'train' GROUP BY split
),
a AS (
  SELECT p.split, sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END)::DOUBLE
         / count(*) AS auroc
  FROM tested p JOIN tested n ON p.split = n.split AND p.y_true = 1 AND n.y_true = 0 GROUP BY p.split
),
m AS (
  SELECT split, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
         coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
         coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
         (tp + tn) / (tp + fp + fn + tn) AS accuracy, auroc
  FROM c LEFT JOIN a USING (split)
)
SELECT split, metric, round(value, 6) AS value
FROM m UNPIVOT INCLUDE NULLS (value FOR metric IN (f1, precision, recall, accuracy, auroc))""",
    "g06_test_source_f1": f"""{_TESTED}
SELECT source, round(coalesce(2 * count(*) FILTER (y_true = 1 AND pred_a = 1)
         / nullif(count(*) FILTER (y_true = 1) + count(*) FILTER (pred_a = 1), 0), 0), 6) AS f1
FROM tested WHERE split = 'test' GROUP BY source""",
}
