"""Classification metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.operators import evaluate as ev
from textward.operators import sketches
from textward.plans.catalog.tables import PREDICTIONS, SCORED, predictions, scored_labels
from textward.sources.store import materialize

SKETCHED = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def _round(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return ev.confusion_matrix(scored_labels(spark, sf), true_col="y_true", pred_col="pred_a")


def binary(spark: SparkSession, sf: str) -> DataFrame:
    out = ev.binary_metrics(
        scored_labels(spark, sf), true_col="y_true", pred_col="pred_a", score_col="score"
    )
    return _round(out, "f1", "precision", "recall", "accuracy", "auroc")


def area(spark: SparkSession, sf: str) -> DataFrame:
    out = ev.auroc(scored_labels(spark, sf), true_col="y_true", score_col="score", by=["source"])
    return _round(out, "auroc")


def source_f1(spark: SparkSession, sf: str) -> DataFrame:
    out = ev.per_source_f1(scored_labels(spark, sf), true_col="y_true", pred_col="pred_a")
    return _round(out, "f1")


def source_f1_models(spark: SparkSession, sf: str) -> DataFrame:
    return ev.per_source_f1_models(
        scored_labels(spark, sf), {"a": "pred_a", "b": "pred_b"}, true_col="y_true"
    )


def report(spark: SparkSession, sf: str) -> DataFrame:
    out = ev.classification_report(scored_labels(spark, sf), true_col="y_true", pred_col="pred_a")
    return _round(out, "precision", "recall", "f1")


def comparison(spark: SparkSession, sf: str) -> DataFrame:
    names = ("f1", "precision", "recall", "accuracy", "auroc")
    models = {"a": ("pred_a", "score"), "b": ("pred_b", "score_b")}
    out = ev.model_metrics(scored_labels(spark, sf), models, true_col="y_true")
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
    return ev.compare_models(out.select("model", F.inline(cells)), list(models))


def latency(spark: SparkSession, sf: str) -> DataFrame:
    """Events as timed batches of one to four requests."""
    timed = predictions(spark, sf).select(
        "family", F.col("value").alias("took_ms"), (F.col("event_id") % 4 + 1).alias("n_requests")
    )
    each = ev.request_latency(timed, batch_ms="took_ms", batch_size="n_requests")
    out = ev.latency_summary(each, by=["family"])
    return _round(out, "p50_ms", "p95_ms", "p99_ms", "mean_ms").select(
        "family", "p50_ms", "p95_ms", "p99_ms", "mean_ms"
    )


def sketched_latency(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sketches, stored, merged per family; their quantiles held against all rows."""
    rows = predictions(spark, sf).select("family", F.to_date("ts").alias("day"), "value")
    daily = materialize(sketches.sketch_values(rows, "value", ["family", "day"]), "daily-sketches")
    merged = sketches.merge_sketches(daily, ["family"])
    found = sketches.sketch_quantiles(merged, SKETCHED)
    errors = sketches.rank_error(rows, "value", found, SKETCHED, ["family"])
    near = (F.col("error") <= 0.01).alias("within_one_percent")
    return errors.join(merged.select("family", "n"), "family").select("family", "n", "name", near)


QUERIES = {
    "h01_confusion_matrix": confusion,
    "h02_binary_metrics": binary,
    "h03_auroc_by_source": area,
    "h04_per_source_f1": source_f1,
    "h05_per_source_f1_models": source_f1_models,
    "h06_classification_report": report,
    "h07_compare_models": comparison,
    "h08_latency_summary": latency,
    "h08_latency_sketches": sketched_latency,
}


def _sql_metrics(name: str, pred: str, score: str) -> str:
    """CTE with one row of metrics; the area counts every pair of a positive and a negative."""
    return f"""{name} AS (
  SELECT 2 * tp / (2 * tp + fp + fn) AS f1, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
         (tp + tn) / (tp + fp + fn + tn) AS accuracy,
         (SELECT sum(CASE WHEN p.{score} > n.{score} THEN 1.0 WHEN p.{score} = n.{score} THEN 0.5 ELSE 0 END)::DOUBLE
                 / count(*) FROM scored p JOIN scored n ON p.y_true = 1 AND n.y_true = 0) AS auroc
  FROM (SELECT count(*) FILTER (y_true = 1 AND {pred} = 1) AS tp,
               count(*) FILTER (y_true = 0 AND {pred} = 1) AS fp,
               count(*) FILTER (y_true = 1 AND {pred} = 0) AS fn,
               count(*) FILTER (y_true = 0 AND {pred} = 0) AS tn FROM scored)
)"""


def _sql_f1(pred: str) -> str:
    return (
        f"coalesce(2 * count(*) FILTER (y_true = 1 AND {pred} = 1) / "
        f"nullif(count(*) FILTER (y_true = 1) + count(*) FILTER ({pred} = 1), 0), 0)"
    )


_UNPIVOT = (
    "SELECT * FROM {0} UNPIVOT INCLUDE NULLS "
    "(value FOR metric IN (f1, precision, recall, accuracy, auroc))"
)

ORACLES = {
    "h01_confusion_matrix": f"""
WITH {SCORED}
SELECT y_true, y_pred, count(scored.pred_a) AS count
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(y_true, y_pred)
LEFT JOIN scored ON scored.y_true = g.y_true AND scored.pred_a = g.y_pred
GROUP BY ALL""".replace("SELECT y_true, y_pred", "SELECT g.y_true, g.y_pred"),
    "h02_binary_metrics": f"""
WITH {SCORED}, {_sql_metrics('m', 'pred_a', 'score')}
SELECT round(f1, 6) AS f1, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(accuracy, 6) AS accuracy, round(auroc, 6) AS auroc FROM m""",
    "h03_auroc_by_source": f"""
WITH {SCORED},
a AS (
  SELECT p.source, sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END)::DOUBLE
         / count(*) AS auroc
  FROM scored p JOIN scored n ON p.source = n.source AND p.y_true = 1 AND n.y_true = 0 GROUP BY p.source
)
SELECT s.source, round(auroc, 6) AS auroc FROM (SELECT DISTINCT source FROM scored) s LEFT JOIN a USING (source)""",
    "h04_per_source_f1": f"""
WITH {SCORED} SELECT source, round({_sql_f1('pred_a')}, 6) AS f1 FROM scored GROUP BY source""",
    "h05_per_source_f1_models": f"""
WITH {SCORED}
SELECT source, count(*) AS n, round({_sql_f1('pred_a')}, 3) AS a_f1, round({_sql_f1('pred_b')}, 3) AS b_f1
FROM scored GROUP BY source HAVING count(*) >= 5""",
    "h06_classification_report": f"""
WITH {SCORED},
k AS (
  SELECT c, count(*) FILTER (y_true = c) AS support, count(*) FILTER (pred_a = c) AS predicted,
         count(*) FILTER (y_true = c AND pred_a = c) AS hit
  FROM scored, (VALUES (0), (1)) v(c) GROUP BY c
),
m AS (
  SELECT c, coalesce(hit / nullif(predicted, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r,
         coalesce(2 * hit / nullif(predicted + support, 0), 0) AS f, support, hit FROM k
),
long AS (
  SELECT c::VARCHAR AS class, p, r, f, support FROM m
  UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support),
                   sum(support) FROM m
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM m
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
                   sum(f * support) / sum(support), sum(support) FROM m
)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support::BIGINT AS support
FROM long""",
    "h07_compare_models": f"""
WITH {SCORED}, {_sql_metrics('ma', 'pred_a', 'score')}, {_sql_metrics('mb', 'pred_b', 'score_b')}
SELECT metric, round(x.value, 4) AS a, round(y.value, 4) AS b
FROM ({_UNPIVOT.format('ma')}) x JOIN ({_UNPIVOT.format('mb')}) y USING (metric)""",
    "h08_latency_sketches": f"""
WITH {PREDICTIONS}
SELECT family, count(value) AS n, name, true AS within_one_percent
FROM predictions, (VALUES ('p50'), ('p95'), ('p99')) q(name) GROUP BY family, name""",
    "h08_latency_summary": f"""
WITH {PREDICTIONS}
SELECT family, round(quantile_cont(ms, 0.5), 6) AS p50_ms, round(quantile_cont(ms, 0.95), 6) AS p95_ms,
       round(quantile_cont(ms, 0.99), 6) AS p99_ms, round(avg(ms), 6) AS mean_ms
FROM (SELECT family, value / (event_id % 4 + 1) AS ms FROM predictions) GROUP BY family""",
}
