"""Drift statistics and verdicts. Sources src0-src9 are training text, the others production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.functions.pvalues import ks_exact_p_value
from textward.operators import drift, monitor
from textward.plans.catalog.tables import SCRIPT, SQL_SCRIPT, table
from textward.sources import store
from textward.sources.store import materialize, scratch_path

FAMILIES = ["fam0", "fam1", "fam2"]


def _numbered(spark: SparkSession, sf: str) -> DataFrame:
    number = F.substring("source", 4, 9).cast("int")
    return table(spark, sf, "documents").select("doc_id", "text", number.alias("number"))


def production(spark: SparkSession, sf: str) -> DataFrame:
    family = F.concat(F.lit("fam"), (F.col("number") % 3).cast("string"))
    return _numbered(spark, sf).where("number >= 10").select("doc_id", "text", family.alias("family"))


def training(spark: SparkSession, sf: str) -> DataFrame:
    return _numbered(spark, sf).where("number < 10").select("doc_id", "text")


def ks(spark: SparkSession, sf: str) -> DataFrame:
    out = drift.length_statistic(production(spark, sf), training(spark, sf), FAMILIES)
    return out.select("family", F.round("ks_d", 9).alias("ks_d"))


def _statistics(spark: SparkSession, sf: str) -> DataFrame:
    return drift.drift_tests(
        production(spark, sf), training(spark, sf), FAMILIES, script=SCRIPT
    )


def chi2(spark: SparkSession, sf: str) -> DataFrame:
    return _statistics(spark, sf).select("family", F.round("chi2", 6).alias("chi2"))


def centroid(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings")
    out = drift.centroid_distance(rows.where("label >= 5"), rows.where("label < 5"))
    return out.select(F.round("cosine_distance", 6).alias("cosine_distance"))


def statistics(spark: SparkSession, sf: str) -> DataFrame:
    return _statistics(spark, sf).select(
        "family",
        "n_production",
        "n_training",
        F.round("ks_d", 6).alias("ks_d"),
        F.round("chi2", 6).alias("chi2"),
        F.round("cosine_distance", 6).alias("cosine_distance"),
    )


def report(spark: SparkSession, sf: str) -> DataFrame:
    out = drift.detect_drift(production(spark, sf), training(spark, sf), FAMILIES, script=SCRIPT)
    rounded = ("p_value_length", "p_value_charset", "cosine_distance")
    return out.withColumns({c: F.round(c, 6) for c in rounded})


def exact_ks(spark: SparkSession, sf: str) -> DataFrame:
    """The length test's p-value by lattice paths, without the guards of the report."""
    tests = _statistics(spark, sf)
    p = ks_exact_p_value(F.col("ks_d"), F.col("n_production"), F.col("n_training"))
    return tests.select("family", p.alias("p")).select("family", F.round("p", 9).alias("p_value"))


def guarded(spark: SparkSession, sf: str) -> DataFrame:
    """The guard is set at the largest family's size, so the smaller ones get no verdict."""
    prod = production(spark, sf)
    n = F.count("*").alias("n")
    floor = prod.groupBy("family").agg(n).agg(F.max("n")).first()[0]
    out = drift.detect_drift(
        prod, training(spark, sf), FAMILIES, script=SCRIPT, min_production=floor
    )
    guarded_rows = out.where(F.col("skipped_reason").isNotNull())
    return guarded_rows.select(
        "family",
        "p_value_length",
        "p_value_charset",
        "cosine_distance",
        "drift_detected",
        "n_production",
        "skipped_reason",
    )


def end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """The whole training side against every family, as gauge samples."""
    out = drift.detect_drift(production(spark, sf), training(spark, sf), script=SCRIPT)
    gauge = drift.drift_gauge(out, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return gauge.select("family", "value")


def gauge_alert(spark: SparkSession, sf: str) -> DataFrame:
    """Reports as samples of a metric table, and the alert that reads the table.

    The report of the 1st of February counts. Samples from before it say the contrary, one of them
    is too old to be read at all; the report's run is done twice.
    """
    base = scratch_path(spark, "gauge")
    made = materialize(
        drift.detect_drift(production(spark, sf), training(spark, sf), script=SCRIPT), "report"
    )
    at = lambda text: F.lit(text).cast("timestamp")
    contrary = made.withColumn("drift_detected", ~F.col("drift_detected"))
    for ts in ("2024-01-20 00:00:00", "2024-01-30 00:00:00"):
        store.append_gauge(drift.drift_gauge(contrary, at(ts)), base, "weekly")
    for _ in range(2):
        store.append_gauge(drift.drift_gauge(made, at("2024-02-01 00:00:00")), base, "weekly")
    now = at("2024-02-03 00:00:00")
    samples = store.read_gauge(spark, base, spark.range(1).select(now).first()[0])
    alert = monitor.drift_alert(samples, now, series=["job"])
    n = samples.groupBy("family").agg(F.count("*").alias("n_samples"))
    return n.join(alert, "family", "left").select("family", "n_samples", F.coalesce("value", F.lit(0.0)).alias("value"))


QUERIES = {
    "i01_ks_length": ks,
    "i01_ks_exact": exact_ks,
    "i02_chi_square_charset": chi2,
    "i03_centroid_distance": centroid,
    "i04_drift_statistics": statistics,
    "i04_drift_report": report,
    "i05_too_few_rows": guarded,
    "i06_drift_by_family": end_to_end,
    "i06_gauge_alert": gauge_alert,
}

_SIDES = f"""sides AS (
  SELECT *, number >= 10 AS is_prod, 'fam' || (number % 3)::VARCHAR AS family,
         length(text) AS chars,
         length(regexp_replace(text, '[^\\pL]+', '', 'g')) AS letters,
         length(text) - length(regexp_replace(text, '[{SQL_SCRIPT}]+', '', 'g')) AS script_chars,
         length(text) - length(regexp_replace(text, '[\\p{{Nd}}]+', '', 'g')) AS digits
  FROM (SELECT doc_id, text, substr(source, 4)::INT AS number FROM documents)
),
families AS (SELECT DISTINCT family FROM sides WHERE is_prod),
both_sides AS (
  SELECT f.family, s.is_prod, chars, letters, script_chars, digits,
         least(floor(coalesce(script_chars / nullif(chars, 0), 0) * 4), 3) AS bin
  FROM families f JOIN sides s ON s.family = f.family OR NOT s.is_prod
)"""

_KS = """ks AS (
  SELECT family, max(abs(p / p_all - t / t_all)) AS ks_d FROM (
    SELECT x.family, x.chars, count(*) FILTER (is_prod AND b.chars <= x.chars) AS p,
           count(*) FILTER (NOT is_prod AND b.chars <= x.chars) AS t,
           count(*) FILTER (is_prod) AS p_all, count(*) FILTER (NOT is_prod) AS t_all
    FROM (SELECT DISTINCT family, chars FROM both_sides) x JOIN both_sides b ON b.family = x.family
    GROUP BY ALL
  ) GROUP BY family
)"""

_CHI2 = """bins AS (
  SELECT family, v.bin, count(*) FILTER (is_prod AND b.bin = v.bin) AS p,
         count(*) FILTER (NOT is_prod AND b.bin = v.bin) AS t,
         count(*) FILTER (is_prod) AS p_all, count(*) FILTER (NOT is_prod) AS t_all
  FROM both_sides b, (VALUES (0), (1), (2), (3)) v(bin) GROUP BY ALL
),
chi AS (
  SELECT family, sum((p - e) * (p - e) / e) AS chi2
  FROM (SELECT *, greatest(t * (p_all / t_all), 1.0) AS e FROM bins) GROUP BY family
)"""

_COSINE = """means AS (
  SELECT family, unnest([1, 2, 3, 4]) AS dim,
         unnest([avg(chars) FILTER (is_prod), avg(letters) FILTER (is_prod),
                 avg(script_chars) FILTER (is_prod), avg(digits) FILTER (is_prod)]) AS p,
         unnest([avg(chars) FILTER (NOT is_prod), avg(letters) FILTER (NOT is_prod),
                 avg(script_chars) FILTER (NOT is_prod), avg(digits) FILTER (NOT is_prod)]) AS t
  FROM both_sides GROUP BY family
),
cos AS (
  SELECT family, 1 - sum(p * t) / (sqrt(sum(p * p)) * sqrt(sum(t * t))) AS cosine_distance
  FROM means GROUP BY family
)"""

_REPORT = f"""
{_SIDES}, {_KS}, {_CHI2}, {_COSINE},
n AS (SELECT family, count(*) FILTER (is_prod) AS n_production, count(*) FILTER (NOT is_prod) AS n_training
      FROM both_sides GROUP BY family),
scaled AS (
  SELECT *, ks_d * ks_d * (n_production::DOUBLE * n_training / (n_production + n_training)) AS z,
         least(chi2 / 2, 50.0)::DOUBLE AS h
  FROM n JOIN ks USING (family) JOIN chi USING (family) JOIN cos USING (family)
),
tails AS (
  SELECT *, CASE WHEN z < 0.04 THEN 1.0 ELSE greatest(least(list_sum(list_transform(range(1, 31),
              lambda k: CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * z))), 1.0), 0.0)
            END::DOUBLE AS p_len,
         CASE WHEN h <= 0 THEN 1.0 ELSE greatest(1.0 - list_sum(list_transform(range(0, 160),
              lambda k: exp((k + 1.5) * ln(h) - h - lgamma(k + 2.5)))), 0.0) END::DOUBLE AS p_chr
  FROM scaled
),
guarded AS (
  SELECT *, n_production < 100 AS few, n_production < 100 OR n_training < 5 AS untested FROM tails
),
report AS (
  SELECT family, CASE WHEN untested THEN 1.0 ELSE round(p_len, 6) END::DOUBLE AS p_value_length,
         CASE WHEN untested THEN 1.0 ELSE round(p_chr, 6) END::DOUBLE AS p_value_charset,
         CASE WHEN few THEN 0.0 ELSE round(cosine_distance, 6) END::DOUBLE AS cosine_distance,
         n_production, n_training,
         CASE WHEN few THEN 'insufficient_samples' END AS skipped_reason,
         NOT few AND ((NOT untested AND (p_len < 0.01 OR p_chr < 0.01)) OR cosine_distance > 0.15)
           AS drift_detected
  FROM guarded
)"""

ORACLES = {
    "i04_drift_report": f"WITH {_REPORT} SELECT * FROM report",
    "i06_gauge_alert": f"""
WITH {_REPORT} SELECT family, 2 AS n_samples, drift_detected::INT::DOUBLE AS value FROM report""",
    "i06_drift_by_family": f"""
WITH {_REPORT} SELECT family, drift_detected::INT::DOUBLE AS value FROM report""",
    "i01_ks_length": f"WITH {_SIDES}, {_KS} SELECT family, round(ks_d, 9) AS ks_d FROM ks",
    "i01_ks_exact": f"""
WITH RECURSIVE {_SIDES}, {_KS},
n AS (SELECT family, count(*) FILTER (is_prod) AS n1, count(*) FILTER (NOT is_prod) AS n2
      FROM both_sides GROUP BY family),
walk AS (
  SELECT family, n1, n2, round(ks_d * n1 * n2)::BIGINT AS gap, 0 AS k, [0.0::DOUBLE] AS o
  FROM n JOIN ks USING (family) WHERE ks_d > 0
  UNION ALL
  SELECT family, n1, n2, gap, k + 1,
         list_transform(range(0, least(n1, k + 1) + 1), lambda i: CASE
           WHEN k + 1 - i > n2 THEN 0.0
           WHEN abs(i * n2 - (k + 1 - i) * n1) >= gap THEN 1.0
           ELSE (CASE WHEN i > 0 THEN o[i] * i ELSE 0.0 END
                 + CASE WHEN k + 1 > i THEN o[i + 1] * (k + 1 - i) ELSE 0.0 END) / (k + 1) END)
  FROM walk WHERE k < n1 + n2
)
SELECT family, coalesce(round(o[n1 + 1], 9), 1.0) AS p_value
FROM n LEFT JOIN (SELECT family, o FROM walk WHERE k = n1 + n2) USING (family)""",
    "i02_chi_square_charset": f"WITH {_SIDES}, {_CHI2} SELECT family, round(chi2, 6) AS chi2 FROM chi",
    "i03_centroid_distance": """
WITH v AS (SELECT label >= 5 AS is_prod, unnest(embedding)::DOUBLE AS x,
                  generate_subscripts(embedding, 1) AS pos FROM embeddings),
c AS (SELECT pos, avg(x) FILTER (is_prod) AS p, avg(x) FILTER (NOT is_prod) AS t FROM v GROUP BY pos)
SELECT round(1 - sum(p * t) / (sqrt(sum(p * p)) * sqrt(sum(t * t))), 6) AS cosine_distance FROM c""",
    "i04_drift_statistics": f"""
WITH {_SIDES}, {_KS}, {_CHI2}, {_COSINE},
n AS (SELECT family, count(*) FILTER (is_prod) AS n_production, count(*) FILTER (NOT is_prod) AS n_training
      FROM both_sides GROUP BY family)
SELECT family, n_production, n_training, round(ks_d, 6) AS ks_d, round(chi2, 6) AS chi2,
       round(cosine_distance, 6) AS cosine_distance
FROM n JOIN ks USING (family) JOIN chi USING (family) JOIN cos USING (family)""",
    "i05_too_few_rows": f"""
WITH {_SIDES},
n AS (SELECT family, count(*) AS n_production FROM sides WHERE is_prod GROUP BY family)
SELECT family, 1.0::DOUBLE AS p_value_length, 1.0::DOUBLE AS p_value_charset,
       0.0::DOUBLE AS cosine_distance, false AS drift_detected, n_production,
       'insufficient_samples' AS skipped_reason
FROM n WHERE n_production < (SELECT max(n_production) FROM n)""",
}
