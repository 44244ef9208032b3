"""Corpus profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.operators import profile
from textward.operators.splitting import assign_split
from textward.plans.catalog.tables import CORPUS, SCRIPT, SQL_SCRIPT, corpus, sql_split


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return corpus(spark, sf).where(F.col("label").isNotNull())


def _int(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


QUERIES = {
    "e01_row_count": lambda s, d: profile.row_count(corpus(s, d)),
    "e02_class_counts": lambda s, d: _int(profile.class_counts(corpus(s, d)), "label"),
    "e03_source_counts": lambda s, d: profile.source_counts(corpus(s, d)),
    "e04_length_stats": lambda s, d: _int(
        profile.length_stats(corpus(s, d)), "min", "q25", "q75", "max"
    ),
    "e05_sample_per_label": lambda s, d: _int(
        profile.sample_per_label(corpus(s, d), id_col="doc_id"), "label"
    ).select("doc_id", "label", "source", "text"),
    "e06_split_by_label": lambda s, d: profile.split_by_label(assign_split(corpus(s, d))),
    "e07_source_by_split": lambda s, d: profile.source_by_split(assign_split(corpus(s, d))),
    "e08_subcategory_counts": lambda s, d: profile.subcategory_counts(corpus(s, d), "src3"),
    "e09_length_histogram": lambda s, d: _int(
        profile.length_histogram(_labelled(s, d)), "label", "bin"
    ),
    "e09_length_histogram_data_range": lambda s, d: _int(
        profile.length_histogram(_labelled(s, d), data_range=True), "label", "bin"
    ),
    "e10_length_percentiles": lambda s, d: _int(
        profile.length_percentiles(corpus(s, d)), "label", "median", "p95"
    ),
    "e11_script_ratio_stats": lambda s, d: _int(
        profile.script_ratio_stats(_labelled(s, d), script=SCRIPT), "label"
    ),
}

_SPLIT = f"WITH {CORPUS}, split_rows AS (SELECT *, {sql_split('text')} AS split FROM corpus)"

ORACLES = {
    "e01_row_count": "SELECT count(*) AS n_rows FROM documents",
    "e02_class_counts": f"WITH {CORPUS} SELECT label::BIGINT AS label, count(*) AS count FROM corpus GROUP BY label",
    "e03_source_counts": "SELECT source, count(*) AS count FROM documents GROUP BY source",
    "e04_length_stats": """
WITH r AS (
  SELECT length(text) AS n, row_number() OVER (ORDER BY length(text)) - 1 AS pos,
         count(*) OVER () - 1 AS last FROM documents
)
SELECT min(n) AS min, min(n) FILTER (pos = floor(last * 0.25 + 0.5)) AS q25, median(n) AS median,
       min(n) FILTER (pos = floor(last * 0.75 + 0.5)) AS q75, max(n) AS max
FROM r""",
    "e05_sample_per_label": f"""
WITH {CORPUS}
SELECT doc_id, label::BIGINT AS label, source, text FROM corpus
QUALIFY row_number() OVER (PARTITION BY label ORDER BY doc_id) <= 5""",
    "e06_split_by_label": f"""{_SPLIT}
SELECT split, nullif(count(*) FILTER (label = 0), 0) AS label_0,
       nullif(count(*) FILTER (label = 1), 0) AS label_1
FROM split_rows GROUP BY split""",
    "e07_source_by_split": f"""{_SPLIT}
SELECT source, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val,
       count(*) FILTER (split = 'test') AS test
FROM split_rows GROUP BY source""",
    "e08_subcategory_counts": f"""
WITH {CORPUS}
SELECT subcategory, count(*) AS count FROM corpus WHERE source = 'src3' GROUP BY subcategory""",
    "e09_length_histogram": f"""
WITH {CORPUS}
SELECT label::BIGINT AS label, least(floor(least(length(text), 1500) / 37.5)::BIGINT + 1, 40) AS bin,
       count(*) AS count
FROM corpus WHERE label IS NOT NULL GROUP BY ALL""",
    "e09_length_histogram_data_range": f"""
WITH {CORPUS},
c AS (SELECT label::BIGINT AS label, least(length(text), 1500) AS n FROM corpus WHERE label IS NOT NULL),
r AS (SELECT *, min(n) OVER (PARTITION BY label) AS lo, max(n) OVER (PARTITION BY label) AS hi FROM c)
SELECT label, least(CASE WHEN lo = hi THEN 21 ELSE (n - lo) * 40 // (hi - lo) + 1 END, 40)::BIGINT AS bin,
       count(*) AS count
FROM r GROUP BY ALL""",
    "e10_length_percentiles": f"""
WITH {CORPUS}
SELECT label::BIGINT AS label, floor(quantile_cont(length(text), 0.5))::BIGINT AS median,
       floor(quantile_cont(length(text), 0.95))::BIGINT AS p95
FROM corpus GROUP BY label""",
    "e11_script_ratio_stats": f"""
WITH {CORPUS},
r AS (
  SELECT label, coalesce((length(text) - length(regexp_replace(text, '[{SQL_SCRIPT}]+', '', 'g')))
         / nullif(length(text), 0), 0.0) AS ratio
  FROM corpus WHERE label IS NOT NULL
)
SELECT label::BIGINT AS label, round(avg(ratio), 3) AS mean, round(median(ratio), 3) AS median,
       round(stddev_samp(ratio), 3) AS std
FROM r GROUP BY label""",
}
