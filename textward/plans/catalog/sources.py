"""Readers, sinks, schema and union."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.functions import text as tx
from textward.operators.splitting import assign_split
from textward.plans.catalog.tables import (
    CORPUS,
    PREDICTIONS,
    SCRIPT,
    SQL_SCRIPT,
    SQL_SPACE,
    as_predictions,
    corpus,
    predictions,
    sql_sample_key,
    sql_split,
    stream_of,
    table,
)
from textward.sources import readers, schema, store, templates
from textward.streaming.predictions import log_predictions, sampled_log

# Latin text has few letters with diacritics, so the share asked for is small.
MIN_SCRIPT = 0.05
ARTICLES = 100

TEMPLATES = (
    templates.Template("Actor", "roleplay", "You are an actor. Say: {seed}"),
    templates.Template("Story", "roleplay", "Tell a story about {seed} and {seed}"),
    templates.Template("Json", "output_formatting", '{"answer": "{seed}"}'),
    templates.Template("Aside", "irrelevant_information", "The sky is blue. {seed}"),
    templates.Template("Broken", "token_smuggling", None),
    templates.Template("Rewriter", "roleplay", "{seed}", needs_model=True),
)
_SQL_TEMPLATES = "templates(attack_name, attack_class, body) AS (VALUES " + ", ".join(
    f"('{t.category}', '{t.name}', '{t.body}')" for t in TEMPLATES if t.body and not t.needs_model
) + ")"


def _int_label(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.col("label").cast("int"))


def record_json(spark: SparkSession, sf: str) -> DataFrame:
    path = store.scratch_path(spark, "records")
    table(spark, sf, "documents").select(
        "doc_id",
        F.col("text").alias("prompt_ru"),
        F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("prompt_en"),
        F.col("lang").alias("class"),
        "source",
    ).write.json(path)
    rows = readers.read_record_json(spark, path, multi_line=False, keep="doc_id bigint")
    return _int_label(rows).select(
        "doc_id", "text", "label", "source", "subcategory", "lang", "meta.prompt_en", "meta.orig_source"
    )


def prompt_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = store.scratch_path(spark, "prompts")
    # CSV columns go by position: the id that is carried along comes first.
    table(spark, sf, "documents").select(
        "doc_id",
        F.col("text").alias("prompt"),
        F.col("source").alias("category"),
        F.col("lang").alias("language"),
        F.concat(F.lit("sub"), (F.col("doc_id") % 4).cast("string")).alias("subcategory"),
    ).write.csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    rows = readers.read_prompt_csv(spark, path, lang="fr", keep="doc_id bigint")
    return _int_label(rows).select(
        "doc_id", "text", "label", "source", "subcategory", "lang", "meta.category"
    )


def safety_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = store.scratch_path(spark, "safety")
    corpus(spark, sf).where(F.col("label").isNotNull()).select(
        "doc_id",
        F.col("text").alias("prompt"),
        "lang",
        F.col("source").alias("prompt_harm_category"),
        (F.col("label") == 1).alias("is_adversarial"),
    ).write.parquet(path)
    rows = readers.read_safety_parquet(spark, path, lang="fr", keep="doc_id bigint")
    return _int_label(rows).select(
        "doc_id", "text", "label", "source", "subcategory", "lang", "meta.orig_source"
    )


def benign_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "value")
    )
    rows = readers.benign_lines(
        lines, min_script_ratio=MIN_SCRIPT, script=SCRIPT, keep=("doc_id", "line_no")
    )
    return _int_label(rows).select("doc_id", "line_no", "text", "label", "source", "meta.orig_source")


def article_sample(spark: SparkSession, sf: str) -> DataFrame:
    # The documents have single line breaks; a paragraph is a line here.
    docs = table(spark, sf, "documents")
    rows = readers.article_sample(
        docs, ARTICLES, id_col="doc_id", separator="\n", min_script_ratio=MIN_SCRIPT, script=SCRIPT
    )
    return _int_label(rows).select("doc_id", "text", "label", "source")


def variants(spark: SparkSession, sf: str) -> DataFrame:
    chosen = templates.select_templates(TEMPLATES)
    made = templates.generate_variants(
        table(spark, sf, "documents"), chosen, keep=("doc_id",)
    )
    return made.select("doc_id", "attack_name", "attack_class", F.md5("attack_text").alias("text_md5"))


def template_choice(spark: SparkSession, sf: str) -> DataFrame:
    chosen = templates.select_templates(TEMPLATES, ["roleplay", "output_formatting"])
    made = templates.generate_variants(table(spark, sf, "conversations"), chosen)
    return made.groupBy("attack_name", "attack_class").agg(
        F.count("*").alias("n"), F.sum(F.length("attack_text")).cast("bigint").alias("chars")
    )


def variant_rows(spark: SparkSession, sf: str) -> DataFrame:
    seeds = table(spark, sf, "benchmark")
    made = templates.generate_variants(seeds, templates.select_templates(TEMPLATES), keep=("item_id",))
    rows = readers.parse_variants(made, keep=("item_id",))
    return _int_label(rows).select(
        "item_id", "text", "label", "source", "subcategory", "lang", "meta.seed_text"
    )


def _split_rows(spark: SparkSession, sf: str) -> DataFrame:
    return assign_split(corpus(spark, sf)).select("doc_id", "text", "label", "split")


def published_split(spark: SparkSession, sf: str) -> DataFrame:
    base = store.scratch_path(spark, "splits")
    store.publish_splits(_split_rows(spark, sf), base, "v1")
    rows = readers.read_splits(spark, f"{base}/data", "v1", "train")
    return rows.select("doc_id", F.length("text").cast("bigint").alias("chars"))


def recent_predictions(spark: SparkSession, sf: str) -> DataFrame:
    base = store.scratch_path(spark, "predictions")
    log = sampled_log(predictions(spark, sf), 1.0, id_col="event_id")
    log.write.partitionBy("date", "family").parquet(base)
    as_of = log.agg(F.max("date")).first()[0]
    rows = readers.recent_predictions(spark, base, "fam1", as_of=as_of)
    return rows.select("event_id", "text", F.col("date").cast("string").alias("date"))


def reference_sample(spark: SparkSession, sf: str) -> DataFrame:
    return readers.reference_sample(
        table(spark, sf, "documents"), id_col="doc_id", max_rows=500
    ).select("doc_id")


def _logged(spark: SparkSession, sf: str, rate: float) -> DataFrame:
    base = store.scratch_path(spark, "prediction-log")
    query = log_predictions(
        as_predictions(stream_of(spark, sf, "events")),
        f"{base}/rows",
        f"{base}/state",
        id_col="event_id",
        rate=rate,
        available_now=True,
    )
    query.awaitTermination()
    return spark.read.parquet(f"{base}/rows").select(
        "event_id", "label", F.col("date").cast("string").alias("date"), "family"
    )


def logged_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return _logged(spark, sf, 1.0)


def publish_twice(spark: SparkSession, sf: str) -> DataFrame:
    base = store.scratch_path(spark, "publish")
    rows = _split_rows(spark, sf)
    first = store.publish_splits(rows, base, "v1").withColumn("attempt", F.lit(1))
    second = store.publish_splits(rows, base, "v1").withColumn("attempt", F.lit(2))
    return first.unionByName(second)


def stage_output(spark: SparkSession, sf: str) -> DataFrame:
    path = store.scratch_path(spark, "stage") + "/merged/all"
    rows = corpus(spark, sf)
    store.write_stage(rows, path)
    store.write_stage(rows, path)
    back = readers.with_row_id(spark.read.parquet(path))
    return back.groupBy("source").agg(
        F.count("*").alias("n"), F.countDistinct("row_id").alias("n_ids")
    )


def features_once(spark: SparkSession, sf: str) -> DataFrame:
    base = store.scratch_path(spark, "features")
    key = store.feature_key("v1", "char/features", None, "all")
    docs = table(spark, sf, "documents")

    def compute() -> DataFrame:
        return docs.select("doc_id", tx.char_features("text", SCRIPT).alias("f"))

    def never() -> DataFrame:
        raise AssertionError("a committed key must not be computed again")

    store.compute_once(spark, base, key, compute)
    rows = store.compute_once(spark, base, key, never)
    return rows.select("doc_id", F.col("f")[0].alias("chars"), F.col("f")[1].alias("letters"))


def empty_union(spark: SparkSession, sf: str) -> DataFrame:
    empty = schema.empty_canonical(spark)
    merged = schema.merge_all([empty, corpus(spark, sf).drop("doc_id")])
    return merged.groupBy("source", "lang").agg(F.count("*").alias("n"), F.count("label").alias("labelled"))


def schema_check(spark: SparkSession, sf: str) -> DataFrame:
    rows = schema.validate_schema(corpus(spark, sf))
    broken = rows.withColumn("label", F.col("label").cast("string"))
    errors = "; ".join(schema.schema_errors(broken))
    return rows.groupBy("source").agg(F.count("*").alias("n")).withColumn("broken", F.lit(errors))


def merged_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Four tables with four meta structs; ``row_id`` is unique within a source."""
    no_sub = F.lit(None).cast("string")
    docs = corpus(spark, sf).withColumnRenamed("doc_id", "row_id")
    bench = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("row_id"),
        "text",
        F.lit(1).cast("byte").alias("label"),
        F.lit("benchmark").alias("source"),
        no_sub.alias("subcategory"),
        F.lit("en").alias("lang"),
        F.struct("item_id").alias("meta"),
    )
    talks = (
        table(spark, sf, "conversations")
        .where(F.col("role") == "user")
        .select(
            (F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"),
            "text",
            F.lit(0).cast("byte").alias("label"),
            F.lit("conversations").alias("source"),
            no_sub.alias("subcategory"),
            F.lit("en").alias("lang"),
            F.struct("conv_id", "turn").alias("meta"),
        )
    )
    pages = table(spark, sf, "pages").select(
        F.col("page_id").alias("row_id"),
        F.regexp_replace("html", "<[^>]*>", " ").alias("text"),
        F.lit(0).cast("byte").alias("label"),
        F.lit("pages").alias("source"),
        no_sub.alias("subcategory"),
        F.lit("en").alias("lang"),
        F.struct("url").alias("meta"),
    )
    return schema.merge_all([docs, bench, talks, pages])


def union_all(spark: SparkSession, sf: str) -> DataFrame:
    return merged_sources(spark, sf).select(
        "row_id",
        "source",
        F.col("label").cast("int").alias("label"),
        F.md5("text").alias("text_md5"),
        "meta.orig_source",
        "meta.item_id",
        "meta.conv_id",
        "meta.url",
    )


def tagged_union(spark: SparkSession, sf: str) -> DataFrame:
    rows = _split_rows(spark, sf)
    parts = {s: rows.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")}
    return schema.tag_union(parts).groupBy("split", "label").agg(F.count("*").alias("n")).select(
        "split", F.col("label").cast("int").alias("label"), "n"
    )


QUERIES = {
    "a01_record_json": record_json,
    "a02_prompt_csv": prompt_csv,
    "a03_safety_parquet": safety_parquet,
    "a04_benign_lines": benign_lines,
    "a05_article_sample": article_sample,
    "a06_variants": variants,
    "a07_template_choice": template_choice,
    "a08_variant_rows": variant_rows,
    "a09_split_read": published_split,
    "a10_recent_predictions": recent_predictions,
    "a11_reference_sample": reference_sample,
    "a12_prediction_log_stream": logged_predictions,
    "a13_publish_once": publish_twice,
    "a14_stage_output": stage_output,
    "a15_features_once": features_once,
    "b01_empty_union": empty_union,
    "b02_schema_check": schema_check,
    "b03_merge_sources": union_all,
    "b04_tagged_union": tagged_union,
}

_STRIP = f"regexp_replace(line, '^{SQL_SPACE}|{SQL_SPACE}$', '', 'g')"


def _sql_benign(lines: str, columns: str) -> str:
    """Filter of benign lines over a relation with ``line``."""
    return rf"""
stripped AS (SELECT *, {_STRIP} AS stripped FROM {lines}),
letters AS (
  SELECT *, length(regexp_replace(stripped, '[^\pL]+', '', 'g')) AS n_letters,
         length(regexp_replace(regexp_replace(stripped, '[^\pL]+', '', 'g'), '[{SQL_SCRIPT}]+', '', 'g')) AS n_other
  FROM stripped
)
SELECT {columns} FROM letters
WHERE length(stripped) BETWEEN 30 AND 2000 AND n_letters > 0
  AND (n_letters - n_other) / n_letters >= {MIN_SCRIPT}
"""


ORACLES = {
    "a01_record_json": """
SELECT doc_id, text, 1 AS label, 'dmtrdr_ru' AS source, lang AS subcategory, 'ru' AS lang,
       CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END AS prompt_en, source AS orig_source
FROM documents""",
    "a02_prompt_csv": """
SELECT doc_id, text, 1 AS label, 'hivetrace_sysprompt' AS source,
       'sub' || (doc_id % 4)::VARCHAR AS subcategory, 'fr' AS lang, source AS category
FROM documents WHERE lang = 'fr'""",
    "a03_safety_parquet": """
SELECT d.doc_id, d.text, l.toxic AS label, 'wildguardmix_ru' AS source, d.source AS subcategory,
       'fr' AS lang, 'allenai/wildguardmix' AS orig_source
FROM documents d JOIN labels l USING (doc_id) WHERE d.lang = 'fr'""",
    "a04_benign_lines": "WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, "
    "generate_subscripts(string_split(text, chr(10)), 1)::INT - 1 AS line_no FROM documents),"
    + _sql_benign(
        "lines",
        "doc_id, line_no, stripped AS text, 0 AS label, 'benign_wiki' AS source, "
        "'benign_wiki' AS orig_source",
    ),
    "a05_article_sample": f"""
WITH keyed AS (SELECT doc_id, text, {sql_sample_key('doc_id')} AS k FROM documents),
drawn AS (SELECT * FROM keyed ORDER BY k, doc_id LIMIT {4 * ARTICLES}),
firsts AS (SELECT doc_id, k, string_split(text, chr(10))[1] AS line FROM drawn),
taken AS (SELECT * FROM firsts WHERE line <> '' ORDER BY k, doc_id LIMIT {ARTICLES}),
"""
    + _sql_benign("taken", "doc_id, stripped AS text, 0 AS label, 'benign_wiki' AS source"),
    "a06_variants": f"""
WITH {_SQL_TEMPLATES}
SELECT doc_id, attack_name, attack_class, md5(replace(body, '{{seed}}', text)) AS text_md5
FROM documents, templates""",
    "a07_template_choice": f"""
WITH {_SQL_TEMPLATES}
SELECT attack_name, attack_class, count(*) AS n,
       sum(length(replace(body, '{{seed}}', text)))::BIGINT AS chars
FROM conversations, templates WHERE attack_name IN ('roleplay', 'output_formatting')
GROUP BY ALL""",
    "a08_variant_rows": f"""
WITH {_SQL_TEMPLATES}
SELECT item_id, replace(body, '{{seed}}', text) AS text, 1 AS label,
       'hivetracered_attack' AS source, attack_name AS subcategory, 'ru' AS lang, text AS seed_text
FROM benchmark, templates""",
    "a09_split_read": f"""
SELECT doc_id, length(text) AS chars FROM documents WHERE {sql_split('text')} = 'train'""",
    "a10_recent_predictions": f"""
WITH {PREDICTIONS}
SELECT event_id, text, ts::DATE::VARCHAR AS date FROM predictions
WHERE family = 'fam1' AND ts::DATE >= (SELECT max(ts)::DATE FROM predictions) - 6""",
    "a11_reference_sample": f"""
SELECT doc_id FROM documents ORDER BY {sql_sample_key('doc_id')}, doc_id LIMIT 500""",
    "a12_prediction_log_stream": f"""
WITH {PREDICTIONS}
SELECT event_id, label, ts::DATE::VARCHAR AS date, family FROM predictions""",
    "a13_publish_once": f"""
SELECT {sql_split('text')} AS split, count(*) AS n_rows,
       CASE attempt WHEN 1 THEN 'uploaded' ELSE 'skipped' END AS status, attempt
FROM documents, (VALUES (1), (2)) t(attempt) GROUP BY ALL""",
    "a14_stage_output": """
SELECT source, count(*) AS n, count(*) AS n_ids FROM documents GROUP BY source""",
    "a15_features_once": r"""
SELECT doc_id, length(text)::DOUBLE AS chars,
       length(regexp_replace(text, '[^\pL]+', '', 'g'))::DOUBLE AS letters
FROM documents""",
    "b01_empty_union": f"""
WITH {CORPUS}
SELECT source, lang, count(*) AS n, count(label) AS labelled FROM corpus GROUP BY ALL""",
    "b02_schema_check": """
SELECT source, count(*) AS n, 'label must be tinyint, got string' AS broken
FROM documents GROUP BY source""",
    "b03_merge_sources": f"""
WITH {CORPUS}
SELECT doc_id AS row_id, source, label, md5(text) AS text_md5, source AS orig_source,
       NULL::BIGINT AS item_id, NULL::BIGINT AS conv_id, NULL AS url FROM corpus
UNION ALL SELECT item_id, 'benchmark', 1, md5(text), NULL, item_id, NULL, NULL FROM benchmark
UNION ALL SELECT conv_id * 1000 + turn, 'conversations', 0, md5(text), NULL, NULL, conv_id, NULL
          FROM conversations WHERE role = 'user'
UNION ALL SELECT page_id, 'pages', 0, md5(regexp_replace(html, '<[^>]*>', ' ', 'g')), NULL, NULL,
          NULL, url FROM pages""",
    "b04_tagged_union": f"""
WITH {CORPUS}
SELECT {sql_split('text')} AS split, label, count(*) AS n FROM corpus GROUP BY ALL""",
}
