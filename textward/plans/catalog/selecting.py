"""Run selection, versions and pins.

Orders are training runs, their returned lines registered versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.operators import selection
from textward.operators.splitting import assign_split, data_version
from textward.plans.catalog.tables import CORPUS, corpus, sql_split, table


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth customer's runs have no metric; some have no family."""
    value = F.when(F.col("o_custkey") % 10 != 0, F.col("o_totalprice"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_orderpriority")).alias("family"),
        F.col("o_orderstatus").alias("data_version"),
        F.col("o_orderkey").alias("seq"),
        F.when(value.isNotNull(), F.create_map(F.lit("val_f1"), value)).alias("metrics"),
    )


def _model_name():
    return F.concat(F.lit("model-"), F.col("family"))


def best(spark: SparkSession, sf: str) -> DataFrame:
    return selection.best_runs(runs(spark, sf), "F")


def champion(spark: SparkSession, sf: str) -> DataFrame:
    return selection.champion(best(spark, sf))


def versions(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return (
        table(spark, sf, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .where(F.col("l_returnflag") == "R")
        .select(
            F.col("o_orderkey").cast("string").alias("run_id"),
            F.concat(F.lit("model-"), F.col("o_orderpriority")).alias("model_name"),
            F.col("l_partkey").cast("string").alias("version"),
            (F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).alias("seq"),
        )
    )


def resolved(spark: SparkSession, sf: str) -> DataFrame:
    return selection.resolve_versions(best(spark, sf), versions(spark, sf), _model_name())


def pins(spark: SparkSession, sf: str) -> DataFrame:
    """A customer's number of open orders is its pinned version, of finished ones the production."""
    orders = table(spark, sf, "orders")

    def count(status: str, name: str) -> DataFrame:
        return (
            orders.where(F.col("o_orderstatus") == status)
            .groupBy(F.col("o_custkey").cast("string").alias("model_name"))
            .agg(F.count("*").alias(name))
        )

    return selection.pin_changes(count("O", "pinned"), count("F", "prod"))


def version(spark: SparkSession, sf: str) -> DataFrame:
    return data_version(assign_split(corpus(spark, sf)), ["doc_id", "text", "label"])


QUERIES = {
    "j01_best_runs": best,
    "j02_champion": champion,
    "j03_resolve_versions": resolved,
    "j04_pin_changes": pins,
    "j05_data_version": version,
}

_BEST = """best AS (
  SELECT o_orderpriority AS family, o_orderkey::VARCHAR AS run_id, o_totalprice AS val_f1, o_orderkey AS seq,
         min(o_orderkey) OVER (PARTITION BY o_orderpriority) AS first_seq
  FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 10 <> 0 AND o_custkey % 7 <> 0
  QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) = 1
)"""

ORACLES = {
    "j01_best_runs": f"WITH {_BEST} SELECT * FROM best",
    "j02_champion": f"WITH {_BEST} SELECT * FROM best ORDER BY val_f1 DESC, first_seq LIMIT 1",
    "j03_resolve_versions": f"""
WITH {_BEST},
v AS (
  SELECT o_orderkey::VARCHAR AS run_id, 'model-' || o_orderpriority AS model_name, l_partkey::VARCHAR AS version
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'
  QUALIFY row_number() OVER (PARTITION BY o_orderkey, o_orderpriority
                             ORDER BY l_linenumber * 1000000 + l_partkey) = 1
)
SELECT family, model_name, run_id, version,
       family = (SELECT family FROM best ORDER BY val_f1 DESC, first_seq LIMIT 1) AS is_champion
FROM best JOIN v USING (run_id) WHERE model_name = 'model-' || family""",
    "j04_pin_changes": """
SELECT o_custkey::VARCHAR AS model_name, count(*) FILTER (o_orderstatus = 'O') AS pinned,
       count(*) FILTER (o_orderstatus = 'F') AS prod
FROM orders GROUP BY o_custkey HAVING pinned > 0 AND prod > 0 AND pinned <> prod""",
    "j05_data_version": f"""
WITH {CORPUS},
r AS (SELECT {sql_split('text')} AS split,
      ('0x' || substr(sha256(concat_ws(chr(31), doc_id::VARCHAR, text, coalesce(label::VARCHAR, ''))), 1, 15))::HUGEINT AS h
      FROM corpus),
d AS (SELECT sha256(sum(h)::VARCHAR || ':' || count(*)::VARCHAR) AS digest FROM r GROUP BY split)
SELECT substr(sha256(string_agg(digest, '|' ORDER BY digest)), 1, 12) AS data_version FROM d""",
}
