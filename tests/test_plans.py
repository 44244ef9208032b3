import pytest
from conftest import plan_of

from textward.plans import catalog
from textward.plans.corpus import build_corpus
from textward.plans.catalog.tables import corpus
from textward.operators import splitting

LAZY = [
    n
    for n in catalog.all_queries()
    if n[0] in "cehi" or n.startswith(("corpus", "d01", "d04", "d05", "d07", "f01", "j", "k03_rate_5m", "k04", "k08_class_imbalance"))
]
LAZY = [n for n in LAZY if not n.endswith("_stream")]
WITH_PYTHON = ("i01_ks_exact", "i04_drift_report", "i05", "i06")


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, small, name):
    plan = plan_of(catalog.all_queries()[name](spark, small))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if not name.startswith(WITH_PYTHON):
        assert "EvalPython" not in plan and "InPandas" not in plan


def test_every_query_has_sql_or_is_listed():
    no_sql = set(catalog.all_queries()) - set(catalog.all_oracles())
    assert no_sql == {"g01_train_logistic", "g02_train_boosted"}
    assert set(catalog.all_oracles()) <= set(catalog.all_queries())


def test_build_corpus(spark, small):
    built = build_corpus(corpus(spark, small), id_col="doc_id")
    funnel = {r.stage: r.n_rows for r in built.funnel.collect()}
    assert funnel["merged"] == 200 > funnel["deduped"] > funnel["balanced"] > 0
    assert built.rows.count() == funnel["balanced"]
    assert splitting.leaked_groups(built.rows).count() == 0
    labels = {r.label: r["count"] for r in built.rows.groupBy("label").count().collect()}
    assert labels[0] == labels[1]
    assert build_corpus(corpus(spark, small), id_col="doc_id", near_duplicates=False).rows.count() > 0


def test_funnel_counts_repeated_and_odd_rows(spark):
    data = [(1, "one two", 1), (2, "One  two", 1), (3, None, 0), (4, None, 0), (5, "", 0), (6, "three four", 1), (7, "x", None)]
    merged = spark.createDataFrame(data, "id bigint, text string, label int")
    for near in (True, False):
        built = build_corpus(merged, id_col="id", near_duplicates=near)
        assert [tuple(r)[1:] for r in built.funnel.orderBy("step").collect()] == [
            ("merged", 7), ("deduped", 5 - near), ("balanced", 4 - 2 * near)
        ]
