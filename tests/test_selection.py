import pytest
from pyspark.sql import functions as F

from textward.operators import selection

DDL = "run_id string, family string, data_version string, seq int, metrics map<string,double>"


def runs(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


@pytest.fixture
def some(spark):
    return runs(
        spark,
        ("a", "tfidf", "v1", 0, {"val_f1": 0.90}),
        ("b", "tfidf", "v1", 1, {"val_f1": 0.93}),
        ("tie", "tfidf", "v1", 2, {"val_f1": 0.93}),
        ("c", "boosted", "v1", 3, {"val_f1": 0.97}),
        ("d", "transformer", "v1", 4, {"val_f1": 0.99}),
        ("other", "transformer", "v0", 5, {"val_f1": 1.0}),
        ("no_family", None, "v1", 6, {"val_f1": 1.0}),
        ("no_metric", "boosted", "v1", 7, {"loss": 1.0}),
        ("no_metrics", "boosted", "v1", 8, None),
    )


def test_best_and_champion(some):
    best = selection.best_runs(some, "v1")
    assert {r.family: r.run_id for r in best.collect()} == {"tfidf": "b", "boosted": "c", "transformer": "d"}
    assert selection.champion(best).first().run_id == "d"


def test_champion_tie_goes_to_the_family_seen_first(spark):
    tied = runs(
        spark,
        ("a0", "a", "v1", 0, {"val_f1": 0.1}),
        ("b1", "b", "v1", 1, {"val_f1": 0.9}),
        ("a5", "a", "v1", 5, {"val_f1": 0.9}),
    )
    assert selection.champion(selection.best_runs(tied)).first().run_id == "a5"


def test_no_runs(spark, some):
    assert selection.best_runs(some, "nope").count() == 0
    with pytest.raises(RuntimeError, match="nope"):
        selection.best_runs(some, "nope", strict=True)


def test_versions(spark, some):
    known = spark.createDataFrame(
        [("b", "m-tfidf", "7", 2), ("b", "m-tfidf", "6", 1), ("d", "m-transformer", "3", 0), ("c", "m-other", "9", 0)],
        "run_id string, model_name string, version string, seq int",
    )
    name = F.concat(F.lit("m-"), F.col("family"))
    got = selection.resolve_versions(selection.best_runs(some, "v1"), known, name)
    assert {(r.family, r.version, r.is_champion) for r in got.collect()} == {
        ("tfidf", "6", False),
        ("transformer", "3", True),
    }


def test_pins(spark):
    pins = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "model_name string, pinned string")
    prod = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "4"), ("d", "5")], "model_name string, prod string")
    assert [tuple(r) for r in selection.pin_changes(pins, prod).collect()] == [("b", "2", "3")]
