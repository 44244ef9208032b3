import random

import pytest

from textward.operators import sketches

WANTED = {"p10": 0.1, "p50": 0.5, "p99": 0.99}


@pytest.mark.parametrize("k, most", [(100, 0.03), (800, 0.006)])
def test_merged_days_answer_within_the_bound(spark, k, most):
    rng = random.Random(k)
    data = [("f" if i % 3 else None, i % 17, rng.lognormvariate(0, 2)) for i in range(60_000)]
    df = spark.createDataFrame(data, "family string, day int, v double").repartition(6)
    daily = sketches.sketch_values(df, "v", ["family", "day"], k)
    assert daily.count() == 34
    merged = sketches.merge_sketches(daily, ["family"])
    found = sketches.sketch_quantiles(merged, WANTED)
    assert {(r.family, r.n) for r in found.collect()} == {("f", 40_000), (None, 20_000)}
    for r in sketches.merge_sketches(daily, []).transform(lambda d: sketches.sketch_quantiles(d, WANTED)).collect():
        values = sorted(v for *_, v in data)
        for name, q in WANTED.items():
            assert abs(sum(v <= r[name] for v in values) / len(values) - q) <= most
    # A single answer of each group may leave the 99 % bound; the bounds here are wider.
    stored = spark.createDataFrame(found.collect(), found.schema)
    errors = sketches.rank_error(df, "v", stored, WANTED, ["family"]).collect()
    assert len(errors) == 6 and max(r.error for r in errors) <= most


def test_nulls_ties_and_no_rows(spark):
    data = [("a", None), ("a", float("nan")), ("b", 7.0), ("b", 7.0), ("b", None), ("c", float("inf"))]
    df = spark.createDataFrame(data, "g string, v double")
    found = sketches.sketch_quantiles(sketches.sketch_values(df, "v", ["g"]), WANTED)
    assert {(r.g, r.n, r.p50) for r in found.collect()} == {("b", 2, 7.0), ("c", 1, float("inf"))}
    errors = sketches.rank_error(df, "v", found, WANTED, ["g"]).collect()
    assert len(errors) == 6 and {r.error for r in errors} == {0.0}
    assert sketches.sketch_values(df.where("g > 'x'"), "v", ["g"]).count() == 0
