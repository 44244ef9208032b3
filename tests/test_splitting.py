import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from textward.operators import splitting


def samples(spark, n):
    return spark.range(n).select(
        "id",
        F.concat_ws(" ", F.lit("row"), F.md5(F.col("id").cast("string"))).alias("text"),
        (F.col("id") % 2).cast("byte").alias("label"),
    )


def test_split_sizes_follow_the_parts(spark):
    parts = (0.5, 0.2, 0.3)
    df = splitting.assign_split(samples(spark, 4000), parts)
    assert "Exchange" not in plan_of(df) and "Python" not in plan_of(df)
    got = {r.split: r["count"] / 4000 for r in df.groupBy("split").count().collect()}
    for name, part in zip(splitting.SPLITS, parts):
        assert abs(got[name] - part) < 0.04


def test_variants_of_a_text_stay_together(spark):
    words = [f"alpha {i} beta" for i in range(40)]
    variants = [v for w in words for v in (w, w.upper(), f"\t{w}\n", w.replace(" ", "   "))]
    df = spark.createDataFrame(list(enumerate(variants)), "id int, text string")
    assert splitting.leaked_groups(splitting.assign_split(df, (0.4, 0.4, 0.2))).count() == 0
    torn = df.withColumn("split", F.concat(F.lit("s"), (F.col("id") % 3).cast("string")))
    assert splitting.leaked_groups(torn).count() == len(words)


@pytest.mark.parametrize("parts", [(0.9, 0.2, 0.1), (1.2, -0.1, -0.1), (0.5, 0.5)])
def test_parts_of_no_whole(parts):
    with pytest.raises(ValueError, match="one part"):
        splitting.split_of("text", parts)


def version(df):
    return splitting.data_version(df, ["id", "text"]).first().data_version


def test_data_version(spark):
    df = splitting.assign_split(samples(spark, 100))
    v = version(df)
    assert len(v) == 12 and v == version(df.repartition(7).orderBy(F.desc("id")))
    assert v != version(df.where("id <> 5"))
    assert v != version(df.withColumn("text", F.when(F.col("id") == 5, "x").otherwise(F.col("text"))))
    assert v != version(df.unionAll(df.where("id = 5")))
