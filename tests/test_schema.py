import pytest
from pyspark.sql import functions as F

from textward.sources import schema

DDL = (
    "text string, label tinyint, source string, subcategory string, lang string, "
    "meta struct<orig_source:string>"
)


def one(spark, source="src1", meta=("m",)):
    return spark.createDataFrame([("t", 1, source, None, "ru", meta)], DDL)


def test_empty_table_is_canonical(spark):
    empty = schema.empty_canonical(spark)
    assert schema.schema_errors(empty) == [] and empty.count() == 0


def test_accepts_extra_columns(spark):
    assert schema.validate_schema(one(spark).withColumn("extra", F.lit(1))).columns[-1] == "extra"


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda df: df.drop("label", "lang"), r"missing columns: \['label', 'lang'\]"),
        (lambda df: df.withColumn("label", F.lit("1")), "label must be tinyint, got string"),
        (lambda df: df.withColumn("source", F.lit(1)), "source must be string, got int"),
        (lambda df: df.withColumn("meta", F.lit("x")), "meta must be struct, got string"),
    ],
)
def test_rejects(spark, change, message):
    with pytest.raises(ValueError, match=message):
        schema.validate_schema(change(one(spark)))


def test_merge_widens_meta(spark):
    other = one(spark, "src2").withColumn("meta", F.struct(F.lit("c").alias("category")))
    merged = schema.merge_all([one(spark), other])
    got = {r.source: r.meta.asDict() for r in merged.collect()}
    assert got == {
        "src1": {"orig_source": "m", "category": None},
        "src2": {"orig_source": None, "category": "c"},
    }


def test_merge_of_nothing(spark):
    assert schema.merge_all([], spark).count() == 0


def test_tag_union(spark):
    tagged = schema.tag_union({"train": one(spark), "val": one(spark)})
    assert sorted(r.split for r in tagged.collect()) == ["train", "val"]
