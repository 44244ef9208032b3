import hashlib

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from textward.functions.sampling import bernoulli
from textward.operators import sampling


def key(i, seed=42):
    return hashlib.md5(f"{seed}|{i}".encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 7, 999, 1000, 5000])
def test_exact_size_and_rows(spark, n):
    df = spark.range(1000)
    got = sorted(r.id for r in sampling.sample_exact(df, n, id_col="id").collect())
    assert got == sorted(sorted(range(1000), key=lambda i: (key(i), i))[:n])


def test_sample_moves_no_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = plan_of(sampling.sample_exact(docs, 50, id_col="doc_id"))
    # The text column is read by the outermost scan only, with no exchange above that scan.
    with_text = [line for line in plan.splitlines() if "Exchange" in line and "text" in line]
    assert not with_text and "TakeOrdered" not in plan and "Cartesian" not in plan


def test_sample_is_stable_under_partitioning(spark):
    ids = [
        {r.id for r in sampling.sample_exact(spark.range(0, 500, 1, p), 100, id_col="id").collect()}
        for p in (1, 7)
    ]
    assert ids[0] == ids[1]
    other = {r.id for r in sampling.sample_exact(spark.range(500), 100, id_col="id", seed=1).collect()}
    assert other != ids[0]


def labelled(spark, labels):
    return spark.createDataFrame(list(enumerate(labels)), "id int, label tinyint")


def counts(df):
    return {r.label: r["count"] for r in df.groupBy("label").count().collect()}


def test_balance(spark):
    assert counts(sampling.balance_classes(labelled(spark, [1, 1, 1, 1, 0]), id_col="id")) == {1: 1, 0: 1}
    assert counts(sampling.balance_classes(labelled(spark, [1, 1, 0, 0]), id_col="id")) == {1: 2, 0: 2}


def test_balance_drops_other_labels_unless_a_class_is_missing(spark):
    assert counts(sampling.balance_classes(labelled(spark, [1, 0, None, 2]), id_col="id")) == {1: 1, 0: 1}
    one_class = sampling.balance_classes(labelled(spark, [1, 1, None]), id_col="id")
    assert counts(one_class) == {1: 2, None: 1}
    assert counts(sampling.balance_classes(labelled(spark, []), id_col="id")) == {}


@pytest.mark.parametrize("ratio", [0.1, 0.3, 0.5, 0.9])
def test_balance_targets(spark, ratio):
    got = counts(sampling.balance_classes(labelled(spark, [1] * 37 + [0] * 90), ratio, id_col="id"))
    pos, neg = sampling.balance_targets(37, 90, ratio)
    assert (got.get(1, 0), got.get(0, 0)) == (pos, neg)


def test_bernoulli_rates(spark):
    df = spark.range(20_000)
    assert df.where(bernoulli("id", 0.0)).count() == 0
    assert df.where(bernoulli("id", 1.0)).count() == 20_000
    assert 150 < df.where(bernoulli("id", 0.01)).count() < 250


def test_shuffle_key(spark):
    got = sampling.shuffled(spark.range(20), id_col="id").orderBy("shuffle_key").collect()
    assert [r.id for r in got] == sorted(range(20), key=key)


def test_stage_counts(spark):
    got = sampling.stage_counts({"a": spark.range(5), "b": spark.range(2)}).orderBy("step").collect()
    assert [(r.stage, r.n_rows) for r in got] == [("a", 5), ("b", 2)]


def test_hot_label(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 50 == 0, 1).otherwise(0).cast("byte").alias("label"))
    assert counts(sampling.balance_classes(df, id_col="id")) == {1: 100, 0: 100}


def test_balance_reads_the_table_twice_before_its_filter(spark, tmp_path):
    df = spark.range(3000).select("id", (F.col("id") % 3 == 0).cast("int").alias("label"), F.lit("t").alias("text"))
    df.write.parquet(str(tmp_path / "t"))
    got = sampling.balance_classes(spark.read.parquet(str(tmp_path / "t")), 0.2, id_col="id")
    plan = plan_of(got)
    # What is left is one scan with a filter of literals.
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "ubquery" not in plan
    assert counts(got) == {1: 500, 0: 2000}
    kept = {r.id for r in got.where("label = 1").collect()}
    assert kept == set(sorted(range(0, 3000, 3), key=key)[:500])
