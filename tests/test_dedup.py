from __future__ import annotations

from pyspark.sql import functions as F

from featurelab.operators.dedup import dedup, dedup_splits
from featurelab.operators.splits import Splits


def test_train_wins_then_lowest_key(spark):
    schema = "id int, k string, v map<string,int>"
    train = spark.createDataFrame([(5, "a", {"x": 1}), (3, "a", {"x": 2}), (9, "b", None)], schema)
    valid = spark.createDataFrame([(1, "a", None), (2, "c", None), (4, "c", {"y": 1})], schema)
    got = dedup_splits(Splits(train, valid, valid), ["k"], "id")
    assert sorted((r.id, r.k) for r in got.train.collect()) == [(3, "a"), (9, "b")]
    assert [(r.id, r.k, r.v) for r in got.valid.collect()] == [(2, "c", None)]
    assert got.train.filter("id = 3").first().v == {"x": 2}
    assert got.train.columns == train.columns
    assert got.scoring.count() == 3
    assert dedup_splits(Splits(train, valid, valid), ["k"], "id", scoring=True).scoring.count() == 2


def test_train_alone(spark):
    train = spark.createDataFrame([(2, "a"), (1, "a"), (3, None), (4, None)], "id int, k string")
    got = dedup_splits(Splits(train), ["k"], "id").train
    assert sorted(r.id for r in got.collect()) == [1, 3]


def test_all_columns_as_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "id int, k string")
    assert dedup(df, ["id", "k"], "id").count() == 2


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(9000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    got = dedup(df, ["k"], "id")
    assert got.count() == 6001
    assert got.filter("k = 0").first().id == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_same_rows_for_any_partitioning(spark):
    df = spark.range(500).select("id", (F.col("id") % 37).alias("k"), F.rand(1).alias("v")).cache()
    expected = sorted(dedup(df, ["k"], "id").collect())
    assert sorted(dedup(df.repartition(7), ["k"], "id").collect()) == expected
