from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from featurelab.functions.hashing import key_hash
from featurelab.operators import sampling
from featurelab.operators.folds import check_folds, fold_sizes, kfold, train_flag
from featurelab.operators.sampling import (
    bernoulli,
    identify_rows,
    negatives_needed,
    rebalance,
    sample_to,
    take_exact,
)


def digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def labelled(spark, positives, negatives, other=0):
    n = positives + negatives + other
    y = F.when(F.col("id") < positives, 1).when(F.col("id") < positives + negatives, 0)
    return spark.range(n).withColumn("y", y.cast("int"))


def test_hash_is_the_documented_one(spark):
    row = spark.range(17, 18).select(key_hash("id", "a"), key_hash(["id", "id"], "b")).first()
    assert list(row) == [digest("17:a"), digest("17:17:b")]


def test_missing_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(None,), (None,), (3,)], "id long")
    assert take_exact(df, "id", 2).count() == 2
    assert kfold(df, "id", 2).filter("fold_id is null").count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 499, 500, 999, 1000, 5000])
def test_take_exact_is_the_hash_ordered_prefix(spark, n):
    order = sorted(range(1000), key=lambda i: (digest(f"{i}:take"), i))
    for parts in (1, 7):
        assert ids(take_exact(spark.range(0, 1000, 1, parts), "id", n)) == sorted(order[:n])


@pytest.mark.parametrize("few", [0, 10_000])
def test_take_exact_splits_a_hot_key(spark, monkeypatch, few):
    monkeypatch.setattr(sampling, "FEW_ROWS", few)
    hot = spark.range(600).select(
        F.when(F.col("id") < 400, 5).otherwise(F.col("id")).alias("id"), F.col("id").alias("v")
    )
    for n in (1, 150, 399, 450, 599):
        one, seven = (take_exact(hot.repartition(parts), "id", n) for parts in (1, 7))
        assert one.count() == n
        assert sorted(one.collect()) == sorted(seven.collect())


def test_both_ways_to_take_a_prefix_agree(spark, monkeypatch):
    df = spark.range(3000).select((F.col("id") % 700).alias("id"), F.col("id").alias("v"))
    direct = sorted(take_exact(df, "id", 1234).collect())
    monkeypatch.setattr(sampling, "FEW_ROWS", 0)
    assert sorted(take_exact(df, "id", 1234).collect()) == direct


def test_take_exact_among_copies(spark, monkeypatch):
    monkeypatch.setattr(sampling, "FEW_ROWS", 0)
    copies = spark.range(90).select(F.lit(1).alias("id"))
    assert take_exact(copies, "id", 31).count() == 31


def test_sample_to(spark):
    df = spark.range(10_000)
    got = sample_to(df, "id", 2500)
    assert 2300 < got.count() < 2700
    assert ids(got) == ids(sample_to(df.repartition(7), "id", 2500))
    assert sample_to(df, "id", None) is df and sample_to(df, "id", 10_000) is df
    assert bernoulli(df, "id", 1.0) is df and bernoulli(df, "id", 0.0).count() == 0


def test_sample_is_a_filter(spark):
    plan = bernoulli(spark.range(100), "id", 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("repeats", [900, 1300])
def test_hot_keys_stay_whole_on_every_layout(spark, repeats):
    crowded = spark.range(20_000).select(
        F.when(F.col("id") < repeats, -1).otherwise(F.col("id")).alias("id"), F.col("id").alias("v")
    )
    results = []
    for parts in (1, 7):
        known = identify_rows(crowded.repartition(parts), "id")
        assert known.keys == ["id"] and known.count == 20_000
        folds = kfold(known.df, known.keys, 4)
        assert folds.filter("id = -1").select("fold_id").distinct().count() == 1
        results.append(sorted(folds.select("v", "fold_id").collect()))
    assert results[0] == results[1]


def test_rows_told_apart_by_content(spark):
    crowded = spark.range(6000).select(F.lit(-1).alias("id"), F.col("id").alias("v"))
    results = []
    for parts in (1, 7):
        known = identify_rows(crowded.repartition(parts), "id", by_content=True)
        assert known.keys == ["id", sampling.ROW_ID]
        folds = kfold(known.df, known.keys, 4)
        assert all(1300 < r["count"] < 1700 for r in folds.groupBy("fold_id").count().collect())
        results.append(sorted(folds.select("v", "fold_id").collect()))
    assert results[0] == results[1]


@pytest.mark.parametrize(
    ("positives", "share", "expected"), [(100, 0.2, 400), (3, 0.3, 7), (2978, 0.3, 6948), (10, 0.999, 0)]
)
def test_negatives_needed_is_exact(positives, share, expected):
    assert negatives_needed(positives, share) == expected


def test_rebalance_resamples_and_drops_unlabelled(spark):
    got = rebalance(labelled(spark, 100, 1000, 20), "y", 0.2, "id")
    counts = {r.y: r["count"] for r in got.groupBy("y").count().collect()}
    assert counts == {1: 100, 0: 400}
    assert ids(got) == ids(rebalance(labelled(spark, 100, 1000, 20).repartition(7), "y", 0.2, "id"))


def test_rebalance_is_one_scan_without_shuffle(spark):
    got = rebalance(labelled(spark, 100, 1000), "y", 0.2, "id")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Range (") == 1


@pytest.mark.parametrize(
    ("positives", "negatives", "share"),
    [(50, 50, 0.3), (0, 10, 0.3), (10, 0, 0.3), (10, 100, 0.0), (10, 100, 1.0), (20, 80, 0.2)],
)
def test_rebalance_leaves_the_table_alone(spark, positives, negatives, share):
    df = labelled(spark, positives, negatives, 5)
    assert rebalance(df, "y", share, "id").count() == positives + negatives + 5


def test_rebalance_to_positives_only(spark):
    assert ids(rebalance(labelled(spark, 1, 10), "y", 0.9, "id")) == [0]


def test_rebalance_with_a_hot_key(spark):
    df = labelled(spark, 100, 1000).withColumn("k", F.when(F.col("y") == 0, 1).otherwise(F.col("id")))
    got = rebalance(df, "y", 0.2, "k")
    assert got.columns == df.columns
    assert {r.y: r["count"] for r in got.groupBy("y").count().collect()} == {1: 100, 0: 400}


def test_folds(spark):
    df = train_flag(kfold(spark.range(4000), "id", 4), "id", 0.3)
    rows = fold_sizes(df).collect()
    assert sorted(r.fold_id for r in rows) == [0, 1, 2, 3]
    assert all(r.train_cnt + r.valid_cnt == r.total_cnt for r in rows)
    assert all(0.25 < r.valid_cnt / r.total_cnt < 0.35 for r in rows)
    check_folds(df, 4, 0.2)
    with pytest.raises(ValueError):
        check_folds(df, 4, 0.4)
    with pytest.raises(ValueError):
        check_folds(train_flag(kfold(spark.range(40), "id", 2), "id", 0.0), 2)
    assert train_flag(spark.range(50), "id", 0.0).filter("is_train = 0").count() == 0
