from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from featurelab.functions.metrics import rmse, roc_auc
from featurelab.functions.ordered import running_totals


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return won / (len(pos) * len(neg))


@pytest.mark.parametrize("levels", [3, 40, 10**6])
def test_auc_matches_pair_counting(spark, levels):
    rnd = random.Random(levels)
    rows = [(rnd.randrange(2), float(rnd.randrange(levels)), rnd.choice("ab")) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, s double, g string").repartition(5)
    assert roc_auc(df, "y", "s").first().auc == pytest.approx(brute_auc([r[:2] for r in rows]))
    got = {r.g: r.auc for r in roc_auc(df, "y", "s", ["g"]).collect()}
    for g in "ab":
        assert got[g] == pytest.approx(brute_auc([r[:2] for r in rows if r[2] == g]))


def test_auc_over_many_segments(spark):
    n = 20_000
    df = spark.range(n).select((F.col("id") >= n // 2).cast("int").alias("y"), F.col("id").alias("s"))
    assert roc_auc(df, "y", "s").first().auc == 1.0
    assert roc_auc(df, "y", -F.col("s")).first().auc == 0.0
    tied = df.select("y", F.when(F.col("s") % 3 == 0, -1).otherwise(F.col("s")).alias("s"))
    rows = [(r.y, r.s) for r in tied.filter("s < 600 or s > 19500").collect()]
    small = spark.createDataFrame(rows, "y int, s long")
    assert roc_auc(small, "y", "s").first().auc == pytest.approx(brute_auc(rows))


def test_auc_edges(spark):
    one_class = spark.createDataFrame([(1, 0.1), (1, 0.2)], "y int, s double")
    assert roc_auc(one_class, "y", "s").first().auc is None
    gaps = spark.createDataFrame([(1, 0.9), (0, 0.1), (None, 0.5), (0, None), (0, -0.0), (1, 0.0)], "y int, s double")
    assert roc_auc(gaps, "y", "s").first().auc == pytest.approx(brute_auc([(1, 0.9), (0, 0.1), (0, 0.0), (1, 0.0)]))


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (3.0, 3.0, "a"), (0.0, 4.0, "b")], "y double, p double, g string")
    got = {r.g: r.rmse for r in rmse(df, "y", "p", ["g"]).collect()}
    assert got == pytest.approx({"a": 0.5**0.5, "b": 4.0})


def test_running_totals(spark):
    rnd = random.Random(3)
    rows = [(g, i, rnd.randrange(100)) for g in "xyz" for i in rnd.sample(range(10_000), 700)]
    df = spark.createDataFrame(rows, "g string, k int, n int").repartition(6)
    got = {(r.g, r.k): (r.before, r.rank) for r in running_totals(
        df, ["g"], ["k"], {"before": F.col("n").cast("bigint"), "rank": F.lit(1).cast("bigint")}
    ).collect()}
    for g in "xyz":
        total = 0
        for rank, (_, k, n) in enumerate(sorted(r for r in rows if r[0] == g)):
            assert got[g, k] == (total, rank)
            total += n
