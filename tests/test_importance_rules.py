from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurelab.operators import correlated as correlated_module
from featurelab.operators.correlated import correlated, pearson_pairs
from featurelab.operators.folds import kfold
from featurelab.operators.models import Task, mean_contribution
from featurelab.operators.permute import add_noise, permute
from featurelab.operators.selectors import ForwardRule, ForwardSettings
from featurelab.operators.votes import above_noise, above_threshold, importance_rank, mean_metric, top_feature, vote


@pytest.fixture(scope="module")
def related(spark):
    x = F.col("id") % 97
    return spark.range(0, 2000, 1, 5).select(
        x.cast("double").alias("a"),
        (x * 2 + 1).alias("b_copy"),
        (-x).alias("c_minus"),
        (x + 30 * F.sin("id")).alias("d_near"),
        F.lit(0.1).alias("e_const"),
        F.when(F.col("id") > 3, x).cast("double").alias("f_gaps"),
        F.when(F.col("id") > 3, x).otherwise(float("nan")).alias("g_nan"),
        F.cos("id").alias("h_free"),
    )


def test_pairs_match_numpy(related):
    got = {(r.f1, r.f2): r.r for r in pearson_pairs(related, related.columns).collect()}
    assert len(got) == 28
    data = related.toPandas().astype(float)
    for (f1, f2), r in got.items():
        assert f1 < f2
        if {f1, f2} & {"e_const", "f_gaps", "g_nan"}:
            assert r is None
        else:
            assert r == pytest.approx(np.corrcoef(data[f1], data[f2])[0, 1], abs=1e-9)


def test_pairs_of_an_empty_table(related):
    assert all(r.r is None for r in pearson_pairs(related.limit(0), ["a", "b_copy"]).collect())
    assert pearson_pairs(related, ["a"]).collect() == []


def verdict(spark, pairs, scores, threshold=0.95):
    pairs = spark.createDataFrame(pairs, "f1 string, f2 string, r double")
    scores = spark.createDataFrame(scores, "feature_name string, score double")
    return sorted(r[0] for r in correlated(pairs, scores, threshold).collect())


def test_lower_score_goes_and_ties_drop_the_later(spark):
    pairs = [("a", "b", 0.99), ("c", "d", -0.97), ("e", "f", 0.94), ("g", "h", float("nan")), ("i", "j", 0.95)]
    scores = [("a", 1.0), ("b", 2.0), ("c", 1.0), ("d", 1.0), ("i", 0.5)]
    assert verdict(spark, pairs, scores) == ["a", "d", "j"]


def test_a_dropped_feature_still_displaces_others(spark):
    pairs = [("a", "b", 1.0), ("b", "c", 1.0), ("a", "c", 0.5)]
    assert verdict(spark, pairs, [("a", 3.0), ("b", 2.0), ("c", 1.0)]) == ["b", "c"]


def test_permutation_keeps_each_group(spark):
    df = kfold(spark.range(3000), "id", 3).withColumn("x", F.col("id") * 10)
    got = permute(df, ["x", "id"], "id", ["fold_id"]).cache()
    assert got.count() == 3000
    for fold in range(3):
        part = got.filter(F.col("fold_id") == fold)
        assert sorted(r[0] for r in part.select("perm_x").collect()) == sorted(r[0] for r in part.select("x").collect())
    assert got.filter("perm_x = x").count() == 0
    assert abs(got.stat.corr("x", "perm_x")) < 0.1
    assert got.filter("perm_x <> perm_id * 10").count() == 0


def test_permutation_ignores_the_layout(spark):
    df = spark.range(300).withColumn("x", F.col("id"))
    one = sorted(permute(df.repartition(1), ["x"], "id").collect())
    assert one == sorted(permute(df.repartition(7), ["x"], "id").collect())


def test_permutation_keeps_missing_values(spark):
    df = spark.range(50).withColumn("x", F.when(F.col("id") % 3 > 0, F.col("id")))
    assert permute(df, ["x"], "id").filter("perm_x is null").count() == df.filter("x is null").count()


def test_permutation_is_one_shift_over_all_segments(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("k"), F.col("id").alias("x"))
    got = permute(df.repartition(7), ["x"], "k").collect()
    following = {r.x: r.perm_x for r in got}
    seen, at = set(), 0
    while at not in seen:
        seen.add(at)
        at = following[at]
    assert len(seen) == 500  # one cycle through all rows
    assert sorted(got) == sorted(permute(df.repartition(1), ["x"], "k").collect())


def test_noise_is_uniform(spark):
    row = add_noise(spark.range(5000), "id").agg(F.avg("noise_feature"), F.min("noise_feature"), F.max("noise_feature")).first()
    assert 0.48 < row[0] < 0.52 and row[1] >= 0 and row[2] < 1


@pytest.fixture(scope="module")
def importances(spark):
    rows = [(0, "a", 5.0), (0, "b", 1.0), (0, "n", 1.0), (1, "a", 3.0), (1, "b", 2.0), (1, "n", 1.5), (2, "a", 1.0), (2, "n", 4.0)]
    return spark.createDataFrame(rows, "fold_id int, feature_name string, importance double")


def test_votes_are_strict_and_divided_by_configured_folds(importances):
    flags = above_noise(importances, "n")
    assert {(r.fold_id, r.feature_name): r.is_above_noise for r in flags.collect()} == {
        (0, "a"): 1, (0, "b"): 0, (1, "a"): 1, (1, "b"): 1, (2, "a"): 0,
    }
    assert {r.feature_name: r.ratio for r in vote(flags, "is_above_noise", 4, 0.5).collect()} == {"a": 0.5}
    assert {r.feature_name for r in vote(flags, "is_above_noise", 4, 0.25).collect()} == {"a", "b"}
    strict = above_threshold(importances, 1.0, "importance")
    assert strict.filter("feature_name = 'b' and fold_id = 0").first().is_above_threshold == 0


def test_ranking(importances):
    assert [r.feature_name for r in importance_rank(importances).collect()] == ["a", "n", "b"]
    assert top_feature(importances).first().feature_name == "a"
    assert mean_metric(importances.withColumn("m", F.col("fold_id") + 1.0), "m").first().m == 2.0


def test_contribution(spark):
    df = spark.createDataFrame([(0.0, 1), (2.0, 1), (4.0, 4)], "x double, z int")
    got = {r.feature_name: r.importance for r in mean_contribution(df, {"x": -3.0, "z": 0.5}).collect()}
    assert got == pytest.approx({"x": 4.0, "z": 0.5 * 4 / 3})


def rule(**settings):
    return ForwardRule(ForwardSettings(cv_folds_selection=3, **settings), Task.of("binary_classification"))


def test_forward_rule_needs_votes_and_gain():
    r = rule(q=2, eps=0.01, tol=2)
    assert r.offer({0: 0.6, 1: 0.6, 2: 0.6})[2]
    assert r.offer({0: 0.61, 1: 0.605, 2: 0.6}) == (pytest.approx(0.605), 2, False)
    assert r.offer({0: 0.9, 1: 0.6, 2: 0.6}) == (pytest.approx(0.7), 1, False)
    assert r.finished
    assert r.offer({0: 0.7, 1: 0.7, 2: 0.5})[2] and not r.finished


def test_forward_rule_by_votes_only_still_guards_the_mean():
    r = rule(q=1, eps=0.01, votes_only=True)
    assert r.offer({0: 0.6, 1: 0.6, 2: 0.6})[2]
    assert r.offer({0: 0.61, 1: 0.59, 2: 0.59})[2]
    assert not r.offer({0: 0.9, 1: 0.4, 2: 0.3})[2]


def test_forward_rule_for_regression_starts_below_any_score():
    r = ForwardRule(ForwardSettings(cv_folds_selection=2, q=1), Task.of("regression"))
    assert r.offer({0: -5.0, 1: -7.0})[2]
    assert not r.offer({0: -5.0, 1: -8.0})[2]


def test_tasks():
    assert Task.of("regression").metric == "rmse" and Task.of("binary_classification").higher_is_better
    with pytest.raises(ValueError):
        Task.of("ranking")


@pytest.mark.parametrize("step", [1, 2, 5])
def test_correlation_does_not_depend_on_blocks(spark, monkeypatch, step):
    columns = [f"c{i}" for i in range(6)]
    mixed = [F.sin(F.col("id") * (i + 1)) + (F.sin(F.col("id")) if i % 2 else F.lit(1e6)) for i in range(5)]
    df = spark.range(0, 400, 1, 5).select(*[m.alias(c) for m, c in zip(mixed, columns)], F.lit(3.0).alias("c5"))
    want = {(a, b): df.stat.corr(a, b) for i, a in enumerate(columns[:5]) for b in columns[i + 1 : 5]}
    monkeypatch.setattr(correlated_module, "BLOCK_BYTES", 8 * 5 * step)
    rows = pearson_pairs(df, columns).collect()
    assert len(rows) == 15 and {r.r for r in rows if r.f2 == "c5"} == {None}
    assert {(r.f1, r.f2): r.r for r in rows if r.f2 != "c5"} == pytest.approx(want, abs=1e-9)


def test_correlation_of_missing_values_and_no_rows(spark):
    df = spark.range(5).select(F.col("id").alias("a"), F.nullif("id", F.lit(3)).alias("b"), (-F.col("id")).alias("c"))
    assert {(r.f1, r.f2): r.r for r in pearson_pairs(df, ["a", "b", "c"]).collect()} == {
        ("a", "b"): None, ("a", "c"): pytest.approx(-1.0), ("b", "c"): None,
    }
    assert [r.r for r in pearson_pairs(df.limit(0), ["a", "b"]).collect()] == [None]
