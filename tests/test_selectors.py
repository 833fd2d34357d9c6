"""Selectors on a table with one strong, one weak, one useless and one duplicated feature."""

from __future__ import annotations

import json
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from featurelab.functions.hashing import uniform
from featurelab.operators import models
from featurelab.operators.models import (
    BINARY,
    Task,
    TreeParams,
    fit_folds,
    fold_frame,
    fold_metrics,
    linear_importance,
    tree_importance,
)
from featurelab.operators.selectors import (
    AdversarialSettings,
    CorrelationSettings,
    ForwardSettings,
    NoiseSettings,
    PermutationSettings,
    drift_auc,
    drop_adversarial,
    drop_correlated,
    select_forward,
    select_noise,
    select_permutation,
)
from featurelab.operators.selectors import forward
from featurelab.operators.selectors.base import settings_from
from featurelab.operators.splits import Splits, classify

FEATURES = ("strong", "copy", "useless", "kind")
QUICK = {"num_boost_round": 4, "max_depth": 2, "cv_folds": 2}


@pytest.fixture(scope="module")
def splits(spark):
    u = {name: uniform("id", name) for name in ("strong", "useless", "flip", "kind")}
    rows = spark.range(3000).select(
        "id",
        u["strong"].alias("strong"),
        (2 * u["strong"] + 0.01 * u["useless"]).alias("copy"),
        u["useless"].alias("useless"),
        F.floor(u["kind"] * 4 + 1).cast("int").alias("kind"),
        F.when(u["flip"] < 0.1, u["strong"] < 0.5).otherwise(u["strong"] > 0.5).cast("int").alias("y"),
        (5 * u["strong"]).alias("amount"),
    )
    train, late = rows.filter("id < 2000"), rows.filter("id >= 2000")
    return Splits(train, late.withColumn("kind", F.col("kind") + 3))


@pytest.fixture(scope="module")
def roles(splits):
    return classify(splits.train.drop("amount").withColumn("kind", F.col("kind").cast("string")), "id", "y")


@pytest.fixture(scope="module")
def frame(splits, roles):
    frame = fold_frame(splits.train, FEATURES, "y", "id", 2, categorical=roles.categorical)
    yield frame


def test_frame(frame):
    assert frame.rows == 2000 and frame.arities == {"kind": 7}
    assert {r.fold_id for r in frame.df.select("fold_id").distinct().collect()} == {0, 1}


def test_sampled_frame(splits):
    frame = fold_frame(splits.train, ["strong"], "y", "id", 2, sample_size=500)
    assert 400 < frame.rows < 600


def test_models_and_importances(frame):
    params = TreeParams(rounds=4, max_depth=2, feature_fraction=1.0)
    models = fit_folds(frame, FEATURES, BINARY, params)
    metrics = fold_metrics(frame, FEATURES, models, BINARY, params.max_bins)
    assert all(0.8 < value <= 1 for value in metrics.values())
    for kind in ("gain", "split"):
        rows = tree_importance(frame.df, models, FEATURES, kind).collect()
        assert len(rows) == 8
        weak = sum(r.importance for r in rows if r.feature_name in ("useless", "kind"))
        strong = sum(r.importance for r in rows if r.feature_name in ("strong", "copy"))
        assert strong > weak
    again = fit_folds(frame, FEATURES, BINARY, params)
    assert fold_metrics(frame, FEATURES, again, BINARY, params.max_bins) == metrics
    with pytest.raises(ValueError):
        tree_importance(frame.df, models, FEATURES, "cover")


def test_linear_importance(frame):
    rows = {(r.fold_id, r.feature_name): r.importance for r in linear_importance(frame, FEATURES, BINARY).collect()}
    assert all(rows[k, "strong"] > rows[k, "useless"] for k in (0, 1))


def test_regression(splits):
    frame = fold_frame(splits.train, ["strong", "useless"], "amount", "id", 2)
    task = Task.of("regression")
    models = fit_folds(frame, ["strong", "useless"], task, TreeParams(rounds=5, learning_rate=0.3, max_depth=3))
    assert all(value < 1.0 for value in fold_metrics(frame, ["strong", "useless"], models, task, 64).values())


def test_noise_selection(splits, roles):
    settings = settings_from(NoiseSettings, {**QUICK, "selection_rate": 1.0, "unknown": 1})
    result = select_noise(splits, roles, FEATURES, settings, "binary_classification", ["id"])
    assert "useless" in result.drop and {"strong", "copy"} & set(result.kept)
    assert set(result.drop) | set(result.kept) == set(FEATURES)
    assert result.reports["importances"].count() == 8


def test_noise_selection_by_contribution(splits, roles):
    settings = NoiseSettings(cv_folds=2, selection_rate=1.0, importance_type="shap")
    result = select_noise(splits, roles, ("strong", "useless"), settings, "binary_classification", ["id"])
    assert "strong" in result.kept


@pytest.mark.parametrize("repeats", [1, 2])
def test_permutation_selection(splits, roles, repeats):
    settings = PermutationSettings(**QUICK, selection_rate=1.0, permutation_repeats=repeats)
    result = select_permutation(
        splits, roles, ("strong", "useless", "kind"), settings, "binary_classification", ["id"]
    )
    assert result.kept == ("strong",) and result.drop == ("useless", "kind")
    rows = result.reports["importances"].collect()
    assert all(r.permutation_importance > 0.2 for r in rows if r.feature_name == "strong")


def test_forward_selection(splits, roles):
    settings = ForwardSettings(
        cv_folds_importances=2, cv_folds_selection=2, num_boost_round_importances=4,
        num_boost_round_selection=4, max_depth=2, q=2, tol=1, eps=0.005,
    )
    result = select_forward(splits, roles, ("useless", "strong", "kind"), settings, "binary_classification", ["id"])
    assert result.kept == ("strong",)
    steps = result.reports["steps"].orderBy("step").collect()
    assert result.reports["importances"].agg(F.min("fold_metric")).first()[0] > 0.8
    assert [(s.feature_name, s.accepted) for s in steps] == [("strong", True), (steps[1].feature_name, False)]


def test_adversarial_removal(spark, splits, roles, tmp_path):
    path = f"{tmp_path}/history"
    settings = AdversarialSettings(**QUICK, target_metric_value=0.6, history_path=path)
    result = drop_adversarial(splits, roles, FEATURES, settings, "binary_classification", ["id"])
    assert result.drop == ("kind",)
    rounds = result.reports["rounds"].orderBy("step").collect()
    assert rounds[0].mean_auc > 0.8 and rounds[1].mean_auc <= 0.6 and rounds[0].mean_trees > 0
    history = result.reports["history"].collect()
    assert [(h.feature, h.metric) for h in history] == [("kind", rounds[1].mean_auc)]
    written = [json.loads(line) for f in Path(path).glob("part-*") for line in f.read_text().splitlines()]
    assert [w["feature"] for w in written] == ["kind"]


def test_adversarial_limits(splits, roles):
    settings = AdversarialSettings(**QUICK, target_metric_value=0.0, max_features_to_remove=1)
    result = drop_adversarial(splits, roles, ("kind", "useless"), settings, "binary_classification", ["id"])
    assert len(result.drop) == 1
    none = AdversarialSettings(**QUICK, max_time=-1)
    assert drop_adversarial(splits, roles, ("kind",), none, "binary_classification", ["id"]).drop == ()
    with pytest.raises(ValueError):
        drop_adversarial(Splits(splits.train), roles, FEATURES, settings, "binary_classification", ["id"])


def test_drift(splits):
    got = {r.feature_name: r.auc for r in drift_auc(splits, ["kind", "useless"]).collect()}
    assert got["kind"] > 0.9 and got["useless"] < 0.55


@pytest.mark.parametrize("use_shap", [True, False])
def test_correlated_removal(splits, roles, use_shap):
    settings = CorrelationSettings(
        0.95, 1500, {"use_shap": use_shap, "n_partitions": 2, "num_boost_round": 4, "max_depth": 2}
    )
    result = drop_correlated(splits, roles, ("strong", "copy", "useless"), settings, "binary_classification", ["id"])
    assert len(result.drop) == 1 and result.drop[0] in ("strong", "copy")
    assert result.reports["importances"].count() == 3


def test_empty_feature_lists(splits, roles):
    with pytest.raises(ValueError):
        select_noise(splits, roles, (), NoiseSettings(), "binary_classification", ["id"])
    assert drop_correlated(splits, roles, (), CorrelationSettings(), "binary_classification", ["id"]).drop == ()


def test_forward_stages_its_rows_once(splits, roles, monkeypatch):
    made = []

    def counted(*args, **kwargs):
        made.append(fold_frame(*args, **kwargs))
        return made[-1]

    monkeypatch.setattr(forward, "fold_frame", counted)
    settings = ForwardSettings(
        cv_folds_importances=2, cv_folds_selection=2, num_boost_round_importances=1, num_boost_round_selection=1, max_depth=1
    )
    select_forward(splits, roles, ["strong", "useless"], settings, "binary_classification", ["id"])
    assert len(made) == 1


def test_fold_metrics_of_counted_scores(splits, roles, monkeypatch):
    frame = fold_frame(splits.train, FEATURES, "y", "id", 2, categorical=roles.categorical)
    params = TreeParams(rounds=4, learning_rate=0.3, max_depth=2, early_stopping_rounds=0)
    fitted = fit_folds(frame, FEATURES, BINARY, params)
    held_out = frame.df.filter(F.col("is_train") == 0)
    scored = models.score(held_out, fitted, BINARY, models.vector_inputs(frame, FEATURES, params.max_bins))
    want = {r.fold_id: r.metric for r in models.evaluate(scored, BINARY, ["fold_id"]).collect()}
    counts = []
    monkeypatch.setattr(models, "evaluate", lambda df, *a, f=models.evaluate: counts.append(df.count()) or f(df, *a))
    assert fold_metrics(frame, FEATURES, fitted, BINARY, params.max_bins) == pytest.approx(want, abs=1e-9)
    assert counts[0] < held_out.count()
    gaps = replace(frame, df=frame.df.withColumn("strong", F.when(F.col("is_train") == 1, F.col("strong"))))
    with pytest.raises(Exception, match="missing values"):
        fold_metrics(gaps, FEATURES, fitted, BINARY, params.max_bins)
