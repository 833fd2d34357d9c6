"""Tree ensembles as tables: prefixes, patience, exchanged values, contributions."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.sql import functions as F

from featurelab.operators.folds import FOLD, IS_TRAIN
from featurelab.operators.forest import exchanged_scores, path_contributions, running_margins
from featurelab.operators.models import (
    BINARY,
    LABEL,
    SCORE,
    Task,
    TreeParams,
    best_prefix,
    cut_model,
    fit_folds,
    fold_frame,
    linear_importance,
    load_forests,
    score,
    tree_importance,
    values_of,
    vector_inputs,
)
from featurelab.sources import scratch

FEATURES = ["x", "z", "kind"]
PARAMS = TreeParams(rounds=6, learning_rate=0.4, max_depth=3, feature_fraction=1.0, early_stopping_rounds=0)


@pytest.fixture(scope="module")
def frame(spark):
    def noise(salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1000)) / 1000

    kind = F.pmod(F.xxhash64("id", F.lit("k")), F.lit(6)).cast("int") - 1
    df = spark.range(1500).withColumns({"x": F.round(noise("a"), 2), "z": noise("b"), "kind": kind})
    signal = F.col("x") + F.col("kind").isin(1, 3).cast("int") * 0.3 + 0.4 * noise("c")
    df = df.withColumns({"y": (signal > 0.85).cast("int"), "amount": signal})
    return fold_frame(df, FEATURES, "y", "id", 2, categorical=["kind"])


@pytest.fixture(scope="module")
def models(frame):
    return fit_folds(frame, FEATURES, BINARY, PARAMS)


@pytest.fixture(scope="module")
def forests(frame, models):
    return load_forests(frame, models)


@pytest.fixture(scope="module")
def held_out(frame):
    return frame.df.filter(F.col(IS_TRAIN) == 0)


@pytest.mark.parametrize(
    "errors, patience, want",
    [
        ([3.0], 2, (1, False)),
        ([3.0, 2.0, 2.5, 1.0], 2, (4, False)),  # a round that brings nothing ends no search
        ([3.0, 2.0, 2.5, 2.4, 1.0], 2, (2, True)),
        ([3.0, 2.0, 2.0, 2.0], 2, (2, True)),  # of equal errors the first counts
        ([1.0, 2.0], 1, (1, True)),
    ],
)
def test_patience(errors, patience, want):
    assert best_prefix(errors, patience) == want


def test_margins_of_all_prefixes(frame, models, forests, held_out):
    """The last prefix is MLlib's score; a cut model scores as its prefix does."""
    rows = running_margins(held_out, forests, values_of(frame, FEATURES), LABEL).collect()
    assert len(rows) == held_out.count() and {len(r.margins) for r in rows} == {6}
    for rounds in (1, 4, 6):
        cut = {k: cut_model(m, rounds) for k, m in models.items()}
        assert [m.getNumTrees for m in cut.values()] == [rounds] * 2
        scored = score(held_out, cut, BINARY, vector_inputs(frame, FEATURES, 64)).select(FOLD, SCORE).collect()
        got = sorted((r.fold_id, r.margins[rounds - 1]) for r in rows)
        assert np.allclose(got, sorted((r[FOLD], r[SCORE]) for r in scored), atol=1e-12)
        assert tree_importance(frame.df, cut, FEATURES, "gain").count() == 6


def test_the_best_prefix_is_kept(frame, models, held_out):
    params = TreeParams(**{**vars(PARAMS), "early_stopping_rounds": 1, "rounds": 40})
    chosen = fit_folds(frame, FEATURES, BINARY, params)
    long = fit_folds(frame, FEATURES, BINARY, TreeParams(**{**vars(PARAMS), "rounds": 40}))
    forests = load_forests(frame, long)
    rows = running_margins(held_out, forests, values_of(frame, FEATURES), LABEL).collect()
    for fold, model in chosen.items():
        own = [r for r in rows if r.fold_id == fold]
        errors = [
            sum(2 * math.log1p(math.exp(-2 * (2 * r.label - 1) * r.margins[k])) for r in own) / len(own) for k in range(40)
        ]
        assert model.getNumTrees == best_prefix(errors, 1)[0] < 40
        # the fits that were repeated with more rounds began with the same trees
        trees = [m.toDebugString.split("\n  Tree ")[1 : model.getNumTrees + 1] for m in (model, long[fold])]
        assert [t.strip() for t in trees[0]] == [t.strip() for t in trees[1]]


@pytest.mark.parametrize("task", [BINARY, Task.of("regression")])
def test_exchanged_values_score_as_copied_rows(spark, frame, task):
    models = fit_folds(frame, FEATURES, task, PARAMS)
    held_out = frame.df.filter(F.col(IS_TRAIN) == 0)
    names = {f"_p{r}_{c}": c for r in (0, 1) for c in FEATURES}
    other = held_out.withColumns(
        {n: F.when(F.col("_key0") % 3 > 0, F.col(c) if c == "kind" else F.lit(0.3)).otherwise(F.lit(1.0)) for n, c in names.items()}
    )
    exchanged = [values_of(frame, FEATURES, f"_p{r}_") for r in (0, 1)]
    got = exchanged_scores(other, load_forests(frame, models), values_of(frame, FEATURES), exchanged, LABEL)
    plan = got._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Expand" not in plan and "Union" not in plan  # each row goes through once
    rows = got.collect()
    assert {r.feature for r in rows} <= {-1, 0, 1, 2} and {r.repeat for r in rows} == {0, 1}
    for feature in {r.feature for r in rows}:
        swapped = other if feature < 0 else other.withColumn(FEATURES[feature], F.col(f"_p0_{FEATURES[feature]}"))
        scored = score(swapped.select(*held_out.columns), models, task, vector_inputs(frame, FEATURES, 64))
        want = sorted((r[FOLD], r[LABEL], r[SCORE]) for r in scored.collect())
        mine = sorted(
            (r.fold_id, r.label, r.score) for r in rows if (r.feature, r.repeat) == (feature, 0) for _ in range(r.rows)
        )
        assert np.allclose(mine, want, atol=1e-12)


def test_contributions_add_up(frame, forests, held_out):
    table = path_contributions(held_out, forests, values_of(frame, FEATURES), FEATURES).collect()
    assert len(table) == 6 and all(r.importance >= 0 for r in table)
    rows = held_out.select(FOLD, *[v.alias(c) for v, c in zip(values_of(frame, FEATURES), FEATURES)]).toPandas()
    for fold, forest in forests.items():
        x = rows[rows[FOLD] == fold][FEATURES].to_numpy(float)
        leaves, credit = forest.leaves(x), forest.paths(3)
        own = (credit[leaves] * forest.weights[None, :, None]).sum(axis=1)
        base = (forest.value[forest.roots] * forest.weights).sum()
        assert np.allclose(own.sum(axis=1) + base, forest.margins(x).sum(axis=1))
        want = dict(zip(FEATURES, np.abs(own).mean(axis=0)))
        assert all(math.isclose(r.importance, want[r.feature_name], abs_tol=1e-12) for r in table if r.fold_id == fold)
    by_name = {(r.fold_id, r.feature_name): r.importance for r in table}
    assert all(by_name[k, "x"] > by_name[k, "z"] for k in (0, 1))


def test_folds_without_rows(frame, forests, held_out):
    none = held_out.filter("false")
    assert running_margins(none, forests, values_of(frame, FEATURES), LABEL).count() == 0
    table = path_contributions(none, forests, values_of(frame, FEATURES), FEATURES).collect()
    assert all(r.importance == 0.0 for r in table)


@pytest.mark.parametrize("kind", ["trees", "linear"])
def test_fits_take_bounded_partitions(spark, monkeypatch, kind):
    rows = 2000
    monkeypatch.setattr(scratch, "ROWS_PER_PARTITION", 50)
    df = spark.range(rows).select("id", (F.col("id") % 7).alias("x"), (F.col("id") % 3 % 2).alias("y"))
    frame = fold_frame(df, ["x"], "y", "id", 2)
    estimator = GBTClassifier if kind == "trees" else LogisticRegression
    fit, taken = estimator.fit, []

    def watched(self, dataset, params=None):
        taken.append([r["count"] for r in dataset.groupBy(F.spark_partition_id()).count().collect()])
        return fit(self, dataset, params)

    monkeypatch.setattr(estimator, "fit", watched)
    if kind == "trees":
        fit_folds(frame, ["x"], BINARY, TreeParams(**{**vars(PARAMS), "rounds": 1}))
    else:
        linear_importance(frame, ["x"], BINARY)
    assert sum(map(sum, taken)) == frame.df.filter(F.col(IS_TRAIN) == 1).count()
    assert max(map(max, taken)) <= 100
