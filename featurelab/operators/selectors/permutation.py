"""Keep features whose shuffling costs the model enough, in enough folds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.functions.metrics import rmse, roc_auc
from featurelab.operators.folds import FOLD, IS_TRAIN, check_folds
from featurelab.operators.forest import exchanged_scores
from featurelab.operators.models import (
    LABEL,
    FoldFrame,
    Task,
    TreeParams,
    fit_folds,
    fold_frame,
    load_forests,
    values_of,
)
from featurelab.operators.permute import permute
from featurelab.operators.selectors.base import SelectorResult, keep_only, require
from featurelab.operators.splits import Roles, Splits
from featurelab.operators.votes import above_threshold, vote
from featurelab.sources.scratch import stage


@dataclass(frozen=True)
class PermutationSettings:
    cv_folds: int = 5
    selection_rate: float = 0.7
    min_importance_threshold: float = 0.001
    learning_rate: float = 0.05
    sample_size: int | None = None
    num_boost_round: int = 100
    early_stopping_rounds: int = 10
    seed: int = 42
    valid_frac: float = 0.3
    permutation_repeats: int = 1
    max_depth: int = 5
    max_bins: int = 64
    row_fraction: float = 0.8
    feature_fraction: float = 0.6


def with_shuffled(frame: FoldFrame, features: Sequence[str], repeats: int, seed: int) -> DataFrame:
    """The validation rows, each with a value of every feature shuffled inside its fold, for each repeat.

    One pass per repeat shuffles all features.
    """
    held_out = frame.df.filter(F.col(IS_TRAIN) == 0)
    for repeat in range(repeats):
        held_out = permute(
            held_out, features, frame.keys, [FOLD], f"permute{seed}:{repeat}", f"_p{repeat}_"
        )
    return held_out


def permutation_importance(
    frame: FoldFrame, features: Sequence[str], models, task: Task, repeats: int, seed: int
) -> DataFrame:
    """(fold_id, feature_name, permutation_importance): metric lost, averaged over repeats.

    A feature that a fold's trees do not use costs nothing when it is shuffled.
    """
    scored = exchanged_scores(
        with_shuffled(frame, features, repeats, seed),
        load_forests(frame, models),
        values_of(frame, features),
        [values_of(frame, features, f"_p{repeat}_") for repeat in range(repeats)],
        LABEL,
    )
    groups = [FOLD, "feature", "repeat"]
    if task.is_classification:
        metrics = roc_auc(scored, "label", "score", groups, "rows").select(*groups, F.col("auc").alias("metric"))
    else:
        metrics = rmse(scored, "label", "score", groups, "rows").select(*groups, F.col("rmse").alias("metric"))
    # a handful of rows: folds x (features x repeats + 1)
    metrics = stage(metrics, "metrics")
    base = metrics.filter(F.col("feature") < 0).select(FOLD, F.col("metric").alias("baseline"))
    loss = F.col("baseline") - F.col("metric")
    lost = (
        metrics.filter(F.col("feature") >= 0)
        .join(base, FOLD)
        .groupBy(FOLD, "feature")
        .agg(F.avg(loss if task.higher_is_better else -loss).alias("lost"))
    )
    every = base.select(FOLD, "baseline", F.posexplode(F.array(*map(F.lit, features))).alias("feature", "feature_name"))
    known = F.when(F.col("baseline").isNotNull(), F.coalesce("lost", F.lit(0.0)))
    return every.join(lost, [FOLD, "feature"], "left").select(
        FOLD, "feature_name", known.alias("permutation_importance")
    )


def select_permutation(
    splits: Splits,
    roles: Roles,
    features: Sequence[str],
    settings: PermutationSettings,
    task: str,
    keys: Sequence[str],
) -> SelectorResult:
    features = require(features)
    kind = Task.of(task)
    frame = fold_frame(
        splits.train, features, roles.target, keys, settings.cv_folds, settings.valid_frac,
        roles.categorical, settings.sample_size, settings.seed,
    )
    check_folds(frame.df, frame.folds)
    params = TreeParams().with_settings(vars(settings))
    models = fit_folds(frame, features, kind, params)
    found = permutation_importance(
        frame, features, models, kind, settings.permutation_repeats, settings.seed
    )
    # bounded by folds x features; collected so that voting does not score again
    rows = found.collect()
    if any(r.permutation_importance is None for r in rows):
        raise ValueError("a fold's validation rows hold one class only")
    table = frame.df.sparkSession.createDataFrame(rows, found.schema)
    flags = above_threshold(table, settings.min_importance_threshold, "permutation_importance")
    chosen = vote(flags, "is_above_threshold", settings.cv_folds, settings.selection_rate)
    kept = {r.feature_name for r in chosen.collect()}
    return SelectorResult(keep_only(features, kept), {"importances": flags}, tuple(c for c in features if c in kept))
