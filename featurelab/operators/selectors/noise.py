"""Keep features that beat a random column in enough folds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from featurelab.operators.folds import check_folds
from featurelab.operators.models import Task, TreeParams, fold_frame, importance_by_fold
from featurelab.operators.permute import NOISE
from featurelab.operators.selectors.base import SelectorResult, keep_only, require
from featurelab.operators.splits import Roles, Splits
from featurelab.operators.votes import above_noise, vote


@dataclass(frozen=True)
class NoiseSettings:
    cv_folds: int = 5
    selection_rate: float = 0.7
    learning_rate: float = 0.05
    sample_size: int | None = None
    num_boost_round: int = 100
    early_stopping_rounds: int = 10
    seed: int = 42
    importance_type: str = "gain"
    max_depth: int = 5
    max_bins: int = 64
    row_fraction: float = 0.8
    feature_fraction: float = 0.6


def select_noise(
    splits: Splits,
    roles: Roles,
    features: Sequence[str],
    settings: NoiseSettings,
    task: str,
    keys: Sequence[str],
) -> SelectorResult:
    features = require(features)
    frame = fold_frame(
        splits.train, features, roles.target, keys, settings.cv_folds, 0.3, roles.categorical,
        settings.sample_size, settings.seed, noise=True,
    )
    check_folds(frame.df, frame.folds)
    params = TreeParams().with_settings(vars(settings))
    table, _ = importance_by_fold(frame, frame.features, Task.of(task), params, settings.importance_type)
    flags = above_noise(table, NOISE)
    kept = {r.feature_name for r in vote(flags, "is_above_noise", frame.folds, settings.selection_rate).collect()}
    return SelectorResult(keep_only(features, kept), {"importances": flags}, tuple(c for c in features if c in kept))
