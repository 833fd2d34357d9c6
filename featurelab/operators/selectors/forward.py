"""Add features one by one, most important first, while they help."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from featurelab.operators.folds import FOLD, check_folds
from featurelab.operators.models import (
    Task,
    TreeParams,
    fit_folds,
    fold_frame,
    fold_metrics,
    importance_by_fold,
)
from featurelab.operators.selectors.base import SelectorResult, keep_only, require
from featurelab.operators.splits import Roles, Splits
from featurelab.operators.votes import importance_rank

STEP_SCHEMA = "step int, feature_name string, mean_score double, better_folds int, accepted boolean"


@dataclass(frozen=True)
class ForwardSettings:
    cv_folds_importances: int = 5
    num_boost_round_importances: int = 100
    early_stopping_rounds_importances: int = 50
    cv_folds_selection: int = 5
    num_boost_round_selection: int = 300
    early_stopping_rounds_selection: int = 100
    seed: int = 0
    importance_type: str = "gain"
    sample_size: int | None = None
    learning_rate: float = 0.05
    selection_learning_rate: float = 0.03
    eps: float = 1e-4
    q: int = 2
    tol: int = 10
    votes_only: bool = False
    valid_frac: float = 0.2
    max_depth: int = 5
    max_bins: int = 64
    row_fraction: float = 0.8  # of the importances' fits
    feature_fraction: float = 0.6
    selection_row_fraction: float = 0.95
    selection_feature_fraction: float = 0.7


class ForwardRule:
    """Acceptance by fold votes and mean score, both against the last accepted set.

    Scores are higher-is-better. Classification starts from 0, regression (negative
    RMSE) from minus infinity; a fold without a score has the start value.
    """

    def __init__(self, settings: ForwardSettings, task: Task) -> None:
        self.settings = settings
        self.start = 0.0 if task.higher_is_better else float("-inf")
        self.best_mean = self.start
        self.best_folds = [self.start] * settings.cv_folds_selection
        self.misses = 0

    def offer(self, scores: Mapping[int, float]) -> tuple[float, int, bool]:
        """(mean, folds that improved, accepted)."""
        s = self.settings
        folds = [scores.get(k, self.start) for k in range(s.cv_folds_selection)]
        mean = sum(folds) / len(folds)
        better = sum(new > old for new, old in zip(folds, self.best_folds))
        enough = mean + s.eps >= self.best_mean if s.votes_only else mean > self.best_mean + s.eps
        accepted = better >= s.q and enough
        if accepted:
            self.best_mean, self.best_folds, self.misses = mean, folds, 0
        else:
            self.misses += 1
        return mean, better, accepted

    @property
    def finished(self) -> bool:
        return self.misses >= self.settings.tol


def select_forward(
    splits: Splits,
    roles: Roles,
    features: Sequence[str],
    settings: ForwardSettings,
    task: str,
    keys: Sequence[str],
) -> SelectorResult:
    features = require(features)
    kind = Task.of(task)

    def frame_of(folds: int):
        return fold_frame(
            splits.train, features, roles.target, keys, folds, settings.valid_frac, roles.categorical,
            settings.sample_size, settings.seed,
        )

    frame = frame_of(settings.cv_folds_importances)
    check_folds(frame.df, frame.folds)
    params = TreeParams(
        rounds=settings.num_boost_round_importances,
        early_stopping_rounds=settings.early_stopping_rounds_importances,
    ).with_settings(vars(settings))
    table, models = importance_by_fold(frame, features, kind, params, settings.importance_type)
    if models:
        base = fold_metrics(frame, features, models, kind, params.max_bins)
        metrics = frame.df.sparkSession.createDataFrame(sorted(base.items()), f"{FOLD} int, fold_metric double")
        table = table.join(metrics, FOLD)
    order = [r.feature_name for r in importance_rank(table).collect()]

    if settings.cv_folds_selection != frame.folds:  # else the rows, folds and flags are the same
        frame = frame_of(settings.cv_folds_selection)
        check_folds(frame.df, frame.folds)
    params = TreeParams(
        rounds=settings.num_boost_round_selection,
        early_stopping_rounds=settings.early_stopping_rounds_selection,
        learning_rate=settings.selection_learning_rate,
        max_depth=settings.max_depth,
        max_bins=settings.max_bins,
        row_fraction=settings.selection_row_fraction,
        feature_fraction=settings.selection_feature_fraction,
        min_rows_per_leaf=1,
        seed=settings.seed,
    )
    rule = ForwardRule(settings, kind)
    chosen: list[str] = []
    steps = []
    for i, candidate in enumerate(order):
        tried = [*chosen, candidate]
        found = fold_metrics(frame, tried, fit_folds(frame, tried, kind, params), kind, params.max_bins)
        scores = found if kind.higher_is_better else {k: -v for k, v in found.items()}
        mean, better, accepted = rule.offer(scores)
        steps.append((i, candidate, float(mean), better, accepted))
        if accepted:
            chosen = tried
        if rule.finished:
            break
    report = splits.train.sparkSession.createDataFrame(steps, STEP_SCHEMA)
    return SelectorResult(keep_only(features, chosen), {"importances": table, "steps": report}, tuple(chosen))
