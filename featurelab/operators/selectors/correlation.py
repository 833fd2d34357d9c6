"""Drop the weaker one of every two strongly correlated features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import functions as F

from featurelab.operators.correlated import correlated, pearson_pairs
from featurelab.operators.models import (
    Task,
    TreeParams,
    contribution_importance,
    fit_folds,
    fold_frame,
    linear_importance,
    tree_importance,
)
from featurelab.operators.sampling import take_exact
from featurelab.operators.selectors.base import SelectorResult
from featurelab.operators.splits import Roles, Splits
from featurelab.operators.votes import mean_importance


@dataclass(frozen=True)
class CorrelationSettings:
    threshold: float = 0.95
    sample_size: int | None = None
    importances: Mapping = field(default_factory=dict)


def feature_scores(splits: Splits, roles: Roles, features, settings: CorrelationSettings, task, keys):
    """(feature_name, score): mean importance over folds that are each fitted on all their rows."""
    section = dict(settings.importances)
    folds = section.get("n_partitions", 8)
    frame = fold_frame(
        splits.train, features, roles.target, keys, folds, valid_frac=0.0,
        sample_size=section.get("sample_size"), seed=1,
    )
    kind = Task.of(task)
    if section.get("use_linear", False):
        table = linear_importance(frame, features, kind, every_row=True)
    else:
        params = TreeParams(rounds=200, row_fraction=0.8, seed=1).with_settings(section)
        models = fit_folds(frame, features, kind, replace(params, early_stopping_rounds=0))  # no row is held out
        if section.get("use_shap", False):
            table = contribution_importance(frame, features, models, every_row=True)
        else:
            table = tree_importance(frame.df, models, features, "gain")
    return mean_importance(table).withColumnRenamed("importance", "score")


def drop_correlated(
    splits: Splits,
    roles: Roles,
    features: Sequence[str],
    settings: CorrelationSettings,
    task: str,
    keys: Sequence[str],
) -> SelectorResult:
    """Numeric features only; pairs from an exact-size sample if one is configured."""
    features = tuple(features)
    if not features:
        return SelectorResult(())
    scores = feature_scores(splits, roles, features, settings, task, keys)
    rows = splits.train.select(*dict.fromkeys([*keys, *features]))
    if settings.sample_size:
        rows = take_exact(rows, keys, settings.sample_size, "corr-sample")
    pairs = pearson_pairs(rows, features)
    losers = {r.feature_name for r in correlated(pairs, scores, settings.threshold).collect()}
    report = scores.orderBy(F.desc("score"), "feature_name")
    return SelectorResult(tuple(c for c in features if c in losers), {"importances": report})
