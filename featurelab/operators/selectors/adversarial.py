"""Drop features that let a model tell validation rows from training rows."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.functions.metrics import roc_auc
from featurelab.operators.clean import unpivot_numbers
from featurelab.operators.folds import check_folds
from featurelab.operators.models import (
    BINARY,
    TreeParams,
    fit_folds,
    fold_frame,
    fold_metrics,
    linear_importance,
    model_importance,
)
from featurelab.operators.selectors.base import SelectorResult, require
from featurelab.operators.splits import Roles, Splits
from featurelab.operators.votes import top_feature
from featurelab.sources.sinks import write_report

TAG = "adv_target"
HISTORY_SCHEMA = "step int, feature string, delta double, metric double"
ROUND_SCHEMA = "step int, mean_auc double, mean_trees double, removed string"


@dataclass(frozen=True)
class AdversarialSettings:
    sample_size: int | None = None
    target_metric_value: float = 0.75
    cv_folds: int = 5
    learning_rate: float = 0.05
    max_features_to_remove: int = 50
    max_time: float = 3600
    num_boost_round: int = 100
    early_stopping_rounds: int = 25
    importance_type: str = "gain"
    max_depth: int = 5
    max_bins: int = 64
    row_fraction: float = 0.9
    feature_fraction: float = 0.9
    seed: int = 42
    history_path: str | None = None  # rewritten after every round


def tagged(splits: Splits, columns: Sequence[str]) -> DataFrame:
    """Train (0) and validation (1) rows by column name."""
    if splits.valid is None:
        raise ValueError("adversarial selection needs a validation table")
    names = list(dict.fromkeys(columns))
    train = splits.train.select(*names, F.lit(0).alias(TAG))
    return train.unionByName(splits.valid.select(*names, F.lit(1).alias(TAG)))


def drift_auc(splits: Splits, features: Sequence[str]) -> DataFrame:
    """(feature_name, auc): how well each raw feature alone separates the two tables, 0.5 to 1."""
    both = unpivot_numbers(tagged(splits, features), list(features))
    table = roc_auc(both, TAG, "feature_value", ["feature_name"])
    return table.select("feature_name", F.greatest("auc", 1 - F.col("auc")).alias("auc"))


def drop_adversarial(
    splits: Splits,
    roles: Roles,
    features: Sequence[str],
    settings: AdversarialSettings,
    task: str,
    keys: Sequence[str],
) -> SelectorResult:
    """Fit, and while the mean fold AUC exceeds the goal drop the most important feature.

    Ends when the goal is met, the limit of removals or of time is reached, or no
    feature is left. The frame is staged once; no lineage grows in the loop.
    """
    left = list(require(features))
    both = tagged(splits, [*keys, *left])
    spark = splits.train.sparkSession
    frame = fold_frame(
        both, left, TAG, keys, settings.cv_folds, 0.5, roles.categorical, settings.sample_size, settings.seed
    )
    params = TreeParams(min_rows_per_leaf=20).with_settings(vars(settings))
    removed: list[str] = []
    rounds: list[tuple[int, float, float, str | None]] = []
    started = time.monotonic()
    check_folds(frame.df, frame.folds, min_share=0.2)
    while left and time.monotonic() - started <= settings.max_time:
        models = fit_folds(frame, left, BINARY, params)
        found = fold_metrics(frame, left, models, BINARY, params.max_bins)
        auc = sum(found.values()) / len(found)
        trees = sum(model.getNumTrees for model in models.values()) / len(models)
        done = auc <= settings.target_metric_value or len(removed) >= settings.max_features_to_remove
        worst = None
        if not done:
            if settings.importance_type == "linear":
                table = linear_importance(frame, left, BINARY)
            else:
                table = model_importance(frame, left, models, settings.importance_type)
            worst = top_feature(table).first().feature_name
        rounds.append((len(rounds), auc, trees, worst))
        if settings.history_path:
            write_report(removal_history(spark, rounds), settings.history_path, "json")
        if done:
            break
        left.remove(worst)
        removed.append(worst)
    reports = {"history": removal_history(spark, rounds), "rounds": spark.createDataFrame(rounds, ROUND_SCHEMA)}
    return SelectorResult(tuple(removed), reports)


def removal_history(spark: SparkSession, rounds: Sequence[tuple]) -> DataFrame:
    """Each removed feature with the metric after its removal and the drop it brought.

    Both are unknown (NULL) for a removal that no round has judged yet.
    """
    metrics = [auc for _, auc, _, _ in rounds] + [None]
    rows = [
        (i, worst, None if metrics[i + 1] is None else metrics[i] - metrics[i + 1], metrics[i + 1])
        for i, _, _, worst in rounds
        if worst is not None
    ]
    return spark.createDataFrame(rows, HISTORY_SCHEMA)
