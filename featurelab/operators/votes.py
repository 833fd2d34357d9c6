"""Importance tables (one row per fold and feature) and decisions taken from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.operators.folds import FOLD


def mean_importance(table: DataFrame, importance: str = "importance") -> DataFrame:
    return table.groupBy("feature_name").agg(F.avg(importance).alias(importance))


def importance_rank(table: DataFrame, importance: str = "importance") -> DataFrame:
    """Mean importance, highest first, names breaking ties."""
    return mean_importance(table, importance).orderBy(F.desc(importance), "feature_name")


def top_feature(table: DataFrame, importance: str = "importance") -> DataFrame:
    return importance_rank(table, importance).limit(1)


def mean_metric(table: DataFrame, metric: str) -> DataFrame:
    """Mean over folds of a value that is the same in all rows of a fold."""
    per_fold = table.groupBy(FOLD).agg(F.max(metric).alias(metric))
    return per_fold.agg(F.avg(metric).alias(metric))


def above_noise(table: DataFrame, noise: str, importance: str = "importance") -> DataFrame:
    """Flag features that are strictly more important than the noise column in their fold."""
    noise_value = F.max(F.when(F.col("feature_name") == noise, F.col(importance)))
    per_fold = table.groupBy(FOLD).agg(F.coalesce(noise_value, F.lit(0.0)).alias("noise_importance"))
    return (
        table.filter(F.col("feature_name") != noise)
        .join(per_fold, FOLD)
        .withColumn("is_above_noise", (F.col(importance) > F.col("noise_importance")).cast("int"))
    )


def above_threshold(table: DataFrame, threshold: float, importance: str) -> DataFrame:
    return table.withColumn("is_above_threshold", (F.col(importance) > threshold).cast("int"))


def vote(table: DataFrame, flag: str, folds: int, rate: float) -> DataFrame:
    """Features flagged in at least `rate` of the configured folds.

    The divisor is the configured number, so a missing fold counts as a vote against.
    """
    votes = table.groupBy("feature_name").agg(F.sum(flag).alias("votes"))
    return votes.withColumn("ratio", F.col("votes") / F.lit(float(folds))).filter(F.col("ratio") >= rate)
