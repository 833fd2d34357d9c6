"""Exact ROC-AUC and RMSE as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelab.functions.ordered import SEGMENT, by_segments


def roc_auc(
    df: DataFrame, label: str | Column, score: str | Column, by: Sequence[str] = (), times: str | None = None
) -> DataFrame:
    """Area under the ROC curve per group; NULL where a class is missing.

    `times` names a column that tells how many rows a row stands for.

    Counts of both classes per distinct score, then the share of (positive,
    negative) pairs in the right order, ties counting one half. Pairs inside one
    segment of the score range come from a window; pairs across segments need the
    segments' totals only.
    """
    by = list(by)
    label = F.col(label) if isinstance(label, str) else label
    score = F.col(score) if isinstance(score, str) else score
    count = F.col(times) if times else F.lit(1)
    rows = df.select(*by, label.cast("int").alias("_y"), score.cast("double").alias("_s"), count.alias("_n"))

    def of(y: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_y") == y, F.col("_n"))), F.lit(0).cast("bigint"))

    points = (
        rows.filter(F.col("_y").isNotNull() & F.col("_s").isNotNull())
        .groupBy(*by, (F.col("_s") + F.lit(0.0)).alias("_s"))
        .agg(of(1).alias("_pos"), of(0).alias("_neg"))
    )
    lower = Window.partitionBy(*by, SEGMENT).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*by).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    neg_below = F.coalesce(F.sum("_neg").over(lower), F.lit(0))
    pairs = F.col("_pos").cast("double") * (F.col("_below") + F.col("_neg") / 2.0)
    segments = (
        by_segments(points, by, ["_s"])
        .withColumn("_below", neg_below)
        .groupBy(*by, SEGMENT)
        .agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"), F.sum(pairs).alias("_pairs"))
    )
    across = F.coalesce(F.sum("_neg").over(earlier), F.lit(0)).cast("double") * F.col("_pos")
    won = segments.withColumn("_pairs", F.col("_pairs") + across)
    return won.groupBy(*by).agg(
        F.sum("_pos").alias("pos_cnt"),
        F.sum("_neg").alias("neg_cnt"),
        F.try_divide(F.sum("_pairs"), F.sum("_pos").cast("double") * F.sum("_neg")).alias("auc"),
    )


def rmse(
    df: DataFrame, label: str | Column, predicted: str | Column, by: Sequence[str] = (), times: str | None = None
) -> DataFrame:
    label = F.col(label) if isinstance(label, str) else label
    predicted = F.col(predicted) if isinstance(predicted, str) else predicted
    error = label.cast("double") - predicted.cast("double")
    if times is None:
        return df.groupBy(*by).agg(F.sqrt(F.avg(error * error)).alias("rmse"))
    judged = F.when(error.isNotNull(), F.col(times))
    return df.groupBy(*by).agg(F.sqrt(F.try_divide(F.sum(error * error * judged), F.sum(judged))).alias("rmse"))
