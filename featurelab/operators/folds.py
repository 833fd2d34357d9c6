"""Cross-validation folds and the train / validation flag inside each fold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.functions.hashing import Keys, fold_of, in_fraction

FOLD, IS_TRAIN = "fold_id", "is_train"


def kfold(df: DataFrame, keys: Keys, folds: int, salt: str = "fold") -> DataFrame:
    return df.withColumn(FOLD, fold_of(keys, folds, salt))


def train_flag(df: DataFrame, keys: Keys, valid_frac: float, salt: str = "split") -> DataFrame:
    return df.withColumn(IS_TRAIN, (~in_fraction(keys, valid_frac, salt)).cast("int"))


def fold_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy(FOLD).agg(
        F.count("*").alias("total_cnt"),
        F.sum(IS_TRAIN).alias("train_cnt"),
        F.sum(1 - F.col(IS_TRAIN)).alias("valid_cnt"),
    )


def check_folds(df: DataFrame, folds: int, min_share: float = 0.0) -> None:
    """Raise if a fold has no training or validation rows, or less than `min_share` of either."""
    rows = fold_sizes(df).collect()  # one row per fold
    if not rows:
        raise ValueError("no rows to train on")
    for row in sorted(rows, key=lambda r: r[FOLD]):
        least = min(row.train_cnt, row.valid_cnt)
        if least == 0 or least < min_share * row.total_cnt:
            raise ValueError(
                f"fold {row[FOLD]} of {folds} has {row.train_cnt} training and {row.valid_cnt} "
                f"validation rows out of {row.total_cnt}"
            )
