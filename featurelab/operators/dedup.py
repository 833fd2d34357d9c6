"""One row per key. Train beats validation, then the lowest row key wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelab.functions.hashing import Keys, key_list
from featurelab.operators.splits import Splits
from featurelab.sources.scratch import stage

TAG = "is_train_"


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _first_rows(df: DataFrame, subset: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per subset value.

    A `min` over whole rows rather than a window: partial aggregation leaves one
    row per key and task before the shuffle, so a key that holds a third of the
    rows is never gathered in one task.
    """
    rest = [c for c in df.columns if c not in subset]
    if not rest:
        return df.select(*subset).distinct()
    ranked = [c for c in order if c in rest] + [c for c in rest if c not in order]
    order_by = [c for c in ranked if _orderable(df.schema[c].dataType)]
    row = F.struct(*ranked)
    winner: Column = F.min(row) if order_by == ranked else F.min_by(row, F.struct(*order_by))
    return (
        df.groupBy(*subset)
        .agg(winner.alias("_row"))
        .select(*[F.col(c) if c in subset else F.col(f"_row.`{c}`").alias(c) for c in df.columns])
    )


def dedup(df: DataFrame, subset: Sequence[str], keys: Keys) -> DataFrame:
    return _first_rows(df, list(subset), key_list(keys))


def dedup_splits(
    splits: Splits, subset: Sequence[str], keys: Keys, scoring: bool = False, staged: bool = False
) -> Splits:
    """Remove repeats within and across train and validation.

    Scoring is left alone unless asked for, and is then deduplicated by itself.
    `staged` writes the result once for all later reads of train and validation.
    """
    train, valid = splits.train, splits.valid
    if valid is None:
        train = dedup(train, subset, keys)
        train = stage(train, "unique") if staged else train
    else:
        both = tag_and_union(train, valid)
        # descending: train (1) first
        ranked = both.withColumn(TAG, -F.col(TAG))
        unique = _first_rows(ranked, list(subset), [TAG, *key_list(keys)])
        unique = stage(unique, "unique", folder_by=TAG) if staged else unique
        train = unique.filter(F.col(TAG) == -1).drop(TAG)
        valid = unique.filter(F.col(TAG) == 0).drop(TAG)
    scored = splits.scoring
    if scoring and scored is not None:
        scored = dedup(scored, subset, keys)
    return Splits(train, valid, scored)


def tag_and_union(train: DataFrame, valid: DataFrame, tag: str = TAG) -> DataFrame:
    """Both tables by column name, train marked 1 and validation 0."""
    return train.withColumn(tag, F.lit(1)).unionByName(valid.withColumn(tag, F.lit(0)))
