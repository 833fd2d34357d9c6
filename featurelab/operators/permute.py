"""Noise columns and shuffled columns for importance tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from featurelab.functions.hashing import Keys, key_hash, key_list, uniform
from featurelab.functions.ordered import SEGMENT, by_segments
from featurelab.sources.scratch import stage

NOISE = "noise_feature"


def add_noise(df: DataFrame, keys: Keys, name: str = NOISE, salt: str = "noise") -> DataFrame:
    return df.withColumn(name, uniform(keys, salt))


def permute(
    df: DataFrame,
    columns: Sequence[str],
    keys: Keys,
    by: Sequence[str] = (),
    salt: str = "permute",
    prefix: str = "perm_",
) -> DataFrame:
    """Add a shuffled copy of each column; every group keeps exactly its values.

    Rows are put in the order of a hash of their key (then key, then content) and each
    takes its successor's value, the last one of the group the first's. The order is cut
    into range segments, so no task gets a whole group; the last row of a segment takes
    the first value of the next one, from a table of one row per group and segment.
    """
    by, content = list(by), [f.name for f in df.schema if not isinstance(f.dataType, MapType)]
    order = ["_hash", *[f"_order{i}" for i in range(len(key_list(keys)))], "_content"]
    placed = df.withColumns(
        {"_hash": key_hash(keys, salt), "_content": F.xxhash64(*content)}
        | {f"_order{i}": F.col(k) for i, k in enumerate(key_list(keys))}
    )
    cut = stage(by_segments(placed, by, order), "permute")
    values = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])
    heads = cut.groupBy(*by, SEGMENT).agg(F.min_by(values, F.struct(*order)).alias("_head"))
    along = Window.partitionBy(*by).orderBy(SEGMENT)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("_head").over(along), F.first("_head").over(whole))
    heads = heads.select(
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)],
        F.col(SEGMENT).alias("_segment_of"),
        following.alias("_next"),
    )
    same = F.col(SEGMENT) == F.col("_segment_of")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    inside = Window.partitionBy(*by, SEGMENT).orderBy(*order)
    ahead = cut.withColumn("_after", F.lead(values).over(inside)).join(heads, same, "left")
    taken = F.coalesce("_after", "_next")
    shifted = {f"{prefix}{c}": taken[f"v{i}"] for i, c in enumerate(columns)}
    return ahead.withColumns(shifted).select(*df.columns, *shifted)
