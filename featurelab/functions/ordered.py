"""Running totals over a global order, without sorting a whole group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelab.sources.scratch import stage

SEGMENT = "_segment"


def by_segments(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Cut the sorted order of each group into consecutive segments.

    Range partitioning samples the data to find balanced borders; equal values
    stay together. The segment number grows with the order.
    """
    return df.repartitionByRange(*by, *order).withColumn(SEGMENT, F.spark_partition_id())


def running_totals(
    df: DataFrame, by: Sequence[str], order: Sequence[str], totals: Mapping[str, Column]
) -> DataFrame:
    """Add, for each name, the sum of its expression over all earlier rows of the group.

    Rows must be distinct in (by, order); aggregate first. Segments are summed
    apart, and the segment sums (one row per group and segment) give the offsets.
    """
    by, names = list(by), list(totals)
    # staged: both uses below must see the same segment borders
    cut = stage(by_segments(df.withColumns(dict(totals)), by, order), "ordered")
    inside = Window.partitionBy(*by, SEGMENT).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*by).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(*by, SEGMENT).agg(*[F.sum(n).alias(n) for n in names])
    zero = F.lit(0)
    offsets = sums.select(
        *by, SEGMENT, *[F.coalesce(F.sum(n).over(before), zero).alias(f"_off_{n}") for n in names]
    )
    local = cut.withColumns({n: F.coalesce(F.sum(n).over(inside), zero) for n in names})
    joined = local.join(offsets, [*by, SEGMENT])
    return joined.withColumns({n: F.col(n) + F.col(f"_off_{n}") for n in names}).drop(
        SEGMENT, *[f"_off_{n}" for n in names]
    )
