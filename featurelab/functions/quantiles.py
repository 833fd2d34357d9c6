"""Many quantiles of many columns at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelab.functions.ordered import running_totals

APPROX_ACCURACY = 100_000


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = F.lit(None).cast("double")
    return df.select(*[(F.nanvl(F.col(c).cast("double"), missing) + F.lit(0.0)).alias(c) for c in columns])


def _brackets(df: DataFrame, columns: Sequence[str], points: int) -> tuple[dict, dict]:
    """Sizes of the columns, and for each the value ranges that hold the wanted ranks.

    A sketch knows the value of a rank up to 1 / APPROX_ACCURACY of the rows; the ranges
    reach twice as far to either side. Ranges that touch are merged.
    """
    sizes = df.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    sizes = {c: n for c, n in sizes.items() if n}
    sketches = []
    for c, n in sizes.items():
        steps = max(min(points, n) - 1, 1)
        slack = 2 / APPROX_ACCURACY + 2 / n  # the neighbours' ranks are wanted too
        shares = [k / steps for k in range(min(points, n))]
        borders = [max(0.0, p - slack) for p in shares] + [min(1.0, p + slack) for p in shares]
        sketches.append(F.percentile_approx(c, borders, APPROX_ACCURACY).alias(c))
    row = df.agg(*sketches).first() if sketches else {}
    ranges = {}
    for c in sizes:
        half, merged = len(row[c]) // 2, []
        for low, high in zip(row[c][:half], row[c][half:]):
            if merged and low <= merged[-1][1]:
                merged[-1][1] = max(high, merged[-1][1])
            else:
                merged.append([low, high])
        ranges[c] = merged
    return sizes, ranges


def _counts(numbers: DataFrame, ranges: dict) -> DataFrame:
    """(feature, slot, value, n): odd slots hold the values of a range, even ones count the rest below it."""
    names = list(ranges)
    lows = {c: [low for low, _ in ranges[c]] for c in names}
    highs = {c: [high for _, high in ranges[c]] for c in names}

    def count(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            parts = []
            for i, c in enumerate(names):
                x = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                at = np.searchsorted(lows[c], x, side="right") - 1
                inside = (at >= 0) & (x <= np.take(highs[c], np.maximum(at, 0)))
                values, n = np.unique(x[inside], return_counts=True)
                slots = 2 * (np.searchsorted(lows[c], values, side="right") - 1) + 1
                gaps, m = np.unique(2 * (at[~inside] + 1), return_counts=True)
                parts.append((c, np.concatenate([slots, gaps]), np.concatenate([values, np.zeros(len(gaps))]), np.concatenate([n, m])))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c for c, slot, _, _ in parts for _ in slot], pa.string()),
                    pa.array(np.concatenate([p[1] for p in parts]), pa.int64()),
                    pa.array(np.concatenate([p[2] for p in parts]), pa.float64()),
                    pa.array(np.concatenate([p[3] for p in parts]), pa.int64()),
                ],
                ["feature", "slot", "value", "n"],
            )

    found = numbers.select(*names).mapInArrow(count, "feature string, slot bigint, value double, n bigint")
    return found.groupBy("feature", "slot", "value").agg(F.sum("n").alias("n"))


def exact_quantiles(df: DataFrame, columns: Sequence[str], points: int) -> DataFrame:
    """(feature, quantiles): `points` evenly spaced, linearly interpolated quantiles.

    A sketch brackets the wanted ranks; a second pass counts the rows outside the brackets
    and only the values inside move. Distributed running totals give each of these its range
    of ranks; a value emits the quantile positions inside its range.
    """
    columns = list(columns)
    numbers = _numbers(df, columns)
    found, ranges = _brackets(numbers, columns, points)
    sizes = df.sparkSession.createDataFrame(
        [(c, n, min(points, n)) for c, n in found.items()],
        "feature string, total bigint, points bigint",
    )
    if not found:
        return sizes.select("feature", F.array().cast("array<double>").alias("quantiles"))
    ranked = running_totals(
        _counts(numbers, ranges), ["feature"], ["slot", "value"], {"earlier": F.col("n")}
    )
    ranked = ranked.where(F.col("slot") % 2 == 1)
    ranked = ranked.join(F.broadcast(sizes), "feature")  # one row per column

    none = F.array().cast("array<bigint>")
    last, steps = F.greatest(F.col("total") - 1, F.lit(1)), F.col("points") - 1

    def first_position(rank: Column) -> Column:
        """Smallest k with k * (total - 1) / (points - 1) >= rank."""
        return F.ceil(F.greatest(rank, F.lit(0)) * steps / last).cast("bigint")

    def positions(shift: int) -> Column:
        """The k whose lower rank plus `shift` falls on this value."""
        start = F.col("earlier") - shift
        low, high = first_position(start), first_position(start + F.col("n")) - 1
        high = F.when(start + F.col("n") + shift > last, steps).otherwise(high)
        some = F.when(low <= high, F.sequence(low, high)).otherwise(none)
        if shift:
            return F.when(steps == 0, none).otherwise(some)
        at_start = F.when(start == 0, F.array(F.lit(0).cast("bigint"))).otherwise(none)
        return F.when(steps == 0, at_start).otherwise(some)

    missing = F.lit(None).cast("double")
    value = F.col("value")
    hits = F.concat(
        F.transform(positions(0), lambda k: F.struct(k.alias("k"), value.alias("lo"), missing.alias("hi"))),
        F.transform(positions(1), lambda k: F.struct(k.alias("k"), missing.alias("lo"), value.alias("hi"))),
    )
    at = F.col("k") * (F.col("total") - 1) / F.greatest(steps, F.lit(1))
    part = at - F.floor(at)
    quantile = F.col("lo") + F.when(part > 0, (F.col("hi") - F.col("lo")) * part).otherwise(0.0)
    return (
        ranked.select("feature", "total", "points", F.inline(hits))
        .groupBy("feature", "k", "total", "points")
        .agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"))
        .groupBy("feature")
        .agg(F.array_sort(F.collect_list(F.struct("k", quantile.alias("q")))).alias("_list"))
        .select("feature", F.col("_list.q").alias("quantiles"))
    )


def approx_quantiles(df: DataFrame, columns: Sequence[str], points: int) -> DataFrame:
    """As `exact_quantiles`, from mergeable sketches in one pass; ranks within 1/100,000."""
    columns = list(columns)
    shares = [k / (points - 1) for k in range(points)] if points > 1 else [0.0]
    row = _numbers(df, columns).agg(
        *[F.percentile_approx(c, shares, APPROX_ACCURACY).alias(c) for c in columns]
    )
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("quantiles")) for c in columns]
    return row.select(F.inline(F.array(*entries))).filter(F.col("quantiles").isNotNull())
