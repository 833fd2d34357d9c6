"""Share of the most frequent value in each column. NULL counts as a value.

Bounds first: a frequent-item sketch per column names candidates in one pass without a shuffle, a second pass counts them
exactly. Their greatest count is a lower bound of the greatest count; what the sketch says of all other values is an upper one.
Only columns that the bounds leave open are counted value by value, as digests of fixed width. Texts are sketched and counted by
their hash, so that no value of any length leaves its task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A sketch that tracks m items misjudges a count by less than 3.5 / m of the rows.
ERROR_FACTOR = 3.5
TRACKED = 1024
CANDIDATES = 16

SKETCHED_TYPES = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
    T.StringType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)

RATIO_COLUMNS = ("feature_name", "total_cnt", "max_cnt", "ratio")


def _typed(df: DataFrame, name: str) -> Column:
    """What stands for a value in sketches and counts: numbers and dates themselves, the hash of a text."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return value + F.lit(0).cast(kind)
    if isinstance(kind, T.StringType):
        return F.when(value.isNotNull(), F.xxhash64(value))
    return value


def value_bounds(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, tuple[int, float]]]:
    """Rows, and for each column a count that its most frequent value reaches and one that it does not exceed.

    Columns of types that a sketch does not take have no entry.
    """
    names = [c for c in columns if isinstance(df.schema[c].dataType, SKETCHED_TYPES)]
    if not names:
        return df.count(), {}
    plain = df.select(*[_typed(df, c).alias(f"c{i}") for i, c in enumerate(names)])
    each = range(len(names))
    sketch = plain.agg(
        F.count("*").alias("n"), *[F.expr(f"approx_top_k(c{i}, {CANDIDATES}, {TRACKED})").alias(f"c{i}") for i in each]
    ).first()
    total = sketch["n"]
    items = {i: [entry["item"] for entry in sketch[f"c{i}"] or []] for i in each}
    counts = [
        F.count_if(F.col(f"c{i}").eqNullSafe(F.lit(item).cast(plain.schema[f"c{i}"].dataType))).alias(f"n{i}_{k}")
        for i in each
        for k, item in enumerate(items[i])
    ]
    exact = plain.agg(F.count("*").alias("n"), *counts).first()
    bounds = {}
    for i, c in enumerate(names):
        lower = max([exact[f"n{i}_{k}"] for k in range(len(items[i]))], default=0)
        # the sketch may leave out what it counted no higher than its error, which is then below twice the error in truth;
        # what it left out for the number of names is at most the last one named
        others = 2 * ERROR_FACTOR / TRACKED * total
        if len(items[i]) == CANDIDATES:
            others = max(others, sketch[f"c{i}"][-1]["count"])
        elif len(items[i]) < CANDIDATES and sum(exact[f"n{i}_{k}"] for k in range(len(items[i]))) == total:
            others = 0
        bounds[c] = lower, max(lower, others)
    return total, bounds


def _counted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every value of the columns counted, as digests: one row for each column."""

    def digest(pos: int, name: str) -> Column:
        value = _typed(df, name)
        if isinstance(df.schema[name].dataType, T.MapType):
            value = F.to_json(F.map_entries(value))
        elif isinstance(df.schema[name].dataType, T.StringType):
            value = F.col(f"`{name}`")
        return F.struct(
            F.lit(pos).alias("pos"), value.isNull().alias("none"), F.xxhash64(F.lit(1), value).alias("h1"),
            F.xxhash64(F.lit(2), value).alias("h2"),
        )

    keys = df.select(F.inline(F.array(*[digest(i, c) for i, c in enumerate(columns)])))
    counts = keys.groupBy("pos", "none", "h1", "h2").agg(F.count("*").alias("cnt"))
    sums = counts.groupBy("pos").agg(F.sum("cnt").alias("total_cnt"), F.max("cnt").alias("max_cnt"))
    name = F.get(F.array(*map(F.lit, columns)), F.col("pos")).alias("feature_name")
    return sums.select(name, "total_cnt", "max_cnt", (F.col("max_cnt") / F.col("total_cnt")).alias("ratio"))


def _known(df: DataFrame, total: int, found: Mapping[str, int]) -> DataFrame:
    rows = [(c, total, n, n / total) for c, n in found.items()]
    return df.sparkSession.createDataFrame(rows, "feature_name string, total_cnt bigint, max_cnt bigint, ratio double")


def _shares(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    total, bounds = value_bounds(df, columns)
    if not total:
        return _known(df, 1, {})
    least = threshold * total
    sure = {c: low for c, (low, high) in bounds.items() if low == high and low >= least}
    open_ = [c for c in columns if c not in sure and (c not in bounds or bounds[c][1] >= least)]
    parts = [_known(df, total, sure)] if sure or not open_ else []
    if open_:
        parts.append(_counted(df, open_))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.filter(F.col("ratio") >= threshold).select(*RATIO_COLUMNS)


def value_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The largest share in every column, exactly; none for a table without rows."""
    return _shares(df, columns, 0.0)


def dominant_ratio(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    """Columns in which one value reaches `threshold` of the rows, with its exact share.

    Columns whose upper bound lies below the threshold are not counted at all.
    """
    return _shares(df, columns, threshold)
