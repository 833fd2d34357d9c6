"""Category encoders: fitted dictionaries as tables, applied by joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelab.functions.hashing import Keys, key_list
from featurelab.functions.ordered import running_totals
from featurelab.operators.clean import unpivot_text
from featurelab.sources.scratch import stage

# Codes for a category that the fit did not see, and for a missing
# value when the fit saw none.
UNKNOWN_CODE = -1
MISSING_CODE = -2

MIN_SAMPLES_LEAF = 100
SMOOTHING = 20.0

BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32_000_000  # dictionary of one column
SPREAD = 1024
FREQUENT_SHARE, FREQUENT_BYTES = 0.001, 32_000  # at most 1,000 categories, 32 MB


def fit_label(df: DataFrame, columns: Sequence[str], keys: Keys) -> DataFrame:
    """(feature, value, n, code): codes 1..n in the order of each value's lowest key."""
    keys = key_list(keys)
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = df.select(*[F.col(k).alias(name) for k, name in zip(keys, names)], *columns)
    values = unpivot_text(keyed, columns, "feature", "value")
    # a bare number as key, rather than a struct around it, allows hash aggregation
    first = F.min(names[0] if len(names) == 1 else F.struct(*names))
    seen = values.groupBy("feature", "value").agg(F.count("*").alias("n"), first.alias("first"))
    # values with equal first keys (possible if keys repeat) follow in text order
    ordered = running_totals(
        seen, ["feature"], ["first", "value"], {"earlier": F.lit(1).cast("bigint")}
    )
    code = (F.col("earlier") + 1).cast("double")
    return stage(ordered.select("feature", "value", "n", code.alias("code")), "encoder")


def fit_target(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    min_samples_leaf: float = MIN_SAMPLES_LEAF,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """(feature, value, n, code): smoothed target means, weight 1 / (1 + exp(-(n - leaf) / smoothing)).

    The row with a NULL value holds the prior, used for unknown and missing values.
    """
    known = df.filter(F.col(target).isNotNull()).select(F.col(target).cast("double").alias("_y"), *columns)
    values = unpivot_text(known, columns, "feature", "value")
    sums = values.groupBy("feature", "value").agg(F.count("*").alias("n"), F.sum("_y").alias("_sum"))
    stats = stage(sums, "means")
    # every row counts once per feature, so one feature's sums give the overall mean
    one = stats.filter(F.col("feature") == columns[0])
    total, prior = one.agg(F.sum("n"), F.sum("_sum") / F.sum("n")).first()
    weight = 1.0 / (1.0 + F.exp((F.lit(float(min_samples_leaf)) - F.col("n")) / F.lit(float(smoothing))))
    mean = F.col("_sum") / F.col("n")
    code = F.lit(prior) * (1.0 - weight) + mean * weight
    fitted = stats.filter(F.col("value").isNotNull()).select("feature", "value", "n", code.alias("code"))
    rows = [(c, None, total, prior) for c in columns]
    defaults = df.sparkSession.createDataFrame(rows, "feature string, value string, n bigint, code double")
    return stage(fitted.unionByName(defaults), "encoder")


def fit_encoder(
    df: DataFrame, columns: Sequence[str], method: str, keys: Keys, target: str | None = None
) -> DataFrame:
    if method == "label_encoder":
        return fit_label(df, columns, keys)
    if method == "target_encoder":
        if target is None:
            raise ValueError("target encoding needs a target column")
        return fit_target(df, columns, target)
    raise ValueError(f"unknown encoding method: {method!r}")


def apply_encoding(
    df: DataFrame,
    encoder: DataFrame,
    columns: Sequence[str],
    method: str,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Replace each category by its code: int for labels, double for target means.

    Dictionaries of up to `broadcast_rows` entries are broadcast, which costs no shuffle, those that fit together as one.
    Longer ones are joined by value, their frequent categories still by broadcast.
    """
    if method not in ("label_encoder", "target_encoder"):
        raise ValueError(f"unknown encoding method: {method!r}")
    sizes = {
        r.feature: r
        for r in encoder.groupBy("feature")
        .agg(
            F.count("*").alias("entries"),
            F.sum("n").alias("rows"),
            F.sum(F.octet_length("value")).alias("bytes"),
            F.max(F.when(F.col("value").isNull(), F.col("code"))).alias("missing"),
        )
        .collect()  # one row per encoded column
    }
    present = [c for c in dict.fromkeys(columns) if c in df.columns and c in sizes]
    packed = _packed(present, sizes, broadcast_rows)
    inside = F.col("feature").isin(packed) & F.col("value").isNotNull()
    together = F.broadcast(
        encoder.filter(inside).select(_packed_key(F.col("feature"), F.col("value")).alias("_value"), F.col("code").alias("_code"))
    )
    for c in present:
        size = sizes[c]
        entries = encoder.filter((F.col("feature") == c) & F.col("value").isNotNull())
        if method == "label_encoder":
            missing = MISSING_CODE if size.missing is None else int(size.missing)
            unknown, kind = F.lit(UNKNOWN_CODE), T.IntegerType()
        else:
            missing, kind = size.missing, T.DoubleType()
            unknown = F.lit(missing)
        code = F.when(F.col(c).isNull(), F.lit(missing)).otherwise(F.coalesce(F.col("_code"), unknown))
        if c in packed:
            looked_up = _join(df, together, _packed_key(F.lit(c), _text(c)))
        elif size.entries <= broadcast_rows and (size.bytes or 0) <= BROADCAST_BYTES:
            looked_up = _join(df, F.broadcast(_dictionary(entries)), _text(c))
        else:
            looked_up = _join_large(df, entries, c, size.rows * FREQUENT_SHARE)
        place = [code.cast(kind).alias(x) if x == c else F.col(x) for x in df.columns]
        df = looked_up.select(*place)
    return df


def _packed(columns: Sequence[str], sizes: Mapping, broadcast_rows: int) -> list[str]:
    """The columns, shortest dictionaries first, that fit together into one broadcast dictionary.

    It is built once and read by the look-ups of all of them; their key is column and value in one text, so that no
    look-up is turned into a dictionary of its own.
    """
    out, rows, size = [], 0, 0
    for c in sorted(columns, key=lambda c: (sizes[c].entries, c)):
        rows += sizes[c].entries
        size += (sizes[c].bytes or 0) + sizes[c].entries * (len(c) + 1)
        if rows > broadcast_rows or size > BROADCAST_BYTES:
            break
        out.append(c)
    return out


def _packed_key(column: Column, value: Column) -> Column:
    return F.concat(column, F.lit("\0"), value)


def _dictionary(entries: DataFrame) -> DataFrame:
    return entries.select(F.col("value").alias("_value"), F.col("code").alias("_code"))


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _join(df: DataFrame, dictionary: DataFrame, key: Column) -> DataFrame:
    return df.join(dictionary, key == F.col("_value"), "left").drop("_value")


def _join_large(df: DataFrame, entries: DataFrame, column: str, frequent_rows: float) -> DataFrame:
    """Frequent categories take the broadcast, only rare ones the shuffle: one pass over `df`.

    Rows that need no look-up any more (frequent or missing values) keep their place in
    the join, but under a key that matches nothing and is spread over SPREAD values.
    """
    frequent = (F.col("n") >= frequent_rows) & (F.octet_length("value") <= FREQUENT_BYTES)
    names = df.columns
    hot = entries.filter(frequent).select(F.col("value").alias("_hot"), F.col("code").alias("_hot_code"))
    known = df.join(F.broadcast(hot), _text(column) == F.col("_hot"), "left")
    settled = F.col("_hot").isNotNull() | F.col(column).isNull()
    rare = _dictionary(entries.filter(~frequent)).withColumn("_place", F.lit(-1))
    spread = F.pmod(F.xxhash64(*[c for c in names if not isinstance(df.schema[c].dataType, T.MapType)]), F.lit(SPREAD))
    keyed = known.withColumns(
        {
            "_key": F.when(settled, F.lit("")).otherwise(_text(column)),
            "_at": F.when(settled, spread).otherwise(F.lit(-1)).cast("int"),
        }
    )
    joined = keyed.join(rare, (F.col("_key") == F.col("_value")) & (F.col("_at") == F.col("_place")), "left")
    return joined.select(*names, F.coalesce("_hot_code", "_code").alias("_code"))
