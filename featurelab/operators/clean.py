"""Column-wise cleaning. Everything here is a narrow projection."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelab.operators.splits import Roles, Splits


def drop_columns(splits: Splits, names: Collection[str]) -> Splits:
    """Drop the columns from every split; names a split lacks are ignored."""
    return splits.map(lambda df: df.drop(*names)) if names else splits


def decimal_to_float(df: DataFrame, skip: Collection[str] = ()) -> DataFrame:
    decimals = [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType) and f.name not in skip
    ]
    return df.withColumns({c: F.col(c).cast("float") for c in decimals}) if decimals else df


def fill_missing(df: DataFrame, roles: Roles, numeric: float, categorical: str) -> DataFrame:
    """Constants for NULL, and for NaN in floating-point features."""
    present = set(df.columns)
    texts = [c for c in roles.categorical if c in present]
    numbers = [c for c in roles.numeric if c in present]
    if texts:
        df = df.fillna(categorical, subset=texts)
    if numbers:
        df = df.fillna(numeric, subset=numbers)
    return df


def final_projection(df: DataFrame, roles: Roles) -> DataFrame:
    """Features, index, target and skipped columns, in the table's order."""
    kept = {*roles.features, roles.index, roles.target, *roles.skip}
    return df.select(*[c for c in df.columns if c in kept])


def require_features(df: DataFrame, features: Sequence[str]) -> None:
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise KeyError(f"features missing from the table: {missing}")


def value_text(df: DataFrame, name: str) -> Column:
    """A column as text; adding zero first makes 0.0 and -0.0 the same value."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (F.col(name) + F.lit(0).cast(kind)).cast("string")
    if isinstance(kind, (T.StringType, *T.NumericType.__subclasses__(), T.BooleanType)):
        return F.col(name).cast("string")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.col(name))
    if isinstance(kind, T.BinaryType):
        return F.hex(F.col(name))
    return F.col(name).cast("string")


def unpivot_text(
    df: DataFrame, columns: Sequence[str], name_col: str = "feature_name", value_col: str = "feature_value"
) -> DataFrame:
    """Wide to long: one row per (row, column); the other columns are kept."""
    kept = [c for c in df.columns if c not in columns]
    texts = df.select(*kept, *[value_text(df, c).alias(c) for c in columns])
    return texts.unpivot(kept, list(columns), name_col, value_col)


def unpivot_numbers(
    df: DataFrame, columns: Sequence[str], name_col: str = "feature_name", value_col: str = "feature_value"
) -> DataFrame:
    """As `unpivot_text`, with the values as doubles."""
    kept = [c for c in df.columns if c not in columns]
    numbers = df.select(*kept, *[F.col(c).cast("double").alias(c) for c in columns])
    return numbers.unpivot(kept, list(columns), name_col, value_col)
