"""Scalers: parameters fitted by aggregation, applied as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from featurelab.functions.quantiles import approx_quantiles, exact_quantiles
from featurelab.sources.scratch import stage

METHODS = ("standard", "minmax", "quantile", "binning")
DEFAULT_BINS = 10
QUANTILES = 1000


def _number(name: str) -> Column:
    """The column as double, NaN read as missing."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def fit_scaler(
    df: DataFrame,
    columns: Sequence[str],
    method: str,
    bins: int = DEFAULT_BINS,
    n_quantiles: int = QUANTILES,
    exact: bool = True,
) -> DataFrame:
    """(feature, method, params). One aggregation over all columns; quantiles see their module."""
    if method not in METHODS:
        raise ValueError(f"unknown scaling method: {method!r}")
    if method == "quantile":
        fit = exact_quantiles if exact else approx_quantiles
        table = fit(df, columns, n_quantiles).withColumnRenamed("quantiles", "params")
    else:
        parts = {
            "standard": lambda x: [F.avg(x), F.stddev_pop(x)],
            "minmax": lambda x: [F.min(x), F.max(x)],
            "binning": lambda x: [F.min(x), F.max(x), F.lit(float(bins))],
        }[method]
        fitted = df.agg(*[F.array(*parts(_number(c))).alias(c) for c in columns])
        entries = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("params")) for c in columns]
        table = fitted.select(F.inline(F.array(*entries)))
    return stage(table.select("feature", F.lit(method).alias("method"), "params"), "scaler")


def _scaled(name: str, method: str, params: Sequence[float | None]) -> Column:
    x = _number(name)
    if params[0] is None:  # no value was seen in the fit
        return x
    if method == "standard":
        mean, std = params
        return (x - F.lit(mean)) / F.lit(std if std else 1.0)
    low, high = params[0], params[1]
    width = (high - low) or 1.0
    if method == "minmax":
        return (x - F.lit(low)) / F.lit(width)
    bins = int(params[2])
    place = F.floor((x - F.lit(low)) / F.lit(width) * F.lit(float(bins)))
    return F.when(x.isNotNull(), F.least(F.greatest(place, F.lit(0)), F.lit(bins - 1))).cast("double")


def _quantile_columns(df: DataFrame, fitted: dict[str, list[float]]) -> DataFrame:
    """Position among the fitted quantiles; all columns in one Arrow exchange.

    Inside a run of equal quantiles it is the mean of the left and right position.
    The function needs numpy and pandas only, so workers need not have this package.
    """
    tables = {f"q{i}": np.asarray(q) for i, q in enumerate(fitted.values())}
    schema = ", ".join(f"{name} double" for name in tables)

    def position(values: pd.Series, quantiles: np.ndarray) -> np.ndarray:
        shares = np.linspace(0.0, 1.0, len(quantiles))
        x = values.to_numpy(dtype=float)
        right = np.interp(x, quantiles, shares)
        left = -np.interp(-x, -quantiles[::-1], -shares[::-1])
        out = (right + left) / 2
        out[x == quantiles[-1]] = 1.0
        out[x == quantiles[0]] = 0.0
        out[np.isnan(x)] = np.nan
        return out

    @pandas_udf(schema)
    def scale(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({name: position(frame[name], q) for name, q in tables.items()})

    inputs = F.struct(*[_number(c).alias(name) for c, name in zip(fitted, tables)])
    missing = F.lit(None).cast("double")
    scaled = {c: F.nanvl(F.col(f"_scaled.{name}"), missing) for c, name in zip(fitted, tables)}
    return df.withColumn("_scaled", scale(inputs)).withColumns(scaled).drop("_scaled")


def apply_scaler(df: DataFrame, scaler: DataFrame) -> DataFrame:
    """Scale the fitted columns that `df` has, to double. Missing stays missing."""
    rows = [r for r in scaler.collect() if r.feature in df.columns]  # one row per column
    quantile = {r.feature: r.params for r in rows if r.method == "quantile"}
    simple = {r.feature: _scaled(r.feature, r.method, r.params) for r in rows if r.method != "quantile"}
    if simple:
        df = df.withColumns(simple)
    return _quantile_columns(df, quantile) if quantile else df
