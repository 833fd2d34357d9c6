"""Inputs: parquet files and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A metastore table or a temporary view."""
    return spark.table(name)


def read_input(spark: SparkSession, where: str | DataFrame | None) -> DataFrame | None:
    """A DataFrame as it is, a path with a slash as parquet, any other name as a table."""
    if where is None or isinstance(where, DataFrame):
        return where
    return read_parquet(spark, where) if "/" in where else read_table(spark, where)
