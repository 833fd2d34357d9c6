"""Outputs. Every sink is a distributed write; nothing is collected first."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.operators.splits import Splits

DROPPED_SCHEMA = "step string, feature string"


def write_table(df: DataFrame, fmt: str, name: str, path: str | None = None) -> None:
    """Replace the parquet folder or the catalog table `name`."""
    if fmt == "parquet":
        df.write.mode("overwrite").parquet(name)
    elif fmt == "hive":
        writer = df.write.mode("overwrite").format("parquet")
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
    else:
        raise ValueError(f"unknown result format: {fmt!r}")


SINGLE_FILE_ROWS = 10_000_000


def write_single_file(df: DataFrame, path: str, rows: int = SINGLE_FILE_ROWS) -> None:
    """One parquet part file, for results of at most `rows` rows; larger ones raise."""
    if df.limit(rows + 1).count() > rows:
        raise ValueError(f"more than {rows} rows for a single file")
    df.coalesce(1).write.mode("overwrite").parquet(path)


def result_name(fmt: str, base: str, split: str, suffix: str) -> str:
    if fmt == "parquet":
        return f"{base}/{split}{suffix}.parquet"
    if fmt == "hive":
        return f"{base}.{split}{suffix}"
    raise ValueError(f"unknown result format: {fmt!r}")


def scoring_base(result: Mapping) -> str:
    base = result.get("save_path_scoring")
    if not base:
        raise ValueError("result.save_path_scoring is needed to save the scoring table")
    return base


def save_splits(splits: Splits, result: Mapping) -> dict[str, str]:
    """Write each present split; returns split name -> where it went."""
    suffix = result.get("suffix", "_preprocessed")
    main = (result["format"], result["save_path"])
    base = scoring_base(result) if splits.scoring is not None else ""
    scoring = (result.get("format_scoring", "parquet"), base)
    plan = [
        ("train", splits.train, *main),
        ("test", splits.valid, *main),
        ("scoring", splits.scoring, *scoring),
    ]
    present = [(name, df, fmt, base) for name, df, fmt, base in plan if df is not None]
    names = {name: result_name(fmt, base, name, suffix) for name, _, fmt, base in present}
    for name, df, fmt, _ in present:
        write_table(df, fmt, names[name])
    return names


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Importance tables, removal histories and other reports with one row per feature."""
    if fmt == "csv":
        df.write.mode("overwrite").option("header", True).csv(path)
    elif fmt in ("parquet", "json"):
        df.write.mode("overwrite").format(fmt).save(path)
    else:
        raise ValueError(f"unknown report format: {fmt!r}")


def append_dropped(spark: SparkSession, path: str, step: str, features: Sequence[str]) -> None:
    """Record the columns one step removed."""
    rows = [(step, feature) for feature in features]
    if rows:
        spark.createDataFrame(rows, DROPPED_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_dropped(spark: SparkSession, path: str, step: str | None = None) -> list[str]:
    """Columns removed by `step` (or by any step); an absent record is an empty list."""
    try:
        record = spark.read.schema(DROPPED_SCHEMA).parquet(path)
    except AnalysisException:
        return []
    if step is not None:
        record = record.filter(F.col("step") == step)
    return sorted(row.feature for row in record.select("feature").distinct().collect())


def write_manifest(spark: SparkSession, path: str, entries: Mapping[str, object]) -> None:
    """A one-row JSON record of where the artifacts lie."""
    row = {key: value if isinstance(value, str) else json.dumps(value) for key, value in entries.items()}
    schema = ", ".join(f"`{key}` string" for key in row)
    spark.createDataFrame([tuple(row.values())], schema).coalesce(1).write.mode("overwrite").json(path)
