"""Intermediate tables in the folder shared by all executors.

The cluster names that folder in `spark.checkpoint.dir`. A local folder is made
only when the setting is absent, which is the case in tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"
ROWS_PER_PARTITION = 200_000
MIN_ROWS_PER_PARTITION = 5_000


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    named = context.getConf().get(CHECKPOINT_SETTING) or context.getCheckpointDir()
    if not named and not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError(f"executors share no folder: set {CHECKPOINT_SETTING}")
    if not named:
        named = tempfile.mkdtemp(prefix="featurelab-")
        context.setCheckpointDir(named)
        named = context.getCheckpointDir()
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


class Scratch:
    """Owns the intermediate tables made while it is entered; `close` deletes them.

    Frames that still read these tables cannot be read afterwards.
    """

    _entered: list[Scratch] = []

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        Scratch._entered.append(self)
        return self

    def __exit__(self, *_: object) -> None:
        Scratch._entered.remove(self)

    def close(self) -> None:
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(hadoop).delete(place, True)
        self.paths.clear()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, owned by the `Scratch` entered last, if any."""
    path = f"{shared_folder(spark)}/featurelab/{name}-{uuid.uuid4().hex}"
    if Scratch._entered:
        Scratch._entered[-1].paths.append(path)
    return path


def is_small(df: DataFrame, rows: int) -> bool:
    return rows <= 4 * df.sparkSession.sparkContext.defaultParallelism * ROWS_PER_PARTITION


def spread(df: DataFrame, rows: int) -> DataFrame:
    """Even partitions of about ROWS_PER_PARTITION rows, at least one per core if there are enough.

    For tables that are small beside their partitioning: a sample out of many files,
    or one file that cannot be split. Larger ones are left as they lie.
    """
    if not is_small(df, rows):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = -(-rows // ROWS_PER_PARTITION)
    return df.repartition(max(parts, min(cores, rows // MIN_ROWS_PER_PARTITION), 1))


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """Partitions of about ROWS_PER_PARTITION rows, for work that holds a partition's rows as objects.

    Files are read by bytes, and of well compressed columns a few megabytes hold millions of rows. Rows are dealt
    by their place in the files, which needs no sort and is the same if a task is repeated.
    """
    return df.repartition(max(1, -(-rows // ROWS_PER_PARTITION)), F.monotonically_increasing_id())


def stage(
    df: DataFrame, name: str = "stage", rows: int | None = None, folder_by: str | None = None
) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage like `checkpoint()`, survives lost executors, and lets later
    passes read only the columns they need. With a row count, small tables are
    evened out first (see `spread`). `folder_by` names a column with few values;
    filters on it then read only their part, from files of the advised size.
    """
    if rows is not None and is_small(df, rows):
        df = spread(df, rows)
    elif folder_by:
        df = df.hint("rebalance", folder_by)
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(folder_by) if folder_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
