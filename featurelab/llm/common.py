"""Helpers of the text operators."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, which separates words: blank and \t \n \v \f \r.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Id lists up to this length (8 bytes an entry) may be broadcast; longer ones are joined by shuffle.
BROADCAST_IDS = 2_000_000


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, as `--py-files` does, once per application.

    The driver serves the archive; workers that already have the package lose nothing.
    """
    context = spark.sparkContext
    if getattr(context, "_featurelab_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if os.path.isdir(os.path.join(root, "featurelab")):
        folder = tempfile.mkdtemp(prefix="featurelab-ship-")
        copy = os.path.join(folder, "code", "featurelab")
        shutil.copytree(
            os.path.join(root, "featurelab"), copy, ignore=shutil.ignore_patterns("__pycache__")
        )
        archive = shutil.make_archive(
            os.path.join(folder, "featurelab_code"), "zip", os.path.dirname(copy), "featurelab"
        )
        context.addPyFile(archive)
    context._featurelab_shipped = True


def tidy(work):
    """A batch function that gives freed memory back when its task ends.

    Python workers live on between tasks and share their executor's limit with the JVM.
    """

    def run(batches):
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return run


def semi_join(df: DataFrame, ids: DataFrame, key: str, count: int) -> DataFrame:
    """Rows whose key is among `count` distinct ids; a short list is broadcast, a long one is not."""
    small = F.broadcast(ids) if count <= BROADCAST_IDS else ids
    return df.join(small, key, "left_semi")
