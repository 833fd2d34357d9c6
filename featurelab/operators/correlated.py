"""Pairwise Pearson correlation and the choice between correlated features."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIR_SCHEMA = "f1 string, f2 string, r double"
#: Of the matrix of products that a task holds at a time: all of it up to 2,800 columns.
BLOCK_BYTES = 64 << 20


def _number(name: str) -> Column:
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def _moments(numbers: DataFrame) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, means, deviations, and which columns vary and are complete; one vector state for all columns."""
    if numbers.isEmpty():  # of no rows the summary raises
        none = np.zeros(len(numbers.columns))
        return 0, none, none, none.astype(bool)
    vectors = VectorAssembler(inputCols=numbers.columns, outputCol="v", handleInvalid="keep").transform(numbers)
    found = vectors.select(Summarizer.metrics("count", "mean", "std", "min", "max").summary(F.col("v")).alias("s")).first()
    rows = found["s"]["count"]
    mean, spread, low, high = (found["s"][k].toArray() for k in ("mean", "std", "min", "max"))
    spread = spread * np.sqrt((rows - 1) / rows)
    # a missing value is NaN in the vector, and so are then mean and deviation
    usable = np.isfinite(mean) & np.isfinite(spread) & (high > low) & (spread > 0)
    return rows, mean, spread, usable


def _products(numbers: DataFrame, mean: np.ndarray, spread: np.ndarray, start: int, stop: int) -> DataFrame:
    """(i, sums): for columns start..stop, sums of products of the standardised columns i and i, i + 1, ...

    A task adds up its rows in one matrix of (stop - start) x columns numbers.
    """
    count = len(mean)

    def add(batches):
        total = np.zeros((stop - start, count - start))
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(start, count)], axis=1)
            z = (x - mean[start:]) / spread[start:]
            total += z[:, : stop - start].T @ z
        for k in range(stop - start):
            sums = pa.array([total[k, k:]], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([start + k], pa.int32()), sums], ["i", "sums"])

    parts = numbers.mapInArrow(add, "i int, sums array<double>")
    return parts.groupBy("i").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))


def pearson_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(f1, f2, r) for every unordered pair, f1 first by name.

    r is NULL if either column is constant or has missing values. The first pass finds means and deviations, which go to the
    driver, as many as there are columns. Then the products of the standardised columns are summed in blocks of columns of at
    most `BLOCK_BYTES`, a pass for each block; the pairs stay in Spark.
    """
    spark, names = df.sparkSession, sorted(columns)
    if len(names) < 2:
        return spark.createDataFrame([], PAIR_SCHEMA)
    numbers = df.select(*[_number(c).alias(f"x{i}") for i, c in enumerate(names)])
    rows, mean, spread, usable = _moments(numbers)
    good = np.nonzero(usable)[0]
    name = F.array(*map(F.lit, names))
    first = spark.range(len(names)).select(F.col("id").cast("int").alias("i"))
    every = first.select("i", F.explode(F.sequence(F.col("i") + 1, F.lit(len(names) - 1))).alias("j")).where(f"i < j and j < {len(names)}")
    kept = F.array(*[F.lit(bool(u)) for u in usable])
    unknown = every.where(~(F.get(kept, F.col("i")) & F.get(kept, F.col("j"))))
    pairs = unknown.select(F.get(name, F.col("i")).alias("f1"), F.get(name, F.col("j")).alias("f2"), F.lit(None).cast("double").alias("r"))
    if len(good) < 2:
        return pairs
    wide = numbers.select(*[f"x{i}" for i in good])
    step = max(1, BLOCK_BYTES // (8 * len(good)))
    place = F.array(*[F.lit(names[i]) for i in good])
    for start in range(0, len(good), step):
        sums = _products(wide, mean[good], spread[good], start, min(start + step, len(good)))
        each = sums.select("i", F.posexplode(vector_to_array("sums")).alias("k", "sum")).where("k > 0")
        r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("sum") / rows))
        pairs = pairs.unionByName(
            each.select(F.get(place, F.col("i")).alias("f1"), F.get(place, F.col("i") + F.col("k")).alias("f2"), r.alias("r"))
        )
    return pairs


def correlated(pairs: DataFrame, scores: DataFrame, threshold: float) -> DataFrame:
    """Features to drop: in each pair with |r| >= threshold the lower score, on ties the later name.

    Pairs are judged one by one, so a dropped feature can still displace another.
    `scores` has one row per feature, so broadcasting it is bounded by the schema.
    """
    score = F.coalesce(F.col("score"), F.lit(0.0))
    first = F.broadcast(scores.select(F.col("feature_name").alias("f1"), score.alias("score1")))
    second = F.broadcast(scores.select(F.col("feature_name").alias("f2"), score.alias("score2")))
    zero = F.lit(0.0)
    loser = F.when(
        F.coalesce("score1", zero) < F.coalesce("score2", zero), F.col("f1")
    ).otherwise(F.col("f2"))
    strong = F.abs(F.nanvl("r", F.lit(None).cast("double"))) >= threshold
    return (
        pairs.filter(strong)
        .join(first, "f1", "left")
        .join(second, "f2", "left")
        .select(loser.alias("feature_name"))
        .distinct()
    )
