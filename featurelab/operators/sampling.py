"""Row samples and class balance, decided by key hashes.

A sample is a filter: no sort, no shuffle of rows. Only small histograms of the
hash move, to find the cut-off.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelab.functions.hashing import Keys, in_fraction, key_digits, key_list, order_digits

ROW_ID = "_row_id"
STEPS = (4, 8, 32, 36, 40, 64)  # how many digits of the row order each histogram tells apart
FEW_ROWS = 10_000  # prefixes up to this length are taken by a top-n sort: the same rows


@dataclass(frozen=True)
class Identified:
    """A table, the columns that tell its rows apart, and its row count."""

    df: DataFrame
    keys: list[str]
    count: int
    classes: tuple[int, int] | None = None


def identify_rows(
    df: DataFrame, keys: Keys, target: str | None = None, by_content: bool = False
) -> Identified:
    """The columns that decide about a row, and counts, in one pass.

    Rows are told apart by their keys, so all rows of a key share their fate. With
    `by_content` a hash of the whole row joins the key: then the rows of a heavy
    key are spread, and only equal rows stay together. With a target, the same pass
    counts its positives and negatives.
    """
    keys = key_list(keys)
    label = F.lit(None) if target is None else F.col(target)
    found = df.agg(F.count("*").alias("n"), F.count_if(label == 1), F.count_if(label == 0)).first()
    classes = None if target is None else (found[1], found[2])
    if not by_content:
        return Identified(df, keys, found.n, classes)
    content = F.substring(order_digits(df, keys, "row"), 33, 32)
    return Identified(df.withColumn(ROW_ID, content), [*keys, ROW_ID], found.n, classes)


def bernoulli(df: DataFrame, keys: Keys, fraction: float, salt: str = "sample") -> DataFrame:
    """Keep each key with probability `fraction`."""
    return df if fraction >= 1 else df.filter(in_fraction(keys, fraction, salt))


def sample_to(
    df: DataFrame, keys: Keys, size: int | None, count: int | None = None, salt: str = "sample"
) -> DataFrame:
    """About `size` rows, or the whole table when it is not larger than that."""
    if not size:
        return df
    rows = df.count() if count is None else count
    return df if size >= rows else bernoulli(df, keys, size / rows, salt)


@dataclass(frozen=True)
class Cut:
    """Where a hash-ordered prefix of exactly n rows ends."""

    below: Column
    ties: Column | None = None
    from_ties: int = 0


def _first_reaching(counts: DataFrame, n: int):
    """The bucket in which the running count reaches n, and the count before it.

    `counts` has at most 65,536 rows, so the window without a partition is small.
    """
    running = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    return (
        counts.withColumn("upto", running)
        .filter(F.col("upto") >= n)
        .orderBy("bucket")
        .select("bucket", "n", (F.col("upto") - F.col("n")).alias("before"))
        .first()
    )


def _sizes(df: DataFrame, bucket: Column) -> DataFrame:
    return df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def find_cut(df: DataFrame, keys: Keys, n: int, salt: str) -> Cut:
    """Histograms over more and more digits locate the n-th row in hash order.

    Two passes do unless rows share the first eight digits of their key's hash; then
    the rest of it and the row's content decide. Only equal rows are cut by count.
    """
    digits = order_digits(df, keys, salt)
    prefix, left, rows = "", n, df
    for width in STEPS:
        head = F.substring(digits, 1, width)
        found = _first_reaching(_sizes(rows, head), left)
        if found is None:
            return Cut(F.lit(True))
        prefix, left = found.bucket, left - found.before
        if left == found.n:
            # the short form of the digits is enough here
            short = key_digits(keys, salt) if width == 8 else head
            return Cut(short <= F.lit(prefix))
        rows = df.filter(head == prefix)
    return Cut(digits < F.lit(prefix), digits == F.lit(prefix), left)


def _tied_rows(df: DataFrame, cut: Cut) -> DataFrame:
    """`from_ties` of the rows at the border, which are all equal."""
    return df.filter(cut.ties).limit(cut.from_ties)


def take_exact(df: DataFrame, keys: Keys, n: int, salt: str = "take") -> DataFrame:
    """Exactly n rows: those that come first in the order of `order_digits`."""
    if n <= 0:
        return df.limit(0)
    if n <= FEW_ROWS:
        return df.orderBy(order_digits(df, keys, salt)).limit(n)
    cut = find_cut(df, keys, n, salt)
    kept = df.filter(cut.below)
    return kept if cut.ties is None else kept.unionByName(_tied_rows(df, cut))


def class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(F.count("*").alias("cnt"))


def negatives_needed(positives: int, positive_frac: float) -> int:
    """floor(pos * (1 - p) / p) in decimal arithmetic, so 100 and 0.2 give 400."""
    p = Decimal(str(positive_frac))
    return int(Decimal(positives) * (1 - p) / p)


def rebalance(
    df: DataFrame,
    target: str,
    positive_frac: float,
    keys: Keys,
    salt: str = "rebalance",
    classes: tuple[int, int] | None = None,
) -> DataFrame:
    """Cut negatives until positives make up `positive_frac`.

    Unchanged if the fraction is not inside (0, 1), a class is empty, or the share
    is already reached. When it does resample, rows labelled neither 0 nor 1 go.
    The result is one filtered scan of the input. `classes` are the numbers of
    positives and negatives, if already known.
    """
    if not 0 < positive_frac < 1:
        return df
    is_pos, is_neg = F.col(target) == 1, F.col(target) == 0
    pos, neg = classes or df.agg(F.count_if(is_pos), F.count_if(is_neg)).first()
    if pos == 0 or neg == 0 or Decimal(pos) >= Decimal(str(positive_frac)) * (pos + neg):
        return df
    needed = min(negatives_needed(pos, positive_frac), neg)
    if needed <= 0:
        return df.filter(is_pos)
    negatives = df.filter(is_neg)
    cut = find_cut(negatives, keys, needed, salt)
    kept = df.filter(is_pos | (is_neg & cut.below))
    return kept if cut.ties is None else kept.unionByName(_tied_rows(negatives, cut))
