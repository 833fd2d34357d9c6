"""Line dedup: repeated windows of three consecutive lines go, all but their first occurrence.

Lines are divided by line feeds; those that hold a word count, compared without the white space
around them. Every three consecutive ones are a window, hashed to 128 bits. A window's first
occurrence in the collection, by (id, text hash, line), stays; every later occurrence, in the same
document or another, is covered, and the covered lines are removed. Windows overlap, so a long
repeated passage is covered as a whole. Blank lines inside a covered window go with it.

Texts with fewer than three lines, empty texts and nulls have no window and stay as they are (null
stays null). Rows that are equal in id and text are the same occurrence: they get the same result
and do not count as repeats of each other. Rows of one id with different texts are told apart by
the text's hash; a null id sorts first. An empty table gives an empty result. Only id and text are
read, so columns with clashing names do not matter.

Only DataFrame functions. Window hashes are counted by a partial aggregate, so that a window in a
third of all documents is collapsed before the shuffle, and joined back to one row for each
repeated hash; what is gathered is bounded by the lines of one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.llm.common import WORD, read

LINES = 3


def windows(text: Column) -> Column:
    """Array of (start, end, h1, h2): line numbers and hashes of the windows of a text."""
    every = F.transform(
        F.split(text, "\n"), lambda line, i: F.struct(i.alias("i"), F.trim(line, F.lit(" \t\r\x0b\x0c")).alias("l"))
    )
    held = F.filter(every, lambda x: F.rlike(x["l"], F.lit(WORD)))

    def cut(lines: Column) -> Column:
        def window(i: Column) -> Column:
            three = [F.get(lines, i + k)["l"] for k in range(LINES)]
            return F.struct(
                F.get(lines, i)["i"].alias("start"),
                F.get(lines, i + (LINES - 1))["i"].alias("end"),
                F.xxhash64(*three).alias("h1"),
                F.xxhash64(F.lit("second"), *three).alias("h2"),
            )

        count = F.size(lines) - LINES
        starts = F.when(count >= 0, F.sequence(F.lit(0), count)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, window)

    return F.element_at(F.transform(F.array(held), cut), 1)


def covered_ranges(df: DataFrame) -> DataFrame:
    """(id, print, ranges) of the documents that lose lines; df has id, print and text."""
    found = df.select("id", "print", F.explode(windows(F.col("text"))).alias("w")).select(
        "id", "print", "w.*"
    )
    place = F.struct("id", "print", "start")
    first = (
        found.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
        .where("times > 1")
        .drop("times")
    )
    later = found.join(first, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("id", "print").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))


def without_ranges(text: Column, ranges: Column) -> Column:
    """(text, lines removed) without the lines in the ranges."""
    lines = F.split(text, "\n")
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    gone = F.flatten(F.transform(ranges, lambda r: F.sequence(r["start"], r["end"])))
    left = F.array_except(numbers, gone)

    def rest(bound: Column) -> Column:
        kept = F.transform(bound["left"], lambda i: F.get(bound["lines"], i))
        return F.struct(
            F.array_join(kept, "\n").alias("text"),
            (F.size(bound["lines"]) - F.size(bound["left"])).cast("long").alias("n_removed"),
        )

    both = F.struct(lines.alias("lines"), left.alias("left"))
    return F.element_at(F.transform(F.array(both), rest), 1)


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row as a struct `row`, with its text after removal and the number of lines removed."""
    rows = df.select(
        F.struct(*df.columns).alias("row"),
        F.col(key).alias("id"),
        F.xxhash64(text).alias("print"),
        F.col(text).alias("text"),
    )
    ranges = covered_ranges(rows.select("id", "print", "text")).select(
        F.col("id").alias("rid"), F.col("print").alias("rprint"), "ranges"
    )
    same = F.col("id").eqNullSafe(F.col("rid")) & (F.col("print") == F.col("rprint"))
    joined = rows.join(ranges, same, "left")
    cut = F.when(F.col("ranges").isNotNull(), without_ranges(F.col("text"), F.col("ranges")))
    return joined.select("row", "text", cut.alias("cut")).select(
        "row",
        F.when(F.col("cut").isNull(), F.col("text")).otherwise(F.col("cut.text")).alias("left_text"),
        F.coalesce("cut.n_removed", F.lit(0).cast("long")).alias("n_removed"),
    )


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = deduplicated(read(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("row.doc_id", F.col("left_text").alias("text"), "n_removed")
