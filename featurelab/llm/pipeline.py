"""Stages of the corpus pipeline: functions of (spark, docs, folder) that return documents.

Nulls, empty and repeated rows and empty tables are treated as the operators' docstrings say. Columns
beside `doc_id` and `text` are carried along untouched, but `n_chars` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.llm import bpe, decontaminate, line_dedup, near_dup, quality
from featurelab.llm.common import BROADCAST_IDS, read
from featurelab.sources.scratch import stage

#: Pieces in the encoder's memo: Python workers share their executor with a JVM whose heap the earlier stages have filled.
MEMO_PIECES = 50_000


def with_text(rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The documents of the struct `row` with the column `text` in the place of the text, and its length in that of n_chars.

    The documents' columns stay in the struct until the end, so none of their names can clash.
    """
    changed = {"text": F.col(text)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Failing lines go, and documents that the rules reject."""
    return with_text(quality.measured(docs).where("kept"), docs, "clean_text")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeated windows of lines go; a document that loses its last word that way goes too."""
    rows = line_dedup.deduplicated(docs)
    left = F.rlike(F.coalesce("left_text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]"))
    return with_text(rows.where((F.col("n_removed") == 0) | left), docs, "left_text")


def near_dup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates stays: shingles of five words."""
    judged = near_dup.near_duplicates(docs, size=5)
    gone = stage(judged.where(~F.col("kept")).select("doc_id").distinct(), "gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.without_leaks(docs, read(spark, folder, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, tokens, n_tokens, decoded_equal): ids of each text, checked by decoding them."""
    return bpe.encoded(docs, verify=True, max_pieces=MEMO_PIECES)
