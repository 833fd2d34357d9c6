"""Shared inputs of the check queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelab.sources.tables import read_parquet

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]

# SQL text shared by several oracles
LINE_KEY_TEXT = "concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet")


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def hash_sql(key: str, salt: str) -> str:
    return f"cast('0x' || substr(md5(cast({key} as varchar) || ':{salt}'), 1, 8) as bigint)"


def digest_sql(key: str, salt: str) -> str:
    """What rows are ordered by when a prefix of them is taken."""
    return f"md5(cast({key} as varchar) || ':{salt}')"


def urgent_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.withColumn("urgent", (F.col("o_orderpriority") == "1-URGENT").cast("int"))


def document_features(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with five numbers taken from the whole text."""
    text = F.col("text")
    size = F.nullif(F.length(text), F.lit(0)).cast("double")
    words = F.split(text, " ")
    docs = table(spark, folder, "documents").select(
        "doc_id",
        F.length(text).cast("double").alias("chars"),
        (F.size(F.array_distinct(words)) / F.size(words)).alias("distinct_words"),
        (F.length(F.regexp_replace(text, "[A-Za-z]+", "")) / size).alias("non_letters"),
        F.size(F.split(text, "\n")).cast("double").alias("lines"),
        (F.length(F.regexp_replace(text, "[^0-9]+", "")) / size).alias("digits"),
    )
    return docs.join(table(spark, folder, "labels"), "doc_id").fillna(0.0)


DOCUMENT_FEATURES = ("chars", "distinct_words", "non_letters", "lines", "digits")

DOCUMENT_SQL = r"""
    select d.doc_id, l.quality,
           cast(length(text) as double) as chars,
           len(list_distinct(string_split(text, ' '))) / len(string_split(text, ' ')) as distinct_words,
           coalesce(length(regexp_replace(text, '[A-Za-z]', '', 'g')) / nullif(length(text), 0), 0.0) as non_letters,
           cast(len(string_split(text, chr(10))) as double) as lines,
           coalesce(length(regexp_replace(text, '[^0-9]', '', 'g')) / nullif(length(text), 0), 0.0) as digits
    from documents d join labels l on d.doc_id = l.doc_id
"""


def auc_sql(source: str, label: str, score: str, by: str = "") -> str:
    """ROC-AUC by running counts over distinct scores."""
    group = f"{by}, " if by else ""
    part = f"partition by {by}" if by else ""
    tail = f"group by {by}" if by else ""
    return f"""
        select {group}sum(pos * (below + neg / 2.0)) / (cast(sum(pos) as double) * sum(neg)) as auc
        from (
            select *, coalesce(sum(neg) over ({part} order by s
                          rows between unbounded preceding and 1 preceding), 0) as below
            from (
                select {group}{score} as s,
                       cast(count(*) filter (where {label} = 1) as double) as pos,
                       cast(count(*) filter (where {label} = 0) as double) as neg
                from ({source}) group by {group}{score}
            )
        ) {tail}
    """
