"""Cleaning a corpus in stages; each stage is one of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featurelab.llm import pipeline
from featurelab.sources.scratch import stage

STAGES = [
    ("quality rules", pipeline.quality_rules),
    ("line dedup", pipeline.line_dedup_stage),
    ("near duplicates", pipeline.near_dup_stage),
    ("benchmark decontamination", pipeline.decontamination_stage),
    ("byte-level BPE", pipeline.bpe_stage),
]

#: The stages from near duplicates on have no SQL form; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), "documents")
    return docs
