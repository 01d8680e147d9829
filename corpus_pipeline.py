"""A training-data pipeline: five stages over ``documents``, each reading what the one before wrote."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm import decontaminate, jaccard, lattice, quality, suffix
from eventlens.session import ensure_checkpoint_dir
from eventlens.sources.tables import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and all thresholds."""
    return quality.quality_rules(docs).where("kept").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (the smallest id)."""
    return jaccard.one_of_each(docs)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without passages that an earlier one has; n_chars follows the text."""
    return suffix.dedup_passages(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, and whether they decode to the same text."""
    # A null text has no ids, which is its exact form too.
    return lattice.encode(docs, with_text=False).select(F.col("id").alias("doc_id"), "n_tokens", "ids", F.coalesce("exact", F.lit(True)).alias("exact"))


STAGES = [("quality_rules", quality_stage), ("near_duplicates", near_duplicate_stage), ("passages", passage_stage),
          ("decontamination", decontamination_stage), ("encoding", encoding_stage)]

#: Near-duplicate classes and best segmentations are not expressible in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's result is written to the shared folder and read back."""
    docs = read_table(spark, sf_dir, "documents")
    folder = os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    for i, (name, stage) in enumerate(STAGES):
        path = os.path.join(folder, f"{i}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
