"""A pipeline over ``documents``: quality, line dedup, near-duplicates, decontamination, segmentation.

Each stage takes the rows its predecessor kept and returns the columns of ``documents``;
the last one returns the segmentations.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dieflow.llm import contamination, line_runs, near_dup, quality, segmentations
from dieflow.llm.common import Scratch, table, without

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A document is kept from this quality score on.
KEEP = 0.7


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored KEEP or more; the classifier learns from the trusted labels of these documents."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").filter(~held_out).select("doc_id")
    # Decisions are about texts: rows with NULL or repeated ids have their own.
    marked = docs.withColumn("_key", F.xxhash64("text"))
    known = marked.join(trusted.distinct(), "doc_id", "left_semi").select(F.col("_key").alias("doc_id"))
    scored = quality.quality_scores(marked.select(F.col("_key").alias("doc_id"), "text"), known, F.lit(True))
    rejected = scored.filter(F.col("score") < KEEP).select(F.col("doc_id").alias("_key")).distinct()
    return without(marked, rejected, "_key").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; a document of nothing else goes."""
    cut = line_runs.dedup_lines(docs)
    emptied = (F.col("line_dedup.n_removed") > 0) & (F.trim(F.coalesce("text", F.lit(""))) == "")
    changed = F.col("line_dedup.n_removed") > 0
    return cut.filter(~emptied).withColumn("n_chars", F.when(changed, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    gone = near_dup.near_duplicates(docs).filter("not kept").select("doc_id").distinct()
    key = F.xxhash64("doc_id").alias("_key")
    return without(docs.withColumn("_key", key), gone.select(key), "_key").select(*COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return contamination.clean_documents(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def segmentation_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document, with their ids."""
    return segmentations.sampled_segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"), k=2)


STAGES = [
    ("quality", quality_stage), ("lines", line_stage), ("near_duplicates", near_stage), ("benchmark", benchmark_stage), ("segmentations", segmentation_stage),
]

# Scores, MinHash signatures and sampled segmentations have no SQL form; the test compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's rows are written and read again."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        previous, docs = docs, scratch.keep(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(previous)
    return docs
