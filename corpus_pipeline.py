"""A corpus pipeline: documents through quality, line dedup, near-dedup, decontamination and tokenising.

Each stage is written as Parquet and read again as the next stage's documents, so a lost executor costs one
stage at most, and no plan grows over stages.  All stages but the last return the columns of documents;
the last adds ``token_ids``.  Every stage takes null and empty texts, repeated rows, empty tables and extra
columns as its operator defines.  Stages with Python tasks have whole texts handed over in batches of a few MB
(``common.small_batches``), so that an executor's memory does not follow the length of the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapfold.llm import common, line_dedup, quality_rules, sentencepiece_fst, simhash_covering, spaced_seeds
from snapfold.session import saved, scratch_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    common.small_batches(spark)
    return quality_rules.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand earlier in the corpus; ``n_chars`` is counted again."""
    found = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    common.small_batches(spark)
    return simhash_covering.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    common.small_batches(spark)
    return spaced_seeds.keep_clean(docs, common.table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids."""
    common.small_batches(spark)
    return sentencepiece_fst.encode(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("sentencepiece encoding", token_stage),
]

#: Compression ratios, fingerprints and tokens have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next reads it."""
    folder = scratch_folder(spark, "pipeline")
    docs = common.table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"{folder}/{number}")
    return docs
