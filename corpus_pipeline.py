"""The corpus pipeline: quality rules, exact dedup, near-dedup, mixing, packing.

Every stage takes all rows that its predecessor kept, and all but the last return the
columns of ``documents``. Between stages the rows are written as Parquet below
``spark.checkpoint.dir`` and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martflow.llm import exact_dedup, minhash, mixing, packing, quality
from martflow.llm.common import read_table, save


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_rows(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one of largest id."""
    return exact_dedup.keep_rows(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return minhash.keep_rows(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, shuffled into shards."""
    return mixing.mixed_rows(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the training sequences."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality_stage), ("exact_dedup", exact_stage), ("minhash_near_dedup", near_stage),
          ("mixing", mix_stage), ("best_fit_packing", pack_stage)]

# The quality verdict, the sketch and the seeded mix are not expressible in SQL; see
# tests/llm for the brute-force comparison.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
