"""Corpus pipeline over ``documents``: five stages in order, each written as
Parquet and read back as the next one's input.

Every stage works on all rows its predecessor kept and applies its decisions:
quality rules drop what they reject, exact dedup keeps one row of equal texts, the
Jaccard join one document of each group of near copies, mixing repeats or leaves
out documents until the sources meet their targets, packing cuts the documents'
tokens into sequences. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from settleframe.llm import exact_dedup, jaccard_join, mixing, packing, quality_rules
from settleframe.llm.catalog import tokenizer_path
from settleframe.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality_rules.filter_documents(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 0.8 or more)."""
    return jaccard_join.drop_near_duplicates(docs, shingle=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences of power-of-two lengths."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("jaccard_join", jaccard_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The last stage needs a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each result goes to a fresh folder under
    the shared work folder and is read back, so a lost executor costs at most
    one stage and no lineage reaches across stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
