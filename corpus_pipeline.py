"""The corpus pipeline: documents to packed training sequences.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and calls one operator of ``ladle.llm``; all but the last return the
columns of ``documents``.  ``run`` writes each stage's result as Parquet to
the cluster's shared folder and gives the reread table to the next.

No SQL expresses the SimHash stage's groups or the tokenizer's ids, so the
stages are tested against brute-force versions (tests/llm).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm import exact_dedup, mixing, packing, quality, simhash
from ladle.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep (operator 7)."""
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest spelling of every text (operator 1)."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the smallest doc_id (operator 8)."""
    return simhash.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights, documents repeated as taken (operator 3)."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences (operator 2)."""
    pieces = packing.pack(docs, packing.default_tokenizer())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixed", mixed),
    ("packed", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
