"""The corpus pipeline: quality rules, near-duplicates, repeated passages, mixing, packing.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read
again as the next stage's documents. All but the last give the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.llm.common import Scratch, scratch_scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    from registra.llm.quality import filter_kept

    return filter_kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    from registra.llm.near_dup import keep_one

    return keep_one(spark, docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat across documents are cut out of all but the first."""
    from registra.llm.substring import remove, repeated_passages

    return remove(spark, docs, repeated_passages(spark, docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    from registra.llm.mixing import apply_mix

    return apply_mix(spark, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    from registra.llm.packing import pack

    p = pack(spark, docs, digest={"ids_crc32": F.crc32("ids")})
    return p.placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: The stages after the first cannot be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    before = None
    for name, stage in STAGES:
        with scratch_scope():  # what a stage wrote for itself goes with it
            docs = scratch.write(stage(spark, docs, sf_dir), name, "zstd")
        if before:
            scratch.drop(before)
        before = name
    return docs
