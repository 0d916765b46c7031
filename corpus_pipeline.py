"""The corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
DataFrame; it is written as Parquet and read back as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from unfurl.llm import common, decontaminate, language_id, line_dedup, packing, queries, simhash
from unfurl.session import ensure_checkpoint_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the fused evidence settles; the others go."""
    ensure_checkpoint_dir(spark)
    return language_id.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more share stay in one of them only."""
    ensure_checkpoint_dir(spark)
    return line_dedup.drop_repeated_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (3-word shingles, 3 bits) stays."""
    ensure_checkpoint_dir(spark)
    return simhash.drop_near_duplicates(docs, shingle=3, distance=3)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    ensure_checkpoint_dir(spark)
    return decontaminate.match(docs, common.table(spark, sf_dir, "benchmark"), clean_only=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences of 2048 tokens."""
    ensure_checkpoint_dir(spark)
    return packing.pack(docs, queries.tokenizer_path()).withColumnRenamed("doc", "doc_id")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("decontaminate", decontaminate_documents),
    ("best_fit_pack", pack_sequences),
]

#: XXH64 fingerprints, suffix arrays, language models and tokenizers have no SQL form;
#: tests/llm/test_queries.py holds every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ensure_checkpoint_dir(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
