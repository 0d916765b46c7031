"""Registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unfurl.session import ensure_checkpoint_dir, shared_path

from . import (align, common, decontaminate, html_extract, importance, language_id, line_dedup, lm_score, packing, quality_rules,
               secret_scan, simhash, url_filter, warc)

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """The vocabulary files of the queries; any other path can be passed to the operators."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in documents."""
    found = secret_scan.secret_scan(common.table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "n_assign", "n_access", "n_hex",
                        F.sha2(secret_scan.joined("base"), 256).alias("base_sha256"), secret_scan.joined("spans").alias("spans"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    found = url_filter.url_filter(common.table(spark, sf_dir, "pages").select("page_id", "url"))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdicts of documents."""
    return quality_rules.quality_rules(common.table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in documents."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.match(docs, common.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"), "longest",
                        F.coalesce("longest_item", F.lit("")).alias("longest_item"), F.coalesce("longest_start", F.lit(-1)).alias("longest_start"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of documents."""
    found = simhash.simhash_components(common.table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 tokens."""
    return packing.pack(common.table(spark, sf_dir, "documents"), tokenizer_path()).withColumnRenamed("doc", "doc_id")


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extract.extract(common.table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", "n_chars")


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of documents."""
    return lm_score.lm_score(common.table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shared by documents, kept in one of them."""
    ensure_checkpoint_dir(spark)
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    bitmaps = common.stage(line_dedup.line_dedup(docs), "bitmaps")
    out = T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
                        T.StructField("kept_sha256", T.StringType())])

    def digest(keep, texts):
        rows = [line_dedup.kept_lines(k, t) for k, t in zip(keep.to_pylist(), common.text_bytes(texts))]
        return [[r[1] for r in rows], [r[2] for r in rows], [hashlib.sha256(r[0]).hexdigest() for r in rows]]

    return line_dedup.apply_bitmaps(docs, bitmaps, out, digest, []).select("doc_id", *out.names)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document from text, declared language and source."""
    found = language_id.identify(common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return found.select("doc_id", "language", "posterior", "text_language", F.col("lang").alias("declared"), "source", "kept")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page from text, markup language, address suffix and host."""
    found = language_id.identify(common.table(spark, sf_dir, "pages").select("page_id", "url", "html"),
                                 **language_id.page_columns())
    return found.select("page_id", "url", "language", "posterior", "text_language", "kept")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back."""
    path = warc.write_pages(common.table(spark, sf_dir, "pages"), shared_path(spark, "llm", "warc", unique=True))
    return warc.read_pages(spark, path)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn towards the distribution of the benchmark."""
    found = importance.importance_scores(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups and links of two tokenizers on documents."""
    found = align.cross_align(common.table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path(PIECES))
    return found.withColumnRenamed("doc", "doc_id")


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_url_filter, op3_quality_rules, op4_decontaminate, op5_simhash, op6_pack, op7_html_extract, op8_lm_score,
    op9_line_dedup, op10_language_id, language_id_pages, op11_warc, op12_importance, op13_align)}
#: the others use models, tokenizers, XXH64 or components, which SQL has not: see tests/llm
ORACLE_SQL: dict[str, str] = {
    "op1_secret_scan": secret_scan.sql(), "op2_url_filter": url_filter.sql(), "op3_quality_rules": quality_rules.sql(),
    "op4_decontaminate": decontaminate.sql(), "op9_line_dedup": line_dedup.sql(), "op11_warc": warc.sql(), "op12_importance": importance.sql()}
