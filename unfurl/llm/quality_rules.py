"""Quality rules: base counts per document, and lines that too many documents of a host hold.

DataFrame functions only. Base counts are computed inside the row (no shuffle of words):
three-word windows become 64-bit hashes, and one primitive sort of hash and position finds
the repeated ones. For the method, lines are normalised and hashed, distinct documents are
counted per host and line, lines above the host's limit are taken out of the word count,
and documents that lose too much are rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Limits:
    """A line is frequent in a host if more than ``max_docs`` documents of different text hold it,
    however many documents the host has: copies of one document make no line frequent. A document
    is depleted if fewer than ``left`` of its words stay when its frequent lines go."""

    min_words: int = 50
    repeat_percent: int = 50
    max_docs: int = 20
    left: float = 0.3


def _words(text: Column) -> Column:
    """White-space separated words; none for a text without any."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def _lines(text: Column) -> Column:
    """(hash, words) of each normalised line with a word."""
    norm = F.transform(F.split(F.lower(text), "\n"), lambda x: F.btrim(F.regexp_replace(x, SPACE, " "), F.lit(" ")))
    full = F.filter(norm, lambda x: x != "")
    return F.transform(full, lambda x: F.struct(
        F.xxhash64(x).alias("h"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("n")))


def base_counts(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """rid, doc, host, who (hash of the text), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines."""
    d = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc"),
                    F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # one projection per step: what a step uses twice is computed once
    d = d.withColumn("words", _words(F.col("text")))
    with_word = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    d = d.select("rid", "doc", "host", F.xxhash64("text").alias("who"), "text", with_word.alias("full"), F.size("words").alias("nw"),
                 F.length(F.array_join("words", "")).alias("chars"), F.transform("words", lambda w: F.xxhash64(w)).alias("hw"))
    index = F.when(F.col("nw") >= 3, F.sequence(F.lit(0), F.col("nw") - 3)).otherwise(F.array().cast("array<int>"))
    hw = F.col("hw")
    d = d.select("rid", "doc", "host", "who", "nw", "chars", (F.size("full") - F.size(F.array_distinct("full"))).alias("dup"),
                 F.regexp_count("text", F.lit(SYMBOLS)).alias("symbols"), _lines(F.col("text")).alias("lines"),
                 F.transform(index, lambda i: F.xxhash64(hw[i], hw[i + 1], hw[i + 2])).alias("h"),
                 # bits that hold every position; the mask keeps the others for the hash
                 F.expr("shiftleft(1L, length(bin(nw))) - 1").alias("mask"))
    d = d.withColumn("s", F.sort_array(F.transform("h", lambda x, i: (x.bitwiseAND(F.bitwise_not("mask"))).bitwiseOR(i.cast("long")))))
    s, h, mask = F.col("s"), F.col("h"), F.col("mask")

    def whole(i: Column) -> Column:     # the full hash of the window that stands at i of the sorted ones
        return h[s[i].bitwiseAND(mask).cast("int")]

    twin = F.filter(F.transform(s, lambda x, i: F.when(
        ((i > 0) & (whole(i) == whole(i - 1))) | ((i < F.size(s) - 1) & (whole(i) == whole(i + 1))),
        x.bitwiseAND(mask).cast("int")).otherwise(F.lit(-1))), lambda p: p >= 0)
    d = d.select("rid", "doc", "host", "who", "nw", "chars", "dup", "symbols", "lines", F.sort_array(twin).alias("at"))
    at = F.col("at")
    gaps = F.transform(at, lambda p, i: F.when(i < F.size(at) - 1, F.least(F.lit(3), at[i + 1] - p)).otherwise(F.lit(3)))
    repeated = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)
    return d.select("rid", "doc", "host", "who", F.col("nw").cast("long").alias("n_words"), F.col("chars").cast("long").alias("word_chars"),
                    F.col("symbols").cast("long").alias("n_symbols"), F.col("dup").cast("long").alias("n_dup_lines"),
                    repeated.alias("n_repeat_words"), "lines")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  lim: Limits = Limits()) -> DataFrame:
    """doc, the base counts, base_failed, n_frequent_words, kept: one row per row of ``docs``.

    A null or empty text has no words and fails the base rules. Null hosts are one host. Rows
    with one text are one document when documents are counted, whatever their ids.
    """
    base = common.stage(base_counts(docs, id_col, text_col, host_col), "quality")
    seen = base.select("host", "who", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    counts = seen.groupBy("host", "h").agg(F.count_distinct("who").alias("n")).where(F.col("n") > lim.max_docs)
    # a written table has a size Spark knows: it broadcasts it only if it is small
    common_lines = common.stage(counts.select("host", "h"), "frequent")
    own = base.select("rid", "host", F.explode("lines").alias("x")).select("rid", "host", F.col("x.h").alias("h"), F.col("x.n").alias("n"))
    lost = own.join(common_lines, ["host", "h"]).groupBy("rid").agg(F.sum("n").cast("long").alias("n_frequent_words"))
    out = base.drop("lines").join(lost, "rid", "left").withColumn("n_frequent_words", F.coalesce("n_frequent_words", F.lit(0).cast("long")))
    failed = (F.col("n_words") < lim.min_words) | (100 * F.col("n_repeat_words") > lim.repeat_percent * F.col("n_words"))
    depleted = F.col("n_words") - F.col("n_frequent_words") < F.lit(lim.left) * F.col("n_words")
    return out.select("doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), "n_frequent_words", (~failed & ~depleted).alias("kept"))


def sql(lim: Limits = Limits()) -> str:
    """The same over ``documents`` in DuckDB SQL."""
    ws = r"[\x20\x09-\x0D]+"
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT doc_id, i FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) AS t(o) GROUP BY doc_id),
ln AS (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
wl AS (SELECT doc_id, host, text, line, trim(regexp_replace(lower(line), '{ws}', ' ', 'g'), ' ') AS k FROM ln WHERE trim(line, {blanks}) <> ''),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM wl GROUP BY doc_id),
freq AS (SELECT host, k FROM wl GROUP BY host, k HAVING count(DISTINCT text) > {lim.max_docs}),
lost AS (SELECT doc_id, sum(len(string_split(k, ' '))) AS n FROM wl JOIN freq USING (host, k) GROUP BY doc_id),
c AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS n_frequent_words
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < {lim.min_words} OR 100 * n_repeat_words > {lim.repeat_percent} * n_words) AS base_failed, n_frequent_words,
       NOT (n_words < {lim.min_words} OR 100 * n_repeat_words > {lim.repeat_percent} * n_words)
       AND NOT (n_words - n_frequent_words < {lim.left} * n_words) AS kept
FROM c"""
