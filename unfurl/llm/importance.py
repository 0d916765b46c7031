"""Target-distribution importance resampling over hashed n-grams.

A document's features are its runs of one to three words, each hashed into a bucket by CRC-32.
How much more often the target texts hit a bucket than the corpus does is the bucket's gain;
a document's weight is the sum over its features, and noise that depends on its id alone turns
the weights into a draw without replacement (the highest scores win).

Hashing reads every document once: the words, joined by one blank, run through one CRC whose
value is stored after each word. The CRC of any n-gram then comes from two stored values,
that before its first word and that after its last one: moving the first over the n-gram's
length (a product by a power of x over GF(2), from tables) and adding it cancels whatever
stands before. No n-gram is ever cut out of the text.

Both counts are one grouped sum over at most ``buckets`` keys, pre-aggregated by task; the
gains (``buckets`` numbers) go to every task; the draw ranks narrow rows by a range partition
and never moves a text.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: fixed values: the reversed CRC-32 polynomial; bytes that are letters or digits after lower-casing A-Z
POLYNOMIAL = 0xEDB88320
WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_LOWER = [b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)]
FOLD = bytes(b if b in WORD_BYTES else 0x20 for b in _LOWER)
SLICE_BYTES = 1 << 18
SHORT = 64      # shifts by fewer bytes take one table each


@dataclass(frozen=True)
class Sampling:
    """``longest``: words of the longest feature. Of the documents with ``min_words`` words at least,
    ``percent`` in a hundred (rounded down) are drawn. ``seed`` enters the noise."""

    buckets: int = 10_000
    longest: int = 3
    min_words: int = 20
    percent: int = 5
    seed: str = "42"
    scale: int = 1000


# -- CRC of substrings ----------------------------------------------------------------------

def _times(a: np.ndarray, b: int) -> np.ndarray:
    """Products of polynomials modulo the CRC polynomial (bit 31 is the constant term)."""
    out = np.zeros_like(a)
    a = a.copy()
    for bit in range(31, -1, -1):
        if b >> bit & 1:
            out ^= a
        a = (a >> np.uint32(1)) ^ np.where(a & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return out


def _table(power: int) -> np.ndarray:
    """Products of x^(8 * ``power``) with each value of each byte of a CRC: four rows of 256."""
    x = np.array([1 << 31], np.uint32)
    step, p = np.array([1 << 23], np.uint32), power     # x^8, squared again and again
    while p:
        if p & 1:
            x = _times(x, int(step[0]))
        step, p = _times(step, int(step[0])), p >> 1
    byte = np.arange(256, dtype=np.uint32)
    return np.stack([_times(byte << np.uint32(8 * k), int(x[0])) for k in range(4)])


_tables: dict[str, np.ndarray] = {}


def _short_tables() -> list[np.ndarray]:
    """Of the four bytes of a CRC: products for every shift below SHORT, flat."""
    if "short" not in _tables:
        _tables["short"] = np.stack([_table(n) for n in range(SHORT)])
    return [np.ascontiguousarray(_tables["short"][:, k]).ravel() for k in range(4)]


def shift(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs moved over ``length`` bytes: what they add to the CRC of a text that goes on that far."""
    if "flat" not in _tables:
        _tables["flat"] = _short_tables()       # of one worker process
    t, low = _tables["flat"], (length & (SHORT - 1)) << 8
    out = (t[0].take(low | (crc & 0xFF)) ^ t[1].take(low | (crc >> 8 & 0xFF))
           ^ t[2].take(low | (crc >> 16 & 0xFF)) ^ t[3].take(low | (crc >> 24)))
    high, bit = length // SHORT, 0
    while high.any():       # few n-grams are that long
        at = np.flatnonzero(high & 1)
        if len(at):
            name = f"high{bit}"
            if name not in _tables:
                _tables[name] = _table(SHORT << bit)
            h, c = _tables[name], out[at]
            out[at] = h[0][c & 0xFF] ^ h[1][c >> 8 & 0xFF] ^ h[2][c >> 16 & 0xFF] ^ h[3][c >> 24]
        high, bit = high >> 1, bit + 1
    return out


def _run_on(crc: int, word: bytes) -> int:
    return zlib.crc32(word, crc)


def feature_crcs(texts: list[bytes], longest: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text, and for every n-gram length the text and the CRC-32 of each occurrence."""
    each = [t.translate(FOLD).split() for t in texts]
    n_words = np.fromiter(map(len, each), np.int64, len(each))
    flat = [w for ws in each for w in ws]
    if not flat:
        return n_words, [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in range(longest)]
    size = np.fromiter(map(len, flat), np.int64, len(flat))
    end = np.cumsum(size + 1) - 1               # places of the words in the joined texts
    pieces = b" ".join(flat).replace(b" ", b"\n ").split(b"\n")     # each word but the first with its blank
    stored = np.fromiter(accumulate(pieces, _run_on, initial=0), np.int64, len(flat) + 1)[1:]
    before = np.concatenate([[0], shift(stored[:-1], np.ones(len(flat) - 1, np.int64)) ^ zlib.crc32(b" ")])
    owner, out = np.repeat(np.arange(len(each)), n_words), []
    for n in range(1, longest + 1):
        at = np.flatnonzero(owner[:max(0, len(flat) - n + 1)] == owner[n - 1:])
        last = at + n - 1
        out.append((owner[at], stored[last] ^ shift(before[at], end[last] - end[at] + size[at])))
    return n_words, out


# -- counts and gains ---------------------------------------------------------------------------

def bucket_counts(df: DataFrame, text_col: str = "text", how: Sampling = Sampling()) -> np.ndarray:
    """Features of all texts by bucket; at most ``buckets`` rows leave a task or reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(how.buckets, np.int64)
        for b in batches:
            raw = common.text_bytes(b.column(0))
            for lo, hi in common.slices(raw, SLICE_BYTES):
                for _, crc in feature_crcs(raw[lo:hi], how.longest)[1]:
                    total += np.bincount(crc % how.buckets, minlength=how.buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    common.bound_batches(df.sparkSession)
    texts = df.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    sums = texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(how.buckets, np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray, how: Sampling = Sampling()) -> np.ndarray:
    """Floor of ``scale`` times the log of the smoothed ratio of a bucket's shares."""
    s_all, t_all = float(int(corpus.sum()) + how.buckets), float(int(target.sum()) + how.buckets)
    return np.array([math.floor(how.scale * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(ident: str, how: Sampling = Sampling()) -> int:
    """Gumbel noise of a document, from its id alone."""
    h = int(hashlib.sha256(f"{how.seed}:{ident}".encode()).hexdigest()[:8], 16)
    return math.floor(-float(how.scale) * math.log(-math.log((h + 0.5) / 4294967296)))


OUT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()),
                    T.StructField("weight", T.LongType()), T.StructField("score", T.LongType())])


def _score(gain: np.ndarray, how: Sampling):
    def run(idents, texts):
        raw, cols = common.text_bytes(texts), [[], [], []]
        for lo, hi in common.slices(raw, SLICE_BYTES):
            n_words, found = feature_crcs(raw[lo:hi], how.longest)
            n = weight = np.zeros(hi - lo, np.int64)
            for owner, crc in found:
                n = n + np.bincount(owner, minlength=hi - lo)
                sums = np.zeros(hi - lo, np.int64)
                some, total = _runs(owner, gain[crc % how.buckets])
                sums[some] = total
                weight = weight + sums
            for c, x in zip(cols, (n_words, n, weight)):
                c.append(x)
        words, n, weight = (np.concatenate(c) if c else np.empty(0, np.int64) for c in cols)
        extra = np.fromiter((noise(i or "", how) for i in idents.to_pylist()), np.int64, len(raw))
        return [pa.array(x, pa.int64()) for x in (words, n, weight, weight + extra)]
    return run


def _runs(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``value`` over stretches of equal owners, and those owners."""
    if not len(owner):
        return owner, value
    start = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
    return owner[start], np.add.reduceat(value, start)


def score_documents(docs: DataFrame, ident: Column, text: Column, gain: np.ndarray, how: Sampling = Sampling()) -> DataFrame:
    """``docs`` with n_words, n_features, weight and score; one map pass, ``gain`` in its closure."""
    return common.append_columns(docs, [F.coalesce(ident.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))],
                                 _score(gain, how), OUT)


# -- the draw -----------------------------------------------------------------------------------

def rank_scores(scored: DataFrame, how: Sampling = Sampling()) -> DataFrame:
    """``scored`` (doc, n_words, score, ...) with ``rank`` of the drawn rows, null for the others.

    Rows are dealt to ranges of (score, id) and sorted there; a row's rank is its place in the
    range and the sizes of the ranges before. Equal rows are told apart by their place in
    ``scored``, which must be a written table, so they spread over ranges too.
    """
    rows = scored.withColumn("place", F.monotonically_increasing_id())
    able = rows.where(F.col("n_words") >= how.min_words)
    order = [F.desc("score"), F.asc_nulls_last("doc"), F.asc("place")]
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # bits from 33 on are the partition of the sorted table, the others count its rows
    dealt = able.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    dealt = common.stage(dealt.drop("place"), "importance_ranges")
    here, part = F.col("at").bitwiseAND(F.lit((1 << 33) - 1)), F.shiftright("at", 33)
    # one row for each partition: a running sum over few rows
    sizes = dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"),
                         F.sum("n").over(Window.partitionBy(F.lit(0))).alias("able"))
    ranked = dealt.withColumn("part", part).join(F.broadcast(first), "part")
    rank = F.col("before") + here + 1
    drawn = F.expr(f"able * {how.percent} div 100")
    out = ranked.withColumn("rank", F.when(rank <= drawn, rank)).drop("part", "before", "able", "at")
    rest = scored.where(~(F.coalesce("n_words", F.lit(0)) >= how.min_words)).withColumn("rank", F.lit(None).cast("long"))
    return out.unionByName(rest)


def importance_scores(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      target_col: str = "text", how: Sampling = Sampling()) -> DataFrame:
    """doc, n_words, n_features, weight, score, rank of every row of ``docs``.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Null and empty
    texts have no features and weight 0; a text of fewer words than a feature has none of that
    length. A null id takes part as an empty one in the noise and comes after all others among
    equal scores. Repeated rows count as often as they occur, have equal scores and adjoining
    ranks. Of few documents none may be drawn; an empty ``target`` leaves the corpus shares
    alone, an empty ``docs`` gives no rows.
    """
    gain = gains(bucket_counts(docs, text_col, how), bucket_counts(target, target_col, how), how)
    return _ranked(docs, gain, id_col, text_col, how)


def _ranked(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, how: Sampling) -> DataFrame:
    ids = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    scored = score_documents(ids, F.col("doc"), F.col("text"), gain, how).select("doc", *OUT.names)
    return rank_scores(common.stage(scored, "importance_scores"), how)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", how: Sampling = Sampling()) -> DataFrame:
    """The drawn documents with all their columns, texts included, by a second map pass.

    The last drawn (score, id) is all that the pass needs to know; rows equal to the last one
    are all kept. Edge cases as in ``importance_scores``.
    """
    gain = gains(bucket_counts(docs, text_col, how), bucket_counts(target, target_col, how), how)
    last = _ranked(docs, gain, id_col, text_col, how).where("rank IS NOT NULL").orderBy(F.desc("rank")).limit(1).first()
    if last is None:
        return docs.limit(0)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"))
    doc = F.col("own").getField(id_col)
    scored = score_documents(rows, doc, F.col("own").getField(text_col), gain, how)
    same = F.lit(True) if last["doc"] is None else doc <= F.lit(last["doc"])
    kept = scored.where((F.col("n_words") >= how.min_words)
                        & ((F.col("score") > last["score"]) | ((F.col("score") == last["score"]) & same)))
    return kept.select(*[F.col("own").getField(c).alias(c) for c in docs.columns])


def sql() -> str:
    """DuckDB: CRC-32 byte by byte over the distinct features, the rest as grouped sums."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    how = Sampling()
    return f"""
WITH tab AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {POLYNOMIAL}) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
docs AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, {words} AS w FROM documents),
items AS MATERIALIZED (SELECT -row_number() OVER () AS id, {words} AS w FROM benchmark),
grams AS MATERIALIZED (
  SELECT id, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT id, w FROM docs UNION ALL SELECT id, w FROM items) t, (VALUES (1), (2), (3)) ns(n), unnest(range(1, len(w) - n + 2)) u(i)),
counted AS MATERIALIZED (SELECT id, g, count(*) AS c FROM grams GROUP BY id, g),
hashed AS MATERIALIZED (
  SELECT g, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(h) // 2 + 1), lambda k: ('0x' || h[2 * k - 1:2 * k])::BIGINT)),
                            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {how.buckets} AS bucket
  FROM (SELECT g, hex(encode(g)) AS h FROM (SELECT DISTINCT g FROM counted) d) x, tab),
sides AS (SELECT bucket, sum(CASE WHEN id > 0 THEN c ELSE 0 END) AS s, sum(CASE WHEN id < 0 THEN c ELSE 0 END) AS t
          FROM counted JOIN hashed USING (g) GROUP BY bucket),
gain AS (SELECT bucket, floor({how.scale} * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM sides) + {how.buckets})::DOUBLE
                                / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM sides) + {how.buckets})::DOUBLE)))::BIGINT AS gain FROM sides),
weights AS (SELECT id, sum(c) AS n, sum(c * gain) AS weight FROM counted JOIN hashed USING (g) JOIN gain USING (bucket) WHERE id > 0 GROUP BY id),
scored AS (
  SELECT doc_id, len(w) AS words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-{how.scale} * ln(-ln((('0x' || sha256('{how.seed}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (id)),
ranked AS (SELECT *, CASE WHEN words >= {how.min_words} THEN row_number() OVER (PARTITION BY words >= {how.min_words} ORDER BY score DESC, doc_id NULLS LAST) END AS r,
                  {how.percent} * count(*) FILTER (words >= {how.min_words}) OVER () // 100 AS k FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= k THEN r END AS rank FROM ranked
"""
