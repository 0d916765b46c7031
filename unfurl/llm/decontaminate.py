"""Benchmark decontamination with suffix arrays over the training texts.

Every Arrow batch of documents is cut into shards of bounded size. The windows that start the
benchmark's suffixes lie in a sorted array of 64-bit hashes; a shard probes it once with the
hashes of its own windows. Where hashes meet, the texts get a suffix array (prefix doubling, as
deep as the longest window), the windows are found in it by binary search, which settles what is
there, and runs of adjoining windows give the longest verbatim matches with their places
(matches shorter than a window are none).

The benchmark is the query set. One block of bounded bytes is scanned for without a shuffle:
the documents stay where they are. A larger benchmark is taken in such blocks, one pass of
the same scan over the staged documents for each; only one block is in the driver and in a
task at a time. The passes' findings are staged and merged by document.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from unfurl.session import shared_path

from . import common

WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
#: A-Z to lower case, whatever is no word to a blank
FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if (b + 32 if 0x41 <= b <= 0x5A else b) in WORD_BYTES else 0x20
             for b in range(256))
FACTOR = np.uint64(0x9E3779B97F4A7C15)      # odd: spreads the words' hashes over a window's
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest", T.LongType()), T.StructField("longest_item", T.StringType()),
    T.StructField("longest_start", T.LongType()), T.StructField("hits", T.BinaryType())])
#: what a pass finds in a document, in the order of the tuples of scan()
FOUND = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("hits", T.BinaryType()),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("longest", T.LongType()),
    T.StructField("longest_item", T.StringType()), T.StructField("longest_start", T.LongType()),
    T.StructField("item_row", T.LongType())])


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def word_hashes(distinct: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, distinct), np.uint64, len(distinct))


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Of each run of ``size`` words, from the words' hashes."""
    n = max(0, len(h) - size + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            out = out * FACTOR + h[j:j + n]
        return out ^ (out >> np.uint64(29))


@dataclass
class Windows:
    """The windows of one benchmark block: words as numbers, windows by hash; about 25 bytes a word."""

    vocabulary: list[bytes]     # distinct words
    flat: np.ndarray            # the items' words, by number
    first: np.ndarray           # of each item: its first word in ``flat``; the end of the last
    names: list[str]            # item ids
    rows: list[int]             # the items' rows in the benchmark
    hashes: dict[int, np.ndarray]       # by window length: ascending
    places: dict[int, np.ndarray]       # where in ``flat`` the window of each hash stands

    @classmethod
    def of(cls, items: list[tuple[int, str, bytes]], size: int) -> Windows:
        number: dict[bytes, int] = {}
        flat, first = array("i"), [0]
        for _, _, text in items:
            flat.extend(number.setdefault(w, len(number)) for w in words(text))
            first.append(len(flat))
        ids, starts = np.array(flat, np.int32), np.array(first, np.int64)
        count = np.diff(starts)
        h = word_hashes(list(number))[ids] if len(ids) else np.empty(0, np.uint64)
        hashes, places = {}, {}
        for n in np.unique(np.minimum(count[count > 0], size)).tolist():
            mine = np.flatnonzero((count >= n) if n == size else (count == n))
            begin = np.repeat(starts[mine], count[mine] - n + 1)
            step = np.cumsum(count[mine] - n + 1) - (count[mine] - n + 1)
            at = begin + np.arange(len(begin)) - np.repeat(step, count[mine] - n + 1)
            got = window_hashes(h, n)[at]
            order = np.argsort(got, kind="stable")
            hashes[n], places[n] = got[order], at[order].astype(np.int32)
        return cls(list(number), ids, starts, [name for _, name, _ in items], [row for row, _, _ in items], hashes, places)

    def met(self, h: np.ndarray, inside: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """By window length: places in ``flat`` of the windows whose hash a shard's words make, and the
        shard's places that make them. ``inside``: words from each place to the end of its text."""
        out = []
        for n, known in self.hashes.items():
            there = window_hashes(h, n)
            at = np.minimum(np.searchsorted(known, there), len(known) - 1)
            shard = np.flatnonzero((known[at] == there) & (inside[:len(there)] >= n))
            if len(shard):
                hit = np.unique(there[shard])
                lo, hi = np.searchsorted(known, hit), np.searchsorted(known, hit, side="right")
                out.append((n, np.concatenate([self.places[n][a:b] for a, b in zip(lo.tolist(), hi.tolist())]), shard))
        return out


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by the first ``depth`` values (or more) that follow them.

    Prefix doubling: sorted by one value, then two, four and so on. Each round sorts only
    the positions that still share a rank with others. The array ends with a value that
    occurs nowhere else.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    s = ids[order]
    new = np.ones(n, bool)
    new[1:] = s[1:] != s[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    k = 1
    while k < depth:
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        pos = order[slots]
        key = rank[pos] * (n + 1) + np.where(pos + k < n, rank[np.minimum(pos + k, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        order[slots] = pos[by]
        key = key[by]
        fresh = np.ones(len(slots), bool)
        fresh[1:] = key[1:] != key[:-1]
        new[slots] = fresh | new[slots]
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order[slots]] = first[slots]
        k *= 2
    return order


def search(ids: np.ndarray, order: np.ndarray, asked: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of all rows of ``asked`` at once: where their suffixes begin and end."""
    n, size = len(ids), asked.shape[1]

    def bound(after: bool) -> np.ndarray:
        lo, hi = np.zeros(len(asked), np.int64), np.full(len(asked), n, np.int64)
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            at = order[np.minimum(mid, n - 1)]
            less = np.zeros(len(asked), bool)       # the suffix comes before the window
            same = np.ones(len(asked), bool)
            for t in range(size):
                there = ids[np.minimum(at + t, n - 1)]
                live = same & (t < length)
                less |= live & (there < asked[:, t])
                same &= ~live | (there == asked[:, t])
            right = open_ & (less | (same if after else False))
            lo = np.where(right, mid + 1, lo)
            hi = np.where(open_ & ~right, mid, hi)
        return lo

    return bound(False), bound(True)


def scan(texts: list[bytes], q: Windows, size: int) -> list[tuple]:
    """Per text: words, hit words (bits), items, longest match (words, item, start, item's row).

    Benchmark windows whose hash no place of the shard has are not there; the others are looked
    for in a suffix array of the texts that hold such places.
    """
    number: dict[bytes, int] = {}
    flat = []
    for t in texts:
        w = words(t)
        flat.append(np.fromiter((number.setdefault(x, len(number)) for x in w), np.int64, len(w)))
    counts = [len(f) for f in flat]
    out = [(c, None, [], 0, None, None, None) for c in counts]
    if not number or not q.hashes:
        return out
    size_of = np.array(counts)
    every = np.concatenate(flat)
    owner = np.repeat(np.arange(len(texts)), size_of)
    inside = np.cumsum(size_of)[owner] - np.arange(len(every))
    h = word_hashes(list(number))[every]
    met = q.met(h, inside)
    if not met:
        return out
    held = _contents(q, met, number)
    if not held:
        return out
    listed = np.unique(owner[np.concatenate([shard for _, _, shard in met])]).tolist()      # the texts to look in
    zero = np.zeros(1, np.int64)     # ends every text: no match crosses it
    ids = np.concatenate([x for d in listed for x in (flat[d] + 1, zero)])
    starts = np.concatenate([[0], np.cumsum([counts[d] + 1 for d in listed])])
    order = suffix_array(ids, size)
    known = list(held)
    length = np.array([len(k) for k in known])
    asked = np.zeros((len(known), int(length.max())), np.int64)
    for row, k in enumerate(known):
        asked[row, :length[row]] = np.array(k) + 1
    lo, hi = search(ids, order, asked, length)
    found = np.flatnonzero(hi > lo)
    if not len(found):
        return out
    reps = hi[found] - lo[found]
    row = np.repeat(found, reps)
    at = order[np.repeat(lo[found], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)]
    doc = np.searchsorted(starts, at, side="right") - 1
    by = np.argsort(doc, kind="stable")
    row, at, doc = row[by], at[by], doc[by]
    for d in np.unique(doc).tolist():
        a, b = np.searchsorted(doc, d), np.searchsorted(doc, d, side="right")
        place, win, own = at[a:b] - starts[d], row[a:b], listed[d]
        mark = np.zeros(counts[own] + 1, np.int64)
        np.add.at(mark, place, 1)
        np.add.at(mark, place + length[win], -1)
        hit = np.cumsum(mark[:-1]) > 0
        # windows of one item on one diagonal, one after the other, are one verbatim match
        runs = sorted((i, p - k, p, int(length[w])) for p, w in zip(place.tolist(), win.tolist())
                      for i, k in held[known[w]])
        best, run = (0, None, None), None
        for i, diagonal, p, n in runs:
            if run and run[:2] == (i, diagonal) and p == run[3] + 1:
                run = (i, diagonal, run[2], p, n)
            else:
                run = (i, diagonal, p, p, n)
            if p + n - run[2] > best[0]:
                best = (p + n - run[2], i, run[2])
        items = {q.names[i] for i, *_ in runs}
        out[own] = (counts[own], zlib.compress(np.packbits(hit).tobytes()), sorted(items), best[0], q.names[best[1]], best[2], q.rows[best[1]])
    return out


def _contents(q: Windows, met: list[tuple[int, np.ndarray, np.ndarray]], number: dict[bytes, int]) -> dict[tuple, list[tuple[int, int]]]:
    """Distinct windows at these places, in the shard's numbers: (item, word position) of each holder.
    A window with a word that the shard does not have met only by its hash, and goes."""
    out: dict[tuple, list[tuple[int, int]]] = {}
    for n, places, _ in met:
        item = np.searchsorted(q.first, places, side="right") - 1
        for p, i in zip(places.tolist(), item.tolist()):
            key = tuple(number.get(q.vocabulary[w], -1) for w in q.flat[p:p + n].tolist())
            if -1 not in key:
                out.setdefault(key, []).append((i, p - int(q.first[i])))
    return out


def _bits(hits: bytes | None, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(hits), np.uint8), count=n) if hits else np.zeros(n, np.uint8)


def _merged(a: tuple, b: tuple) -> tuple:
    """Two blocks' findings for one text, in any order."""
    if a[1] is None or b[1] is None:
        return b if a[1] is None else a
    hit = _bits(a[1], a[0]) | _bits(b[1], a[0])
    first = min(a, b, key=lambda f: (-f[3], f[6]))
    return (a[0], zlib.compress(np.packbits(hit).tobytes()), sorted({*a[2], *b[2]}), *first[3:])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each run of rows of one document."""
    last = None
    for b in batches:
        done = []
        for row, *found in zip(*[c.to_pylist() for c in b.columns]):
            if last is not None and last[0] == row:
                last = (row, *_merged(last[1:], tuple(found)))
                continue
            if last is not None:
                done.append(last)
            last = (row, *found)
        yield _batch(done)
    if last is not None:
        yield _batch([last])


def _batch(found: list[tuple]) -> pa.RecordBatch:
    columns = zip(*found) if found else [()] * len(FOUND)
    return pa.RecordBatch.from_arrays([pa.array(list(c), common._arrow_type(f.dataType)) for c, f in zip(columns, FOUND)], FOUND.names)


def _result(rows: list[tuple]) -> list[list]:
    """The columns of RESULT."""
    return [[r[0] for r in rows], [int(_bits(r[1], r[0]).sum()) for r in rows], [r[2] for r in rows],
            [r[3] for r in rows], [r[4] for r in rows], [r[5] for r in rows], [r[1] for r in rows]]


def _finder(sent, size: int, shard_bytes: int):
    """The scan for one broadcast block."""
    def find(texts: pa.Array) -> list[tuple]:
        raw, found = common.text_bytes(texts), []
        for lo, hi in common.slices(raw, shard_bytes):
            found += scan(raw[lo:hi], sent.value, size)
        return found
    return find


def _listed(items: DataFrame) -> list[tuple[int, str, bytes]]:
    return [(r.row, r.item, r.text.encode()) for r in items.select("row", "item", "text").orderBy("row").collect()]


def _found_in_blocks(docs: DataFrame, items: DataFrame, n: int, size: int, shard_bytes: int, all_rows: bool) -> DataFrame:
    """FOUND for each row of ``docs`` (row, text; staged) and block with a hit, and with ``all_rows``
    at least one row for each document. Block after block: listed, broadcast, scanned for, dropped."""
    spark = docs.sparkSession
    # by row, so that copies of an item are dealt as well; sorted, so that a block is read from few files
    items = common.stage(items.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n))).sort("block"), "benchmark")
    path = shared_path(spark, "llm", "contaminated", unique=True)
    for i in range(n):
        sent = spark.sparkContext.broadcast(Windows.of(_listed(items.where(F.col("block") == i)), size))
        find, every = _finder(sent, size, shard_bytes), all_rows and i == 0

        def run(batches: Iterator[pa.RecordBatch], find=find, every=every) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield _batch([(row, *f) for row, f in zip(b.column(0).to_pylist(), find(b.column(1))) if every or f[1] is not None])

        docs.mapInArrow(run, FOUND).write.mode("append").parquet(path)
        sent.destroy(blocking=True)
    return spark.read.schema(FOUND).parquet(path)


def match(docs: DataFrame, benchmark: DataFrame, size: int = 10, text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", shard_bytes: int = SHARD_BYTES,
          block_bytes: int = BLOCK_BYTES, clean_only: bool = False) -> DataFrame:
    """``docs`` with the columns of RESULT, or with ``clean_only`` its rows without a match.

    Words are runs of digits, letters and non-ASCII characters after lower-casing A-Z. A
    window is ``size`` consecutive words of an item, or all words of a shorter one. Null
    texts have no words, null item ids are the empty string; items without words match nothing;
    rows sharing an item id are one item in ``items``; repeated documents are judged one by one.
    Columns of ``docs`` named like those of RESULT are replaced.
    ``longest`` and the columns after it name the longest verbatim match: its words, its item,
    the word it starts at. Ties go to the first item row, then the first place. Empty tables
    give empty or clean results.

    A benchmark over ``block_bytes`` runs its passes here and stages ``docs`` once.
    """
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"),
                             F.monotonically_increasing_id().alias("row"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    if not clean_only:
        if text_col in RESULT.names:        # the text stands in a column that is replaced
            docs, text_col = docs.withColumn("_dc_text", F.col(f"`{text_col}`")), "_dc_text"
        docs = docs.drop(*RESULT.names)
    text = F.col(f"`{text_col}`").cast("string")
    if n == 1:
        find = _finder(docs.sparkSession.sparkContext.broadcast(Windows.of(_listed(items), size)), size, shard_bytes)
        if clean_only:
            flag = T.StructType([T.StructField("hit", T.BooleanType())])
            return common.append_columns(docs, [text], lambda t: [[r[1] is not None for r in find(t)]], flag,
                                         keep=lambda hit: pc.invert(hit))
        return common.append_columns(docs, [text], lambda t: _result(find(t)), RESULT).drop("_dc_text")

    own = [F.col(f"`{c}`") for c in docs.columns if c != "_dc_text"]
    keyed = common.stage(docs.withColumn("_dc_row", F.monotonically_increasing_id()), "decontaminate")
    found = _found_in_blocks(keyed.select("_dc_row", text.alias("text")), items, n, size, shard_bytes, not clean_only)
    if clean_only:
        hit = found.select(F.col("row").alias("_dc_row"))
        return keyed.join(hit, "_dc_row", "left_anti").select(*own)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _merge(batches):
            got = _result([f[1:] for f in zip(*[c.to_pylist() for c in b.columns])])
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(g, common._arrow_type(f.dataType)) for g, f in zip(got, RESULT)]],
                                             merged.names)

    merged = T.StructType([T.StructField("_dc_row", T.LongType()), *[T.StructField(f"_dc_{f.name}", f.dataType) for f in RESULT]])
    # of one document: a row for each block it has a hit in
    whole = common.stage(found.repartition("row").sortWithinPartitions("row").mapInArrow(fill, merged), "matches")
    return keyed.join(whole, "_dc_row").select(*own, *[F.col(f"_dc_{f.name}").alias(f.name) for f in RESULT])


def sql(size: int = 10) -> str:
    """The query's columns over ``documents`` and ``benchmark`` in DuckDB SQL."""
    def cut(table: str, cols: str) -> str:
        return (f"SELECT {cols}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                rf"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table}")
    return f"""
WITH d AS ({cut("documents", "doc_id")}),
b AS ({cut("benchmark", "row_number() OVER () AS item, coalesce(item_id::VARCHAR, '') AS name")}),
bw AS (SELECT item, name, k, n, array_to_string(w[k:k + n - 1], ' ') AS win
       FROM (SELECT *, least({size}, len(w)) AS n, unnest(range(1, len(w) - least({size}, len(w)) + 2)) AS k FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT doc_id, p, n, item, name, k FROM dw JOIN bw USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM (SELECT DISTINCT doc_id, p, n FROM h)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS items FROM (SELECT DISTINCT doc_id, name FROM h) GROUP BY doc_id),
isl AS (SELECT *, p - row_number() OVER (PARTITION BY doc_id, item, p - k ORDER BY p) AS island FROM h),
run AS (SELECT doc_id, item, name, diagonal, island, min(p) - 1 AS start, count(*) + max(n) - 1 AS words
        FROM (SELECT *, p - k AS diagonal FROM isl) GROUP BY ALL),
top AS (SELECT doc_id, words AS longest, name AS longest_item, start AS longest_start FROM run
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY words DESC, item, diagonal, start) = 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(longest, 0) AS longest,
       coalesce(longest_item, '') AS longest_item, coalesce(longest_start, -1) AS longest_start
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN top USING (doc_id)"""
