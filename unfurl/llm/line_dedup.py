"""Line dedup: lines that many documents share stay in one of them only.

Method: 128-bit hashes of line keys are range-partitioned with a secondary sort by
document (largest first) and position; one streaming pass over each sorted partition
meets the occurrence that stays first and drops the ones after it. The operator returns
one compressed keep bitmap per touched document, not text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SPACE = b" \t\n\x0b\x0c\r"
LINES = T.StructType([T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType()),
                      T.StructField("doc", T.LongType()), T.StructField("ver", T.LongType()),
                      T.StructField("pos", T.IntegerType()), T.StructField("n_lines", T.IntegerType())])
DROPS = T.StructType([LINES["doc"], LINES["ver"], LINES["pos"], LINES["n_lines"]])


def version(text: str | Column = "text") -> Column:
    """Tells rows with one id but different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 20) -> DataFrame:
    """One row per line whose key has ``min_chars`` code points or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = common.text_bytes(b.column(2))
            ids, vers = b.column(0).to_pylist(), b.column(1).to_pylist()
            hashes, doc, ver, pos, size = [], [], [], [], []
            for d, v, t in zip(ids, vers, texts):
                lines = t.split(b"\n")
                for i, line in enumerate(lines):
                    if len(line) < min_chars:
                        continue
                    key = line.strip(SPACE).lower()
                    # a code point takes 1 to 4 bytes
                    if len(key) >= min_chars and (len(key) >= 4 * min_chars
                                                  or len(key.decode("utf-8", "replace")) >= min_chars):
                        hashes.append(xxhash.xxh128_digest(key))
                        doc.append(d)
                        ver.append(v)
                        pos.append(i)
                        size.append(len(lines))
            if hashes:
                pair = np.frombuffer(b"".join(hashes), dtype=">i8").astype(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(pair[:, 0])), pa.array(np.ascontiguousarray(pair[:, 1])),
                     pa.array(doc, pa.int64()), pa.array(ver, pa.int64()),
                     pa.array(pos, pa.int32()), pa.array(size, pa.int32())], LINES.names)

    src = docs.select(F.col(id_col).cast("long").alias("doc"), version(text_col).alias("ver"),
                      F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, LINES)


def _runs(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hi, lo, doc (nulls as -1) and doc-is-null of a sorted batch."""
    hi, lo = b.column(0).to_numpy(), b.column(1).to_numpy()
    none = b.column(2).is_null().to_numpy(zero_copy_only=False)
    return hi, lo, b.column(2).fill_null(-1).to_numpy(), none


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct documents of the first and the last key of a sorted partition."""
    first = last = None     # [hi, lo, documents, doc, doc is null]
    for b in batches:
        hi, lo, doc, none = _runs(b)
        if not len(hi):
            continue
        new_key = np.ones(len(hi), bool)
        new_key[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        new_doc = new_key.copy()
        new_doc[1:] |= (doc[1:] != doc[:-1]) | (none[1:] != none[:-1])
        starts = np.flatnonzero(new_key)
        counts = np.add.reduceat(new_doc.astype(np.int64), starts)
        for s, c, e in ((starts[0], counts[0], starts[1] if len(starts) > 1 else len(hi)),
                        *([(starts[-1], counts[-1], len(hi))] if len(starts) > 1 else [])):
            key = (int(hi[s]), int(lo[s]))
            if last is not None and last[:2] == key:
                same = last[3] == doc[s] and last[4] == none[s]
                last = (*key, last[2] + int(c) - int(same), doc[e - 1], none[e - 1])
                if first[:2] == key:
                    first = last
            else:
                last = (*key, int(c), doc[e - 1], none[e - 1])
                first = first or last
    if first is not None:
        part = TaskContext.get().partitionId()
        rows = [first] if first[:2] == last[:2] else [first, last]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([part] * len(rows), pa.int32())],
            ["hi", "lo", "docs", "part"])


def repeated_lines(lines: DataFrame, min_docs: int = 3) -> DataFrame:
    """The occurrences to drop: all but those in the largest document, of keys in ``min_docs``.

    The sort key holds the document too, so a key with a third of all rows is spread over
    many partitions. What its partitions must know of each other is two rows a partition,
    the only thing the driver gets.
    """
    order = [F.col("hi"), F.col("lo"), F.col("doc").desc_nulls_last()]
    done = (lines.repartitionByRange(*order)
            .sortWithinPartitions(*order, F.col("ver"), F.col("pos")).checkpoint())
    edges = done.mapInArrow(_edges, "hi long, lo long, docs long, part int").collect()
    total: dict[tuple[int, int], int] = {}
    start: dict[tuple[int, int], int] = {}
    for r in edges:
        key = (r.hi, r.lo)
        total[key] = total.get(key, 0) + r.docs
        start[key] = min(start.get(key, r.part), r.part)
    split = {}      # the first key of a partition, if it began in an earlier one or goes on
    for r in edges:
        split.setdefault(r.part, {})[(r.hi, r.lo)] = (total[(r.hi, r.lo)], start[(r.hi, r.lo)])

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        known = split.get(part, {})
        held: list[pa.RecordBatch] = []     # an unfinished run, while fewer than min_docs are met
        key, n_docs, keeper, last = None, 0, None, None

        for b in batches:
            hi, lo, doc, none = _runs(b)
            if not len(hi):
                continue
            new_key = np.ones(len(hi), bool)
            new_key[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
            starts = np.append(np.flatnonzero(new_key), len(hi))
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                here = (int(hi[s]), int(lo[s]))
                d, z = doc[s:e], none[s:e]
                if here != key:
                    key, n_docs, held, last = here, 0, [], None
                    # the largest document holding the key, unless an earlier partition has it
                    began = known.get(here, (0, part))[1]
                    keeper = (d[0], z[0]) if began == part else None
                fresh = np.ones(e - s, bool)
                fresh[1:] = (d[1:] != d[:-1]) | (z[1:] != z[:-1])
                if last is not None and last == (d[0], z[0]):
                    fresh[0] = False
                n_docs += int(fresh.sum())
                last = (d[-1], z[-1])
                if keeper is not None:
                    gone = np.flatnonzero((d != keeper[0]) | (z != keeper[1])) + s
                else:
                    gone = np.arange(s, e)
                if len(gone):
                    held.append(b.select([2, 3, 4, 5]).take(pa.array(gone)))
                if max(n_docs, known.get(here, (0, 0))[0]) >= min_docs:
                    yield from held
                    held = []

    return done.mapInArrow(drop, DROPS)


def keep_bitmaps(drops: DataFrame) -> DataFrame:
    """doc, ver, n_lines, n_dropped, keep: zlib-compressed bits, the first line highest."""
    grouped = drops.groupBy("doc", "ver").agg(F.max("n_lines").alias("n_lines"),
                                              F.collect_set("pos").alias("pos"))

    def pack(batches):
        for b in batches:
            out, count = [], []
            for n, pos in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                bits = np.ones(n, np.uint8)
                bits[pos] = 0
                out.append(zlib.compress(np.packbits(bits).tobytes()))
                count.append(len(pos))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(count, pa.int32()), pa.array(out, pa.binary())],
                ["doc", "ver", "n_lines", "n_dropped", "keep"])

    return grouped.mapInArrow(pack, "doc long, ver long, n_lines int, n_dropped int, keep binary")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Keep bitmaps of the documents that lose lines: doc, ver, n_lines, n_dropped, keep.

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of
    ``min_chars`` code points in ``min_docs`` documents or more lose all their lines except
    in the largest id. Rows with one id are one document (``ver`` tells their texts apart);
    a null id is one document, smaller than all others. Null and empty texts hold one empty
    line, which is too short. Lines that occur twice in the document that keeps them stay.
    Documents without a row here keep every line.
    """
    return keep_bitmaps(repeated_lines(line_hashes(docs, id_col, text_col, min_chars), min_docs))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, out: T.StructType, fn, inputs: list,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Join ``bitmaps`` to ``docs`` and append the columns ``fn(keep, texts, *inputs)`` gives."""
    maps = bitmaps.select(F.col("doc").alias("_ld_doc"), F.col("ver").alias("_ld_ver"), F.col("keep").alias("_ld_keep"))
    joined = docs.join(maps, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("_ld_doc"))
                       & (version(text_col) == F.col("_ld_ver")), "left")
    return common.append_columns(joined, [F.col("_ld_keep"), F.col(text_col).cast("string"), *inputs], fn, out)


def kept_lines(keep: bytes | None, text: bytes) -> tuple[bytes, int, int]:
    """What stays of a text, its lines before, and the lines dropped."""
    if keep is None:
        return text, text.count(b"\n") + 1, 0
    lines = text.split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    stay = [line for line, k in zip(lines, bits.tolist()) if k]
    return b"\n".join(stay), len(lines), len(lines) - len(stay)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        chars_col: str = "n_chars", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the repeated lines taken out of the texts and ``chars_col`` counted anew.

    No row goes: a document whose lines all go stays with an empty text; a null text stays
    null. Columns and their types are those of ``docs``.
    """
    def rewrite(keep, texts):
        raw = common.text_bytes(texts)
        none = texts.is_null().to_pylist()
        out = [None if z else kept_lines(k, t)[0].decode("utf-8", "replace")
               for k, t, z in zip(keep.to_pylist(), raw, none)]
        return [out]

    bitmaps = common.stage(line_dedup(docs, id_col, text_col, min_chars, min_docs), "bitmaps")
    new = apply_bitmaps(docs, bitmaps, T.StructType([T.StructField("_ld_text", T.StringType())]), rewrite, [],
                        id_col, text_col)
    cols = {text_col: F.col("_ld_text")}
    if chars_col in docs.columns:
        cols[chars_col] = F.length("_ld_text").cast(docs.schema[chars_col].dataType)
    return new.select(*[cols.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def sql(min_chars: int = 20, min_docs: int = 3) -> str:
    """Lines before and dropped, and the digest of what stays, over ``documents`` in DuckDB SQL."""
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH l AS (SELECT doc_id, i, ln[i] AS line, translate(trim(ln[i], {blanks}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
           FROM (SELECT doc_id, ln, unnest(range(1, len(ln) + 1)) AS i
                 FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ln FROM documents))),
f AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= {min_chars} GROUP BY k HAVING count(DISTINCT doc_id) >= {min_docs}),
j AS (SELECT l.*, f.k IS NOT NULL AND doc_id <> keeper AS gone FROM l LEFT JOIN f ON f.k = l.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""
