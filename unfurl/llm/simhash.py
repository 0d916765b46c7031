"""SimHash near-duplicates: fingerprints, links at a few differing bits, components.

Method: a fingerprint is cut into so few segments that two linked fingerprints differ by at
most one bit in one of them. Every segment is indexed once per bit with that bit left out
(a wildcard); an equality join on these variants meets every linked pair, and the whole
fingerprints are then compared. Equal fingerprints are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from . import common

BITS = 64


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits over the XXH64 of all word shingles; 0 without words."""
    w = text.lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) < shingle:
        return xxh64_intdigest(joined, seed)
    size = np.fromiter(map(len, w), np.int64, len(w))
    end = np.cumsum(size + 1) - 1
    begin = (end - size)[:len(w) - shingle + 1].tolist()
    counts, n = np.zeros(BITS, np.int64), len(begin)
    stop = end[shingle - 1:].tolist()
    for lo in range(0, n, 1 << 16):     # bounds the memory of a very long text
        h = np.array([xxh64_intdigest(joined[a:b], seed)
                      for a, b in zip(begin[lo:lo + (1 << 16)], stop[lo:lo + (1 << 16)])], dtype=">u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc, fp (the 64 bits as a signed long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = np.array([fingerprint(t, shingle) for t in common.text_bytes(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(f.view(np.int64))], ["doc", "fp"])

    common.bound_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc long, fp long")


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >= 1 << (BITS - 1) else bits


def _variants(segments: list[list[int]]) -> Column:
    """One row per segment and bit of it: the segment's number and its value without the bit."""
    made = []
    for i, seg in enumerate(segments):
        mask = sum(1 << x for x in seg)
        for bit in seg:
            value = F.col("fp").bitwiseAND(F.lit(_signed(mask & ~(1 << bit))))
            made.append(F.struct(F.lit(i).alias("seg"), F.xxhash64("k", F.lit(i * BITS + bit), value).alias("k")))
    return F.explode(F.array(*made))


def links(fps: DataFrame, distance: int = 3, bucket: int = 2048) -> DataFrame:
    """Edges a, b between fingerprints (``fps``: distinct longs fp) that span all links.

    Members of a bucket (one wildcard variant) are compared with each other in one sorted
    stream, and a spanning forest of their links comes out, not all pairs. The members of a
    bucket with more than ``bucket`` fingerprints are cut anew: they agree on one segment
    but for a bit, so their other bits are segmented and indexed in the same way. The third
    cut of 64 bits leaves 11 that may differ, so its buckets cannot be larger than 2048.
    Nothing is dropped.
    """
    n, found, met = max(1, distance // 2 + 1), [], 0     # of n segments one differs by at most one bit
    total = fps.count()
    # a fingerprint becomes 64 rows and more: dealt to all tasks first, by a number that is kept
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    todo = [(list(range(BITS)), fps.select("fp", F.lit(0).cast("long").alias("k")))]
    while todo:
        bits, keyed = todo.pop()
        segments = [bits[i * len(bits) // n:(i + 1) * len(bits) // n] for i in range(n)]
        last = len(bits) <= BITS // n ** 2 or n == 1
        var = keyed.select("fp", _variants(segments).alias("v")).select("fp", "v.seg", "v.k")
        sizes = var.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        # Spark takes the variants for as small as the fingerprints they are made of, and would broadcast them
        members = common.stage(common.fewer_tasks(var.hint("merge").join(sizes.hint("merge"), "k"), total * len(bits)), "variants")
        near = (members if last else members.where(F.col("n") <= bucket)).select("k", "fp")
        compared = near.repartition("k").sortWithinPartitions("k", "fp").mapInArrow(_compare(distance), "a long, b long")
        rows = near.count()
        found.append(common.fewer_tasks(compared, rows))
        met += rows
        if not last:
            hot = members.where(F.col("n") > bucket).agg(F.collect_set("seg").alias("segs")).first().segs
            todo += [([x for x in bits if x not in segments[i]],
                      members.where((F.col("n") > bucket) & (F.col("seg") == i)).select("fp", "k")) for i in hot]
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return common.fewer_tasks(out.distinct(), met)     # a member has one edge at most: it is met once


def _compare(distance: int):
    """Spanning edges of the links inside each run of equal keys of a sorted stream."""
    def forest(fp: np.ndarray) -> list[tuple[int, int]]:
        left, edges = fp, []
        while len(left):
            seeds, left = [left[0]], left[1:]
            while seeds and len(left):
                s = seeds.pop()
                near = np.bitwise_count(left ^ s) <= distance
                hit = left[near]
                edges += [(int(s), int(x)) for x in hit]
                seeds += list(hit)
                left = left[~near]
        return edges

    def emit(k: np.ndarray, fp: np.ndarray):
        """Whole runs only."""
        new = np.ones(len(fp), bool)
        new[1:] = k[1:] != k[:-1]
        starts = np.flatnonzero(new)
        size = np.diff(np.append(starts, len(fp)))
        two = starts[size == 2]
        ok = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= distance] if len(two) else two
        edges = list(zip(fp[ok].tolist(), fp[ok + 1].tolist()))
        for s, n in zip(starts[size > 2].tolist(), size[size > 2].tolist()):
            edges += forest(fp[s:s + n])
        pair = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for b in batches:
            k = np.concatenate([k, b.column(0).to_numpy()])
            fp = np.concatenate([fp, b.column(1).to_numpy().view(np.uint64)])
            if not len(fp):
                continue
            cut = int(np.searchsorted(k, k[-1]))    # the last run may go on
            if cut:
                yield emit(k[:cut], fp[:cut])
                k, fp = k[cut:], fp[cut:]
        if len(fp):
            yield emit(k, fp)

    return run


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, distance: int = 3) -> DataFrame:
    """doc, fp, component (smallest id reachable over links), one row per document row.

    Null and empty texts have fingerprint 0 and are linked like any other. Rows with one id
    are all nodes; a null id never names a component, and a component of null ids only has
    none (null). An empty table gives no rows.
    """
    fps = common.stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    rows = fps.count()
    least = common.stage(common.fewer_tasks(fps.groupBy("fp").agg(F.min("doc").alias("doc")), rows), "distinct_fp")
    roots = common.components(common.stage(links(least.select("fp"), distance), "links"))
    rooted = (least.join(roots, least["fp"] == roots["node"], "left")
              .select("fp", "doc", F.coalesce("root", "fp").alias("root")))
    small = rooted.groupBy("root").agg(F.min("doc").alias("component"))
    named = rooted.join(small, "root").select(F.col("fp").alias("fp2"), "component")
    return common.fewer_tasks(fps.join(named, F.col("fp") == F.col("fp2")).select("doc", "fp", "component"), rows)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    Rows that share that id are one document and all stay; rows with a null id stay.
    """
    found = simhash_components(docs, id_col, text_col, shingle, distance)
    gone = common.stage(found.where("doc <> component").select(F.col("doc").alias("_sh_doc")).distinct(), "near_copies")
    return docs.join(gone, F.col(f"`{id_col}`").cast("long") == F.col("_sh_doc"), "left_anti")
