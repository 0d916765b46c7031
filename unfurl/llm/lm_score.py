"""LM scoring by deleted interpolation: bigram, unigram and uniform estimates, mixed by context.

Maximum-likelihood estimates come from counts over all training documents. How much each
order is trusted depends on how often the context was seen: contexts fall into buckets by
the power of two of their count, and every bucket has mixture weights of its own, learned by
expectation-maximisation on one training fold held out of the counts (the "deleted" part).

One map pass deals documents into chunks of a few megabytes and writes each as one compressed
row: its texts as numbers of the chunk's own words, and the words' hashes. A chunk sends its
distinct words and word pairs, as sorted hashes with counts, to the tables that own ranges of
the hash space; a table adds up the counts and answers every chunk in the chunk's own order.
A word that is in every text is one key of each chunk, so none is hot, and equal rows lie in as
many chunks as they fill. The EM pass and the scoring pass join the answers with the chunks;
no text is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type
from xxhash import xxh64_intdigest

from . import common

END = 0                                     # number and hash of the token that ends (and begins) a text
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))     # odd constants that spread pair hashes


@dataclass(frozen=True)
class Model:
    """``folds``: documents by crc32 of the id; fold 0 is not learnt from, ``em_fold`` is held out of
    the counts that EM sees. ``alpha`` smooths the base score. ``chunk_bytes`` of text make a
    chunk, ``table_keys`` about as many keys a table."""

    folds: int = 10
    em_fold: int = 1
    alpha: float = 0.1
    rounds: int = 40
    chunk_bytes: int = 6 << 20
    table_keys: int = 1_000_000
    bins_per_decade: int = 10


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers, bytes of equal weight side by side, compressed."""
    wide = values.astype(np.uint32) if values.dtype != np.uint64 else values
    return zstandard.compress(wide.view(np.uint8).reshape(len(wide), wide.itemsize).T.tobytes(), 1)


def unpack(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(kind).ravel()


def number_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the texts as numbers (END behind each), tokens of each text, hashes of the numbers."""
    number: dict[bytes, int] = {}
    tokens, sizes = [], np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        w = t.lower().split()
        tokens.append(np.fromiter((number.setdefault(x, len(number) + 1) for x in w), np.uint32, len(w)))
        tokens.append(np.full(1, END, np.uint32))
        sizes[i] = len(w) + 1
    return np.concatenate(tokens), sizes, np.array([END, *[xxh64_intdigest(x) for x in number]], np.uint64)


class Chunk:
    """The tokens of a chunk's texts, its distinct words and pairs, and the order of their keys.

    Pair keys have 56 bits: among a hundred billion pairs that makes one in a million share a count.
    """

    def __init__(self, token: np.ndarray, sizes: np.ndarray, hashes: np.ndarray):
        self.token, self.sizes = token.astype(np.int64), sizes
        self.before = np.concatenate([np.zeros(1, np.int64), self.token[:-1]])   # every text follows an end
        pair, self.pair = np.unique(self.before * len(hashes) + self.token, return_inverse=True)
        first, second = hashes[pair // len(hashes)], hashes[pair % len(hashes)]
        with np.errstate(over="ignore"):
            mixed = (first * MIX[0] + (second ^ (second >> np.uint64(29)))) * MIX[1]
        self.keys = [hashes, (mixed ^ (mixed >> np.uint64(31))) >> np.uint64(8)]
        self.order = [np.argsort(k, kind="stable") for k in self.keys]

    @classmethod
    def of(cls, row: dict) -> Chunk:
        return cls(unpack(row["tokens"], np.uint32), unpack(row["sizes"], np.uint32).astype(np.int64), unpack(row["hashes"], np.uint64))

    def counts(self, weight: np.ndarray) -> list[np.ndarray]:
        """Occurrences of words and pairs in the texts of weight 1."""
        w = np.repeat(weight, self.sizes)
        return [np.bincount(self.token, w, len(self.keys[0])).astype(np.uint64),
                np.bincount(self.pair, w, len(self.keys[1])).astype(np.uint64)]

    def answered(self, answers: list[tuple[int, bytes]], tables: int) -> list[np.ndarray]:
        """Totals of words and pairs, from (table, packed totals) in key order."""
        out = []
        for kind in (0, 1):
            got = [unpack(a, np.uint64) for t, a in sorted(answers) if t // tables == kind]
            total = np.empty(len(self.keys[kind]), np.float64)
            total[self.order[kind]] = np.concatenate(got)
            out.append(total)
        return out


CHUNK = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("em", T.BooleanType()), T.StructField("bytes", T.LongType()),
                      T.StructField("tokens", T.BinaryType()), T.StructField("sizes", T.BinaryType()), T.StructField("hashes", T.BinaryType()),
                      T.StructField("fold", T.ArrayType(T.IntegerType()))])


def encode_chunks(src: DataFrame, how: Model) -> DataFrame:
    """``src`` (doc, text, fold) as one staged row per chunk; documents of the EM fold have chunks of their own."""
    schema = T.StructType([*CHUNK.fields, T.StructField("doc", T.ArrayType(src.schema["doc"].dataType))])
    arrow = [pa.field(f.name, common._arrow_type(f.dataType)) for f in schema.fields]

    def row(number: int, em: bool, docs: list, texts: list[bytes], folds: list[int]) -> pa.RecordBatch:
        token, sizes, hashes = number_words(texts)
        values = [number, em, sum(map(len, texts)), pack(token), pack(sizes.astype(np.uint32)), pack(hashes), folds, docs]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow)], [f.name for f in arrow])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        held = {em: ([], [], []) for em in (False, True)}
        size = {False: 0, True: 0}
        for b in batches:
            for doc, text, fold in zip(b.column(0).to_pylist(), common.text_bytes(b.column(1)), b.column(2).to_pylist()):
                em = fold == how.em_fold
                if held[em][0] and size[em] + len(text) > how.chunk_bytes:
                    yield row(number, em, *held[em])
                    number, held[em], size[em] = number + 1, ([], [], []), 0
                for column, value in zip(held[em], (doc, text, fold)):
                    column.append(value)
                size[em] += len(text)
        for em in (False, True):
            if held[em][0]:
                yield row(number, em, *held[em])
                number += 1

    return common.stage(src.mapInArrow(run, schema), "lm_chunks")


def _table_of(keys: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The table that owns each of the sorted keys."""
    return ((keys >> np.uint64(bits - 32)) * np.uint64(tables) >> np.uint64(32)).astype(np.int64)


def _send(tables: int):
    """A chunk's keys and counts, one row per table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                chunk, rows = Chunk.of(row), []
                for kind, count in enumerate(chunk.counts((np.array(row["fold"]) != 0).astype(float))):
                    order = chunk.order[kind]
                    keys, n = chunk.keys[kind][order], count[order]
                    owner = _table_of(keys, (64, 56)[kind], tables)
                    for t in np.unique(owner).tolist():
                        lo, hi = np.searchsorted(owner, t), np.searchsorted(owner, t, side="right")
                        gaps = np.concatenate([keys[lo:lo + 1], np.diff(keys[lo:hi])])
                        rows.append((kind * tables + t, pack(gaps), pack(n[lo:hi])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]] * len(rows), pa.int64()), pa.array([row["em"]] * len(rows), pa.bool_()),
                     pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2)]],
                    ["chunk", "held", "owner", "keys", "n"])
    return run


def _add_up(key, asked):
    """Totals of a table's keys, for each chunk that asked, in the order it asked."""
    chunks, is_em = asked["chunk"].to_pylist(), asked["held"].to_pylist()
    keys = [np.cumsum(unpack(k, np.uint64), dtype=np.uint64) for k in asked["keys"].to_pylist()]
    n = [unpack(x, np.uint64) for x in asked["n"].to_pylist()]
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    held = np.repeat(is_em, [len(k) for k in keys])
    each = np.concatenate(n).astype(np.int64)
    total = [np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)]
    for which, side in zip((~held, held), total):       # whole numbers: exact however large
        np.add.at(side, at[which], each[which])
    kept, em = total
    ends = np.cumsum([len(k) for k in keys])
    mine = [at[e - len(k):e] for e, k in zip(ends, keys)]
    once = [0] * (len(chunks) - 1)      # of the whole table, told once
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "held": pa.array(is_em, pa.bool_()), "owner": asked["owner"],
                     "kept": pa.array([pack(kept[m].astype(np.uint64)) for m in mine], pa.binary()),
                     "em": pa.array([pack(em[m].astype(np.uint64)) for m in mine], pa.binary()),
                     "n_kept": pa.array([int(kept.sum()), *once], pa.int64()), "n_em": pa.array([int(em.sum()), *once], pa.int64()),
                     "n_types": pa.array([int((kept + em > 0).sum()), *once], pa.int64())})


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else one more than the power of two of the count."""
    return np.where(count > 0, np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, 0)


def estimates(chunk: Chunk, word: np.ndarray, pair: np.ndarray, n: float, types: float) -> tuple[np.ndarray, np.ndarray]:
    """Context bucket, and the bigram, unigram and uniform estimate of each token."""
    context = word[chunk.before]
    return context_bucket(context), np.stack([
        np.where(context > 0, pair[chunk.pair] / np.maximum(context, 1), 0.0),
        word[chunk.token] / max(n, 1.0), np.full(len(chunk.token), 1.0 / (types + 1.0))])


def learn_weights(cells: list[tuple[int, float, float, float, int]], rounds: int, buckets: int = 64) -> np.ndarray:
    """Mixture weights (bucket x 3) by EM; cells: bucket, the three estimates, tokens.

    A bucket without held-out tokens gets the weights of all tokens together.
    """
    weights = np.tile([0.4, 0.4, 0.2], (buckets, 1))
    if not cells:
        return weights
    b = np.array([c[0] for c in cells])
    p = np.array([c[1:4] for c in cells])
    n = np.array([c[4] for c in cells], float)
    whole = np.full(3, 1 / 3)
    for _ in range(rounds):
        share = p * whole
        whole = ((share / share.sum(axis=1, keepdims=True)) * n[:, None]).sum(axis=0) / n.sum()
        share = p * weights[b]
        share = share / share.sum(axis=1, keepdims=True) * n[:, None]
        for i in np.unique(b):
            weights[i] = share[b == i].sum(axis=0) / n[b == i].sum()
    weights[np.setdiff1d(np.arange(buckets), b)] = whole
    # no weight reaches 0: an unseen word has the uniform estimate only
    return (weights + 1e-6) / (weights + 1e-6).sum(axis=1, keepdims=True)


def lm_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Model = Model()) -> DataFrame:
    """doc, held_out, n_tokens, n_known, train_tokens, base_score, score per row of ``docs``.

    Tokens are the white-space separated words, A-Z lower-cased, and one end. A null or empty
    text is its end token; a null id is the empty string when folds are dealt; repeated rows
    count as often as they occur and get equal scores. Without training documents all counts
    are 0 and the uniform estimate is left. An empty table gives no rows.
    """
    common.bound_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).alias("doc"), text.alias("text"),
                      F.pmod(F.crc32(ident), F.lit(how.folds)).cast("int").alias("fold"))
    chunks = encode_chunks(src, how)
    size = chunks.agg(F.sum("bytes")).first()[0] or 0
    tables = max(1, math.ceil(size / 9 / how.table_keys))     # about one new pair in nine bytes
    sent = chunks.mapInArrow(_send(tables), "chunk long, held boolean, owner int, keys binary, n binary")
    answers = common.stage(sent.groupBy("owner").applyInArrow(
        _add_up, "chunk long, held boolean, owner int, kept binary, em binary, n_kept long, n_em long, n_types long"), "lm_totals")
    told = answers.where(F.col("owner") < tables).agg(F.sum("n_kept"), F.sum("n_em"), F.sum("n_types")).first()
    n_kept, n_em, types = (float(x or 0) for x in told)

    fold = chunks.where("em").groupBy("chunk").cogroup(answers.where("held").select("chunk", "owner", "kept").groupBy("chunk"))
    cells = (fold.applyInArrow(_cells(tables, n_kept, types, how.bins_per_decade),
                               "bucket int, b2 int, b1 int, l2 double, l1 double, n long")
             .groupBy("bucket", "b2", "b1").agg(F.sum("l2").alias("l2"), F.sum("l1").alias("l1"), F.sum("n").alias("n")))
    uniform = 1.0 / (types + 1.0)
    # at most context buckets x bins x bins rows, whatever the input
    learnt = learn_weights([(r.bucket, 10 ** (r.l2 / r.n) if r.b2 >= 0 else 0.0, 10 ** (r.l1 / r.n) if r.b1 >= 0 else 0.0, uniform, r.n)
                            for r in cells.collect()], how.rounds)

    return chunks.groupBy("chunk").cogroup(answers.select("chunk", "owner", "kept", "em").groupBy("chunk")).applyInArrow(
        _score(tables, n_kept + n_em, types, learnt, how.alpha, common._arrow_type(src.schema["doc"].dataType)),
        T.StructType([src.schema["doc"], *[T.StructField(k, from_arrow_type(t)) for k, t in OUT.items()]]))


def _cells(tables: int, n: float, types: float, per_decade: int):
    """Held-out tokens by context bucket and the size of their estimates."""
    def run(rows, answers):
        chunk = Chunk.of(rows.to_pylist()[0])
        word, pair = chunk.answered(list(zip(answers["owner"].to_pylist(), answers["kept"].to_pylist())), tables)
        bucket, p = estimates(chunk, word, pair, n, types)
        with np.errstate(divide="ignore"):
            logs = np.log10(p[:2])
        none = ~np.isfinite(logs)
        logs[none] = 0.0
        # bins count from the uniform estimate; no training count lies far below it
        bins = np.where(none, -1, np.clip(np.floor((logs + 20) * per_decade), 0, 20 * per_decade)).astype(np.int64)
        size = 20 * per_decade + 2
        cell, at = np.unique((bucket * size + bins[0] + 1) * size + bins[1] + 1, return_inverse=True)
        return pa.table({"bucket": pa.array(cell // size // size, pa.int32()), "b2": pa.array(cell // size % size - 1, pa.int32()),
                         "b1": pa.array(cell % size - 1, pa.int32()), "l2": np.bincount(at, logs[0]), "l1": np.bincount(at, logs[1]),
                         "n": np.bincount(at)})
    return run


def _score(tables: int, n: float, types: float, weights: np.ndarray, alpha: float, doc: pa.DataType):
    def run(rows, answers):
        row = rows.to_pylist()[0]
        chunk = Chunk.of(row)
        owner = answers["owner"].to_pylist()
        kept = chunk.answered(list(zip(owner, answers["kept"].to_pylist())), tables)
        em = chunk.answered(list(zip(owner, answers["em"].to_pylist())), tables)
        word, pair = kept[0] + em[0], kept[1] + em[1]
        bucket, p = estimates(chunk, word, pair, n, types)
        mixed = (weights[bucket].T * p).sum(axis=0)
        base = np.log10((word[chunk.token] + alpha) / (n + alpha * (types + 1.0)))
        starts = np.cumsum(chunk.sizes) - chunk.sizes
        cols = {"held_out": np.array(row["fold"]) == 0, "n_tokens": chunk.sizes,
                "n_known": np.add.reduceat((word[chunk.token] > 0).astype(np.int64), starts),
                "train_tokens": np.full(len(chunk.sizes), int(n), np.int64),
                "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(np.log10(mixed), starts)}
        return pa.table({"doc": pa.array(row["doc"], doc), **{k: pa.array(v, OUT[k]) for k, v in cols.items()}})
    return run


OUT = {"held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "train_tokens": pa.int64(),
       "base_score": pa.float64(), "score": pa.float64()}
