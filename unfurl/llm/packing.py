"""Best-fit packing of tokenized documents into sequences under several capacities.

Every task tokenizes its documents and packs their pieces itself, a bounded window of
pieces at a time: longest first, into the open sequence that fits best. A sequence has three
capacities (tokens, documents, attention cost: the sum of squared piece lengths); among the
sequences that can take a piece under all of them, the smallest weighted norm of what is
left over, or the largest weighted dot product of need and room, decides. No shuffle; a
window leaves at most a few sequences partly filled.
"""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

END = 0
PIECES = T.StructType([
    T.StructField("doc", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


class _Chunks(dict):
    """Token ids of chunks, as bytes; ``before`` stands in front of every chunk when it is encoded."""

    def __init__(self, encode: Callable[[str], list[int]], before: str, limit: int):
        self.encode, self.before, self.limit = encode, before, limit

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        got = self[chunk] = array("I", self.encode(self.before + chunk)).tobytes()
        return got


class ByteLevelTokenizer:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    A byte-level vocabulary splits a text at a single blank between non-blanks whatever
    surrounds it, so a text is cut there and the ids of each chunk are looked up in a cache of
    at most ``cache`` chunks. Texts where a run of white space would be cut apart go to the
    tokenizer whole. Chunks not met before are encoded by the same vocabulary as ranks, which
    gives the same ids much faster, where the file's merges are in the order of the ids; else by
    the tokenizer itself.
    """

    def __init__(self, path: str, cache: int = 150_000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True     # their strings in a text are ordinary text
        encode = _ranked(path) or (lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids)
        self.first, self.rest = _Chunks(encode, "", cache // 10), _Chunks(encode, " ", cache)

    def whole(self, texts: list[str]) -> list[bytes]:
        """By the tokenizer alone."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        odd = [i for i, t in enumerate(texts) if "  " in t or t[-1:].isspace()]
        out: list[bytes] = [b""] * len(texts)
        for i, ids in zip(odd, self.whole([texts[i] for i in odd])):
            out[i] = ids
        skip, look = set(odd), self.rest.__getitem__
        for i, t in enumerate(texts):
            if i not in skip and t:
                first, *rest = t.split(" ")
                out[i] = (self.first[first] if first else b"") + b"".join(map(look, rest))
        return out


#: fixed value: how byte-level vocabularies of this kind cut a text before merging
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _ranked(path: str) -> Callable[[str], list[int]] | None:
    """Encoder over the file's tokens as ranks; None if it is no such vocabulary."""
    import tiktoken
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" \
            or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return None
    vocab = model["vocab"]
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])):
        return None
    # a printable character stands for each byte: its own where it has one, else from 256 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in special}
    return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@dataclass(frozen=True)
class Capacity:
    """Limits of a sequence and how the room left in each dimension is weighed."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "residual"      # or "dot"


def cut(length: int, size: int) -> list[int]:
    """Lengths of a document's pieces; only the first may be shorter than ``size``."""
    if length <= size:
        return [length]
    return ([length % size] if length % size else []) + [size] * (length // size)


def best_fit(lengths: list[int], cap: Capacity) -> list[tuple[int, int]]:
    """Sequence and offset of each piece. Ties: the sequence opened first."""
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    wt, wd, wa = (w / c ** 2 for w, c in zip(cap.weights, (cap.tokens, cap.documents, cap.attention)))
    dt, dd, da = (w / c ** 2 for w, c in zip(cap.weights, (cap.tokens, cap.documents, cap.attention)))
    room: dict[int, list[tuple[int, int, int]]] = {}    # by free tokens: (documents, attention, sequence)
    free: list[int] = []                                # the keys of room, ascending
    opened = 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        cost = n * n
        best = None
        keys = range(bisect_left(free, n), len(free))
        for x in keys if cap.rule == "residual" else reversed(keys):
            t = free[x]
            if best is not None and cap.rule == "residual" and wt * (t - n) ** 2 >= best[0]:
                break   # fuller sequences only get worse
            if best is not None and cap.rule == "dot" and dt * t * n + dd * cap.documents + da * cost * cap.attention <= -best[0]:
                break
            for docs, att, seq in room[t]:
                if docs < 1 or att < cost:
                    continue
                if cap.rule == "residual":
                    score = wt * (t - n) ** 2 + wd * (docs - 1) ** 2 + wa * (att - cost) ** 2
                else:
                    score = -(dt * t * n + dd * docs + da * att * cost)
                if best is None or (score, seq) < best[:2]:
                    best = (score, seq, t, docs, att)
        if best is None:
            seq, t, docs, att = opened, cap.tokens, cap.documents, cap.attention
            opened += 1
        else:
            _, seq, t, docs, att = best
            room[t].remove((docs, att, seq))
            if not room[t]:
                del room[t]
                free.pop(bisect_left(free, t))
        out[i] = (seq, cap.tokens - t)
        if t > n and docs > 1:
            if t - n not in room:
                room[t - n] = []
                insort(free, t - n)
            room[t - n].append((docs - 1, att - cost, seq))
    return out


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         cap: Capacity = Capacity(), window: int = 16_384) -> DataFrame:
    """One row per piece: doc, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and the end id 0. One longer than the token capacity is cut
    into pieces of that many tokens, the first of which may be shorter; no other is cut. A null
    text is an empty one (the end id only); null ids and repeated rows are packed like any
    other. ``window`` bounds the pieces a task holds; sequences are not shared by windows or
    tasks. A piece whose attention cost alone is over the limit gets a sequence of its own.
    Sequence numbers are unique, not consecutive. An empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer_path)
        base, held = TaskContext.get().partitionId() << 40, []      # (doc, piece, start, length, crc)

        def flush():
            nonlocal base, held
            placed = best_fit([h[3] for h in held], cap)
            cols = list(zip(*held))
            arrays = [pa.array(c, PIECE_TYPES[i]) for i, c in enumerate(cols)]
            arrays += [pa.array([base + s for s, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())]
            base += 1 + max(s for s, _ in placed)
            held = []
            return pa.RecordBatch.from_arrays(arrays, PIECES.names)

        for b in batches:
            ids, raw = b.column(0).to_pylist(), common.text_bytes(b.column(1))
            for lo, hi in common.slices(raw, 4 << 20):
                coded = tok.encode([t.decode("utf-8", "replace") for t in raw[lo:hi]])
                for doc, c in zip(ids[lo:hi], coded):
                    c += END.to_bytes(4, "little")
                    start = 0
                    for k, n in enumerate(cut(len(c) // 4, cap.tokens)):
                        held.append((doc, k, start, n, zlib.crc32(c[4 * start:4 * (start + n)])))
                        start += n
                    if len(held) >= window:
                        yield flush()
        if held:
            yield flush()

    common.bound_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, PIECES)


PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
_loaded: dict[str, ByteLevelTokenizer] = {}


def _tokenizer(path: str) -> ByteLevelTokenizer:
    """One per worker process: loading takes longer than a small task, and the cache stays warm."""
    if path not in _loaded:
        _loaded[path] = ByteLevelTokenizer(path)
    return _loaded[path]
