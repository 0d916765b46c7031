"""Cross-tokenizer alignment: how the tokens of two tokenizers cut the same bytes.

Both tokenizers encode a text; the byte offsets where tokens of both end together cut it into
groups, and the two tokens that end there are linked. The end offsets are two ascending arrays.
While tokens correspond one to one, equal ends stand at a constant index shift (a diagonal), so
slices of doubling length are compared at that shift and a whole stretch is jumped; at a
mismatch halved slices find its last equal end, the irregular group that follows is resolved
token by token, and the shift is updated from it.

A task encodes and aligns a chunk of documents at a time (a few megabytes) and writes one row:
the documents' figures and the chunk's distinct id pairs with their counts. Pair totals are a
grouped sum over those rows; a pair occurs once a chunk at most, however often it is linked,
so no pair is hot. The totals come back to each chunk, which adds them up per document.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, packing
from .lm_score import pack, unpack


@dataclass(frozen=True)
class Chunking:
    """Text bytes of a chunk (a longer document is one of its own) and of a slice aligned at once."""

    chunk_bytes: int = 4 << 20
    slice_bytes: int = 1 << 18


# -- tokenizers: ids of " " + text, and the bytes of each id --------------------------------------

class ByteLevel:
    """A byte-level vocabulary (``tokenizers`` file)."""

    def __init__(self, path: str):
        self.encoder = packing.ByteLevelTokenizer(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        added = {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        self.bytes = [b""] * (max([*vocab.values(), *added]) + 1)
        for token, i in vocab.items():
            self.bytes[i] = added[i].encode() if i in added else bytes(byte[c] for c in token)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of a blank and each text, little-endian unsigned 32-bit."""
        return self.encoder.encode([" " + t for t in texts])


class _Words(packing._Chunks):
    """Ids of words, looked up line by line where a line feed is a token of its own."""

    def __init__(self, encode: Callable[[str], list[int]], cache: int, lines: bool):
        super().__init__(encode, "", cache)
        self.lines = packing._Chunks(lambda t: encode("\n" + t)[1:], "", cache) if lines else None

    def __missing__(self, word: str) -> bytes:
        if self.lines is None or "\n" not in word:
            return super().__missing__(word)
        first, *rest = word.split("\n")
        # the blank in front of a first line without text is a token by itself
        return (self[first] if first else self._blank()) + b"".join(map(self.lines.__getitem__, rest))

    def _blank(self) -> bytes:
        return array("I", self.encode("\n")[:1]).tobytes()


class Pieces:
    """A ``sentencepiece`` model, which puts a blank in front of a text itself.

    Where no piece holds the blank sign behind another character and white space is kept, merges
    never cross into a word from what is before its blank: a text is cut at its blanks and the ids
    of each word are looked up. Texts with runs of blanks, and other models, are encoded whole.
    """

    MARK = "▁"

    def __init__(self, path: str, cache: int = 150_000):
        import sentencepiece
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace(self.MARK, " ").encode() for i, p in enumerate(names)]
        inner = re.compile(f"[^{self.MARK}]{self.MARK}")
        probe = "  a  \u00e9\u2460\ufb01\u212b \t\n b "
        kept = b"".join(self.bytes[i] for i in m.encode(probe)) == f" {probe}".encode()
        self.by_word = kept and not any(inner.search(p) for p in names)
        # a line feed that is a byte of its own cuts as well: what follows it has no blank in front
        line = [names[i] for i in m.encode("\nab")]
        self.words = _Words(lambda t: m.encode(t, num_threads=1), cache, self.by_word and line[:2] == [self.MARK, "<0x0A>"])

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", ids).tobytes() for ids in self.model.encode(texts, num_threads=1)]

    def encode(self, texts: list[str]) -> list[bytes]:
        odd = [i for i, t in enumerate(texts) if not self.by_word or "  " in t or t[:1] == " " or t[-1:] == " " or self.MARK in t]
        out: list[bytes] = [b""] * len(texts)
        for i, ids in zip(odd, self.whole([texts[i] for i in odd])):
            out[i] = ids
        skip, look = set(odd), self.words.__getitem__
        for i, t in enumerate(texts):
            if t and i not in skip:
                out[i] = b"".join(map(look, t.split(" ")))
        return out


_loaded: dict[str, ByteLevel | Pieces] = {}


def _flatten(tok: ByteLevel | Pieces) -> None:
    """The bytes of all ids in one array, and where each id's begin."""
    tok.size = np.array([len(x) for x in tok.bytes], np.int64)
    tok.place = np.cumsum(tok.size) - tok.size
    tok.flat = np.frombuffer(b"".join(tok.bytes), np.uint8)


def tokenizer(path: str) -> ByteLevel | Pieces:
    """One per worker process; ``.json`` files are byte-level vocabularies, others sentencepiece models."""
    if path not in _loaded:
        _loaded[path] = ByteLevel(path) if path.endswith(".json") else Pieces(path)
        _flatten(_loaded[path])
    return _loaded[path]


# -- the alignment ----------------------------------------------------------------------------------

def common_ends(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Indices into the ascending end offsets ``a`` and ``b`` of the offsets that both have.

    Both must end at the same offset. ``b``'s index less ``a``'s is the current shift: it holds
    through a one-to-one stretch and changes with an irregular group only.
    """
    at_a, at_b, run = [], [], []
    i = j = 0
    n = len(a)
    a, b = [*a, -1], [*b, -2]       # ends that never meet
    while i < n:
        x, y = a[i], b[j]
        k = 1
        if x == y:
            if a[i + 1] == b[j + 1]:                                # on the diagonal
                k = step = 2
                while a[i + k:i + k + step] == b[j + k:j + k + step]:
                    k += step
                    step *= 2
                while step > 1:     # the last equal end is in the step that failed
                    step //= 2
                    if a[i + k:i + k + step] == b[j + k:j + k + step]:
                        k += step
        else:                       # an irregular group: on to the next offset of both
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
        at_a.append(i)
        at_b.append(j)
        run.append(k)
        i += k
        j += k
    length = np.array(run, np.int64)
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    return np.repeat(np.array(at_a, np.int64), length) + inside, np.repeat(np.array(at_b, np.int64), length) + inside


class Renderer:
    """Groups as text: ids of a group joined by commas, the sides by ``|``, the groups by ``;``."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a = n_a
        self.parts = [f"{i}{end}".encode() for i in range(n_a) for end in ",|"] + [f"{i}{end}".encode() for i in range(n_b) for end in ",;"]

    def digests(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, starts: np.ndarray) -> list[str]:
        """Of each text; ``starts``: its first token in both together, and the end of the last."""
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[cut_a] = last_b[cut_b] = 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        code = np.empty(len(a) + len(b), np.int64)
        # a group's tokens of the first side stand before those of the second
        code[np.arange(len(a)) + np.concatenate([[0], cut_b + 1])[group_a]] = a * 2 + last_a
        code[np.arange(len(b)) + (cut_a + 1)[group_b]] = 2 * self.n_a + b * 2 + last_b
        parts = list(map(self.parts.__getitem__, code.tolist()))
        return [hashlib.sha256(b"".join(parts[x:y])[:-1]).hexdigest() if y > x else "" for x, y in zip(starts.tolist(), starts[1:].tolist())]


_tables: dict[tuple[str, str], tuple] = {}


def _lookup(path_a: str, path_b: str):
    if (path_a, path_b) not in _tables:
        a, b = tokenizer(path_a), tokenizer(path_b)
        _tables[path_a, path_b] = (a, b, Renderer(len(a.bytes), len(b.bytes)))
    return _tables[path_a, path_b]


def _given_back(texts: list[bytes], ids: list[np.ndarray], tok: ByteLevel | Pieces) -> np.ndarray:
    """Of each text: it is not empty, and its tokens' bytes are a blank and the text."""
    n = [int(tok.size[i].sum()) for i in ids]
    same = np.array([len(t) > 0 and len(t) + 1 == m for t, m in zip(texts, n)], bool)
    keep = np.flatnonzero(same).tolist()
    flat = np.concatenate([ids[k] for k in keep]) if keep else np.empty(0, np.int64)
    length = tok.size[flat]
    byte = np.repeat(tok.place[flat] - np.cumsum(length) + length, length) + np.arange(int(length.sum()))
    want = b"".join(x for k in keep for x in (b" ", texts[k]))
    differ = tok.flat[byte] != np.frombuffer(want, np.uint8)
    if differ.any():
        ends = np.cumsum([n[k] for k in keep])
        same[np.array(keep)[np.unique(np.searchsorted(ends, np.flatnonzero(differ), side="right"))]] = False
    return same


@dataclass
class Aligned:
    """Of a list of texts: tokens of each side, groups and digest of each text; of all links the text and the two ids."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    digest: list[str]
    owner: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(texts: list[bytes], path_a: str, path_b: str) -> Aligned:
    """Tokens of a blank and each text. Empty texts, and those whose tokens' bytes are not the text, have none."""
    tok_a, tok_b, render = _lookup(path_a, path_b)
    plain = [t.decode("utf-8", "replace") for t in texts]
    ids = [[np.frombuffer(x, "<u4").astype(np.int64) for x in tok.encode(plain)] for tok in (tok_a, tok_b)]
    given = _given_back(texts, ids[0], tok_a) & _given_back(texts, ids[1], tok_b)
    for k in np.flatnonzero(~given).tolist():
        ids[0][k] = ids[1][k] = np.empty(0, np.int64)
    n_a, n_b = (np.fromiter(map(len, side), np.int64, len(texts)) for side in ids)
    a, b = (np.concatenate(side) if len(side) else np.empty(0, np.int64) for side in ids)
    # texts lie one behind the other: where one ends, tokens of both sides end
    cut_a, cut_b = common_ends(np.cumsum(tok_a.size[a]).tolist(), np.cumsum(tok_b.size[b]).tolist())
    owner = np.repeat(np.arange(len(texts)), n_a)[cut_a]
    starts = np.concatenate([[0], np.cumsum(n_a + n_b)])
    return Aligned(n_a, n_b, np.bincount(owner, minlength=len(texts)), render.digests(a, b, cut_a, cut_b, starts), owner, a[cut_a], b[cut_b])


# -- chunks, totals, answers ------------------------------------------------------------------------------

FIGURES = ("n_a", "n_b", "n_groups", "n_links")
PAIR = 1 << 32      # an id pair as one number: the first side's id times this, and the second's


def _chunk_schema(doc: T.DataType) -> T.StructType:
    longs = T.ArrayType(T.LongType())
    return T.StructType([T.StructField("chunk", T.LongType()), T.StructField("doc", T.ArrayType(doc)),
                         *[T.StructField(c, longs) for c in FIGURES], T.StructField("groups_sha256", T.ArrayType(T.StringType())),
                         T.StructField("pairs", T.BinaryType()), T.StructField("n", T.BinaryType()),
                         # of each document its distinct pairs (places in ``pairs``) and their counts
                         T.StructField("distinct", longs), T.StructField("at", T.BinaryType()), T.StructField("times", T.BinaryType())])


def _encode(path_a: str, path_b: str, how: Chunking, schema: T.StructType):
    arrow = [pa.field(f.name, common._arrow_type(f.dataType)) for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        docs, texts, size = [], [], 0
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), common.text_bytes(b.column(1))):
                if texts and size + len(t) > how.chunk_bytes:
                    yield chunk_row(number, docs, texts)
                    number, docs, texts, size = number + 1, [], [], 0
                docs.append(d)
                texts.append(t)
                size += len(t)
        if texts:
            yield chunk_row(number, docs, texts)

    def chunk_row(number: int, docs: list, texts: list[bytes]) -> pa.RecordBatch:
        parts = [align(texts[lo:hi], path_a, path_b) for lo, hi in common.slices(texts, how.slice_bytes)]
        first = np.cumsum([0, *[len(p.n_a) for p in parts]])
        owner = np.concatenate([p.owner + k for p, k in zip(parts, first)])
        pair = np.concatenate([p.link_a * PAIR + p.link_b for p in parts]).astype(np.uint64)
        pairs, at, n = np.unique(pair, return_inverse=True, return_counts=True)
        mine, times = np.unique(owner * max(1, len(pairs)) + at, return_counts=True)
        groups = np.concatenate([p.n_groups for p in parts])
        values = [number, docs, *[np.concatenate([getattr(p, c) for p in parts]).tolist() for c in FIGURES[:2]], groups.tolist(),
                  np.bincount(owner, minlength=len(docs)).tolist(), [d for p in parts for d in p.digest],
                  pack(np.diff(pairs, prepend=np.uint64(0))), pack(n.astype(np.uint64)),
                  np.bincount(mine // max(1, len(pairs)), minlength=len(docs)).tolist(),
                  pack(mine % max(1, len(pairs))), pack(times.astype(np.uint64))]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow)], [f.name for f in arrow])
    return run


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of each chunk: chunk, place, pair, n."""
    for b in batches:
        for chunk, pairs, n in zip(*[b.column(i).to_pylist() for i in range(3)]):
            pair = np.cumsum(unpack(pairs, np.uint64), dtype=np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), chunk)), pa.array(np.arange(len(pair), dtype=np.int32)),
                                              pa.array(pair), pa.array(unpack(n, np.uint64).astype(np.int64))], ["chunk", "place", "pair", "n"])


def _told(doc_type: pa.DataType):
    """A chunk's documents with what the answers to its pairs add up to."""
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        # one row: a chunk is one row of the staged table
        row = {c: rows.column(c)[0].as_py() for c in rows.column_names}
        place = answers["place"].to_numpy()
        total, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
        total[place], best[place] = answers["total"].to_numpy(), answers["best"].to_numpy()
        at, times = unpack(row["at"], np.uint32).astype(np.int64), unpack(row["times"], np.uint64).astype(np.int64)
        size = len(row["doc"])
        owner = np.repeat(np.arange(size), row["distinct"])
        n_best, count_sum = np.zeros(size, np.int64), np.zeros(size, np.int64)
        np.add.at(n_best, owner, times * best[at])
        np.add.at(count_sum, owner, times * total[at])
        return pa.table({"doc": pa.array(row["doc"], doc_type), **{c: pa.array(row[c], pa.int64()) for c in FIGURES},
                         "n_best": n_best, "count_sum": count_sum, "groups_sha256": pa.array(row["groups_sha256"], pa.string())})
    return run


def encode_chunks(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                  how: Chunking = Chunking()) -> DataFrame:
    """One staged row per chunk of documents: their figures, the chunk's distinct id pairs."""
    common.bound_batches(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").alias("doc"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    schema = _chunk_schema(src.schema["doc"].dataType)
    return common.stage(src.mapInArrow(_encode(path_a, path_b, how, schema), schema), "align_chunks")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """a, b, n of every id pair linked in the corpus, staged; ``best``: no pair of the same b has more links."""
    asked = chunks.select("chunk", "pairs", "n").mapInArrow(_asked, "chunk long, place int, pair long, n long")
    totals = common.stage(asked.groupBy("pair").agg(F.sum("n").alias("total")), "align_totals")
    b = F.col("pair").bitwiseAND(F.lit(PAIR - 1))
    # one row for each id of the second vocabulary at most
    most = totals.groupBy(b.alias("b")).agg(F.max("total").alias("most"))
    return (totals.withColumn("b", b).join(F.broadcast(most), "b")
            .select("pair", F.shiftright("pair", 32).alias("a"), "b", "total", (F.col("total") == F.col("most")).alias("best")))


def cross_align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                how: Chunking = Chunking()) -> DataFrame:
    """doc, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte, have no
    tokens: zeros and an empty digest. Special tokens' strings are ordinary text. Null ids and
    repeated rows are documents like any other, and their links count. Best ties all count. An
    empty table gives no rows.
    """
    chunks = encode_chunks(docs, path_a, path_b, id_col, text_col, how)
    asked = chunks.select("chunk", "pairs", "n").mapInArrow(_asked, "chunk long, place int, pair long, n long")
    answers = asked.drop("n").join(pair_counts(chunks).select("pair", "total", "best"), "pair").drop("pair")
    doc = chunks.schema["doc"].dataType.elementType
    out = T.StructType([T.StructField("doc", doc), *[T.StructField(c, T.LongType()) for c in (*FIGURES, "n_best", "count_sum")],
                        T.StructField("groups_sha256", T.StringType())])
    return (chunks.drop("pairs", "n").groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(_told(common._arrow_type(doc)), out))
