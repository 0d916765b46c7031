"""URL filter over a sorted digest array.

A list entry is a rule, a host and path prefix (``example.org/es/``), or, with a leading
``=``, a listed host. Both fit subdomains. Entries are kept as 64-bit xxhash digests in sorted order, in shards, beside
the full strings. A url gives all strings that could be an entry (suffixes of its host, cut
at dots, with prefixes of its path of the lengths that entries have); their digests are
looked up in the memory-mapped arrays by vectorised binary search, and a hit counts only if
the stored string is equal.

A list below ``local_bytes`` (measured) goes to every task, and urls are not shuffled. A
longer one stays in shards: distinct candidates are dealt to the shard that could hold them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SHARD = T.StructType([T.StructField("shard", T.LongType()), T.StructField("low", T.LongType()), T.StructField("n", T.LongType()),
                      T.StructField("digests", T.BinaryType()), T.StructField("offsets", T.BinaryType()),
                      T.StructField("strings", T.BinaryType()), T.StructField("blocks", T.BinaryType())])


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(rest, upper, low), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def build(entries: DataFrame, shard_entries: int = 1 << 20) -> DataFrame:
    """Shards of the digest array from ``entries`` (entry, verdict), staged.

    Null and empty entries are left out; of one entry with both verdicts, block stays.
    """
    e = (entries.where("entry is not null and entry <> ''").groupBy("entry")
         .agg(F.max((F.col("verdict") == "block").cast("int")).alias("block"))
         .withColumn("digest", F.xxhash64("entry")))
    e = e.repartitionByRange("digest").sortWithinPartitions("digest", "entry").select("digest", "entry", "block")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def shard():
            t = pa.Table.from_batches(held)
            d, s = t["digest"].to_numpy(), common.text_bytes(t["entry"].combine_chunks())
            ends = np.cumsum([0, *map(len, s)]).astype(np.int64)
            b = t["block"].to_numpy().astype(np.uint8)
            row = [[0], [int(d[0])], [len(d)], [d.astype("<i8").tobytes()], [ends.astype("<i8").tobytes()], [b"".join(s)], [b.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, T_) for v, T_ in zip(row, ARROW)], SHARD.names)

        for b in batches:
            d, lo = b.column(0).to_numpy(), 0
            while lo < len(d):
                hi = min(lo + shard_entries, len(d))
                while hi < len(d) and d[hi] == d[hi - 1]:   # equal digests stay in one shard
                    hi += 1
                part, lo = b.slice(lo, hi - lo), hi
                runs_on = held and held[-1].column(0)[-1].as_py() == part.column(0)[0].as_py()
                if held and n + part.num_rows > shard_entries and not runs_on:
                    yield shard()
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if held:
            yield shard()

    made = common.stage(e.mapInArrow(cut, SHARD), "url_shards")
    return made.withColumn("shard", F.col("low"))   # shards are ranges: the first digest names one


ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]


class DigestArray:
    """Shards in digest order, the digests in a memory-mapped file that is unlinked at once."""

    def __init__(self, shards: list[tuple[bytes, bytes, bytes, bytes]]):
        keys = [np.frombuffer(s[0], "<i8") for s in shards]
        n = sum(map(len, keys))
        with tempfile.TemporaryFile() as f:
            for k in keys:
                f.write(k.tobytes())
            f.flush()
            self.keys = np.memmap(f, "<i8", "r", shape=(n,)) if n else np.empty(0, np.int64)
        ends, base = [np.zeros(1, np.int64)], 0
        for s in shards:
            e = np.frombuffer(s[1], "<i8")
            ends.append(e[1:] + base)
            base += int(e[-1])
        self.ends = np.concatenate(ends)
        self.strings = b"".join(s[2] for s in shards)
        self.blocks = np.frombuffer(b"".join(s[3] for s in shards), np.uint8)

    def find(self, digests: np.ndarray, strings: list[bytes]) -> np.ndarray:
        """Place of each string in the array, -1 if it is no entry."""
        out = np.full(len(digests), -1, np.int64)
        at = np.searchsorted(self.keys, digests)
        # equal digests stand side by side: step on while the string differs
        todo = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == digests)) if len(self.keys) else []
        for i in todo:
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == digests[i]:
                if self.strings[self.ends[k]:self.ends[k + 1]] == strings[i]:
                    out[i] = k
                    break
                k += 1
        return out


@dataclass
class UrlList:
    """A built list: its shards, its size, and the path lengths that its entries have."""

    shards: DataFrame
    n_bytes: int
    lengths: list[int]

    @classmethod
    def of(cls, entries: DataFrame, shard_entries: int = 1 << 20) -> UrlList:
        shards = build(entries, shard_entries)
        size = shards.agg(F.sum(F.octet_length("strings") + 17 * F.col("n"))).first()[0] or 0
        prefix = entries.where("entry is not null and not startswith(entry, '=') and entry <> ''")
        path = F.regexp_extract("entry", r"(?s)^[^/]*(.*)$", 1)
        # as many rows as paths have lengths
        lengths = sorted(r[0] for r in prefix.select(F.length(path)).distinct().collect())
        return cls(shards, int(size), lengths)


def _candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """Strings that could be entries: host suffixes with path prefixes, and alone."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length(path))
    both = F.flatten(F.transform(suffixes, lambda s: F.transform(cuts, lambda n: F.concat(s, F.substring(path, F.lit(1), n)))))
    alone = F.transform(suffixes, lambda s: F.concat(F.lit("="), s))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.concat(both, alone))


FOUND = T.StructType([T.StructField("rule", T.StringType()), T.StructField("rule_block", T.BooleanType()),
                      T.StructField("listed", T.BooleanType())])


def _choose(strings: list[list[bytes]], places: list[list[int]], blocks) -> list[list]:
    """Per url: the longest prefix entry and its verdict, and whether its host is listed."""
    rule, verdict, listed = [], [], []
    for cands, at in zip(strings, places):
        hits = [(len(c.decode()), c, bool(blocks[k])) for c, k in zip(cands, at) if k >= 0 and c[:1] != b"="]
        best = max(hits, default=None)
        rule.append(best[1].decode() if best else None)
        verdict.append(best[2] if best else None)
        listed.append(any(k >= 0 and blocks[k] for c, k in zip(cands, at) if c[:1] == b"="))
    return [rule, verdict, listed]


def probe(urls: DataFrame, url_col: str, entries: UrlList, local_bytes: int = 64 << 20, shard_probes: int = 2_000_000) -> DataFrame:
    """``urls`` with host, path, rule, rule_block, listed.

    ``rule`` is the longest prefix entry that fits (of equally long ones, the last in byte
    order) and ``rule_block`` its verdict; ``listed`` says that the host, or
    one that it is a subdomain of, is listed to block. A null url, or one without ://, has an
    empty host and path and fits nothing. Columns of ``urls`` with these names are replaced.
    """
    u = F.col(url_col).cast("string")
    names = ["host", "path", *FOUND.names]
    own = [F.col(f"`{c}`") for c in urls.columns if c not in names]
    d = urls.select(*own, host_of(u).alias("host"), path_of(u).alias("path"))
    d = d.withColumn("_uf_cand", _candidates(F.col("host"), F.col("path"), entries.lengths))
    d = d.withColumn("_uf_digest", F.transform("_uf_cand", lambda c: F.xxhash64(c)))
    if entries.n_bytes <= local_bytes:
        out = _probe_local(d, entries)
    else:
        out = _probe_shards(d, entries, shard_probes)
    return out.drop("_uf_cand", "_uf_digest")


_opened: dict[str, DigestArray] = {}


def _probe_local(d: DataFrame, entries: UrlList) -> DataFrame:
    rows = entries.shards.orderBy("low").select("digests", "offsets", "strings", "blocks").collect()
    sent = d.sparkSession.sparkContext.broadcast([tuple(map(bytes, r)) for r in rows])
    name = uuid.uuid4().hex

    def fn(cands: pa.Array, digests: pa.Array) -> list:
        if name not in _opened:     # one per worker process, whatever the number of its tasks
            _opened.clear()
            _opened[name] = DigestArray(sent.value)
        array = _opened[name]
        flat = common.text_bytes(cands.flatten())
        at = array.find(digests.flatten().to_numpy(zero_copy_only=False).astype(np.int64), flat).tolist()
        ends = np.cumsum([0, *[n or 0 for n in pc.list_value_length(cands).to_pylist()]]).tolist()
        return _choose([flat[a:b] for a, b in zip(ends, ends[1:])], [at[a:b] for a, b in zip(ends, ends[1:])], array.blocks)

    return common.append_columns(d, [F.col("_uf_cand"), F.col("_uf_digest")], fn, FOUND)


def _probe_shards(d: DataFrame, entries: UrlList, shard_probes: int) -> DataFrame:
    d = common.stage(d.withColumn("_uf_row", F.monotonically_increasing_id()), "urls")
    asked = d.select("_uf_row", F.explode(F.arrays_zip("_uf_cand", "_uf_digest")).alias("x"))
    asked = asked.select("_uf_row", F.col("x._uf_cand").alias("cand"), F.col("x._uf_digest").alias("digest"))
    once = common.stage(asked.select("cand", "digest").distinct(), "url_candidates")
    lows = sorted(r[0] for r in entries.shards.select("low").collect())      # one a shard
    copies = max(1, -(-once.count() // (shard_probes * max(1, len(lows)))))
    # the shard whose range holds a digest: the last one that begins at or before it
    owner = F.array_max(F.filter(F.array(*[F.lit(x) for x in lows]), lambda x: x <= F.col("digest")))
    dealt = once.withColumns({"shard": owner, "copy": F.pmod(F.xxhash64("cand", F.lit(1)), F.lit(copies).cast("long"))}).where("shard is not null")
    shards = entries.shards.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias("copy"),
                                   "digests", "offsets", "strings", "blocks")

    def look(probes, shard):
        array = DigestArray([tuple(c.as_py() for c in r) for r in zip(*[shard[k] for k in ("digests", "offsets", "strings", "blocks")])])
        found = array.find(probes["digest"].to_numpy(), common.text_bytes(probes["cand"].combine_chunks()))
        hit = np.flatnonzero(found >= 0)
        return pa.table({"cand": probes["cand"].take(pa.array(hit)).cast(pa.string()),
                         "block": pa.array(array.blocks[found[hit]] > 0)})

    hits = common.stage(dealt.groupBy("shard", "copy").cogroup(shards.groupBy("shard", "copy"))
                        .applyInArrow(look, "cand string, block boolean"), "url_hits")
    length = F.when(~F.startswith("cand", F.lit("=")), F.struct(F.length("cand").alias("n"), F.col("cand").alias("rule"), "block"))
    best = asked.join(hits, "cand").groupBy("_uf_row").agg(
        F.max(length).alias("best"), F.max(F.startswith("cand", F.lit("=")) & F.col("block")).alias("listed"))
    return (d.join(best, "_uf_row", "left").drop("_uf_row")
            .withColumns({"rule": F.col("best.rule"), "rule_block": F.col("best.block"), "listed": F.coalesce("listed", F.lit(False))})
            .drop("best"))


#: fixed values: the production rules
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


#: fixed values: words that put a host on the list if a part of its name (between dots or hyphens) is one
TERMS = ("ads", "adult", "bets", "casino", "pills", "spam")


def flagged_hosts(urls: DataFrame, url_col: str = "url", terms: tuple[str, ...] = TERMS) -> DataFrame:
    """List entries for the hosts of ``urls`` whose name holds one of ``terms``."""
    host = host_of(F.col(url_col).cast("string"))
    hosts = urls.select(host.alias("host")).distinct()
    named = hosts.where(F.arrays_overlap(F.split("host", "[.-]"), F.array(*[F.lit(t) for t in terms])))
    return named.select(F.concat(F.lit("="), "host").alias("entry"), F.lit("block").alias("verdict"))


def url_filter(urls: DataFrame, url_col: str = "url", rules: list[tuple[str, str]] = RULES, listed: DataFrame | None = None,
               local_bytes: int = 64 << 20, shard_entries: int = 1 << 20) -> DataFrame:
    """``urls`` with host, path, rule, verdict, listed.

    The list holds ``rules`` and the hosts of ``listed`` (entry, verdict; by default those of
    ``urls`` that flagged_hosts gives). The verdict is the longest fitting rule's; urls without
    one are blocked if their host is listed, else allowed. An empty table gives no rows.
    """
    fixed = urls.sparkSession.createDataFrame(rules, "entry string, verdict string")
    listed = flagged_hosts(urls, url_col) if listed is None else listed.select("entry", "verdict")
    found = probe(urls, url_col, UrlList.of(fixed.union(listed), shard_entries), local_bytes)
    block = F.when(F.col("rule").isNotNull(), F.col("rule_block")).otherwise(F.col("listed"))
    return found.withColumn("verdict", F.when(block, "block").otherwise("allow")).drop("rule_block")


def sql(rules: list[tuple[str, str]] = RULES) -> str:
    """The same over ``pages`` in DuckDB SQL."""
    values = ", ".join(f"('{e[:e.index('/')]}', '{e[e.index('/'):]}', '{v}')" for e, v in rules)
    terms = ", ".join(f"'{t}'" for t in TERMS)
    return rf"""
WITH u AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT * FROM (VALUES {values}) AS t(rh, rp, v)),
f AS (SELECT page_id, max_by(rh || rp, length(rh || rp)) AS rule, max_by(v, length(rh || rp)) AS v FROM h JOIN r
      ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id),
l AS (SELECT h.*, f.rule, f.v, list_has_any(string_split_regex(host, '[.-]'), [{terms}]) AS listed FROM h LEFT JOIN f USING (page_id))
SELECT page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN v WHEN listed THEN 'block' ELSE 'allow' END AS verdict FROM l"""
