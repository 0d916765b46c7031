"""Enrichment on tables laid out once (F2): bucketed by the join key, so that repeated runs move nothing.

``lay_out`` writes the base and its dimensions as bucketed tables with the same number of buckets.
Their joins and the distincts before them then find the rows in place: no hash exchange. A
bucket is one task, so rows of hot keys and rows without a key stay out of the buckets, in plain
tables beside them; those few keys go through ``enrich``, which spreads them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .columns import col
from .joins import Dim, HotKeys, detect_hot_keys, distinct_rows, enrich, left_join


@dataclass
class Table:
    """One input: the bucketed table of most keys, and the plain one of hot and null keys."""

    bucketed: DataFrame
    loose: DataFrame
    columns: Sequence[str] | None = None
    dedup: bool = False


@dataclass
class Layout:
    key: str
    base: Table
    dims: list[Table]
    hot: HotKeys = field(default_factory=HotKeys)


def _hot_of_all(frames: Sequence[DataFrame], key: str) -> HotKeys:
    """Keys that are hot in any of the inputs, each with its largest number of buckets."""
    out: dict = {}
    for df in frames:
        for k, n in detect_hot_keys(df, key).buckets.items():
            out[k] = max(n, out.get(k, 1))
    return HotKeys(out)


def bucket_count(rows: int, per_bucket: int = 250_000, least: int = 8) -> int:
    """Buckets for ``rows`` rows: a bucket is one task, so their number grows with the rows."""
    return max(least, -(-rows // per_bucket))


def lay_out(base: DataFrame, dims: Sequence[Dim], name: str, buckets: int, hot: HotKeys | None = None) -> Layout:
    """Write ``base`` and ``dims`` (all with one key) under the shared folder, bucketed by the key.

    ``hot``: keys known to be hot; by default those of every input are detected. One file per
    bucket; choose ``buckets`` so that a bucket fits a task (data size / 256 MB or so).
    """
    spark, key = base.sparkSession, dims[0].key
    if any(d.key != key for d in dims):
        raise ValueError("a layout has one key")
    frames = [base, *[d.frame() for d in dims]]
    hot = _hot_of_all(frames, key) if hot is None else hot
    apart = col(key).isNull() | (F.coalesce(col(key).isin(hot.keys), F.lit(False)) if hot.keys else F.lit(False))
    tables = []
    for i, (df, dim) in enumerate(zip(frames, [None, *dims])):
        path = shared_path(spark, "layout", f"{name}_{i}", unique=True)
        table = re.sub(r"\W", "_", f"unfurl_{name}_{i}_{path.rsplit('/', 1)[1]}")
        (df.where(~apart).repartition(buckets, col(key)).write.bucketBy(buckets, key).sortBy(key)
         .option("path", f"{path}/bucketed").saveAsTable(table))
        df.where(apart).write.parquet(f"{path}/loose")
        tables.append(Table(spark.table(table), spark.read.schema(df.schema).parquet(f"{path}/loose"),
                            None, dim.dedup if dim else False))
    return Layout(key, tables[0], tables[1:], hot)


def enrich_laid_out(layout: Layout) -> DataFrame:
    """The rows of ``enrich(base, dims)``, joined in place but for hot and null keys."""
    last_dedup = max((i for i, t in enumerate(layout.dims) if t.dedup), default=-1)
    out = distinct_rows(layout.base.bucketed) if last_dedup >= 0 else layout.base.bucketed
    for i, t in enumerate(layout.dims):
        right = distinct_rows(t.bucketed) if i <= last_dedup else t.bucketed
        # the buckets are in place; a broadcast would only copy them about
        out = left_join(out, right.hint("merge"), layout.key)
    if layout.base.loose.isEmpty():
        return out
    dims = [Dim(t.loose, layout.key, None, t.dedup) for t in layout.dims]
    return out.unionByName(enrich(layout.base.loose, dims, skew=layout.hot))
