"""Left-join enrichment (F1, F2) and full-row distinct (G1), skew-aware.

Join strategy is left to Catalyst and adaptive execution: a side whose
measured shuffle output is small is turned into a broadcast at run time, the
rest is sort-merge joined. Three things are added on top:

* distinct is applied to the *inputs* of the joins, not to the joined rows.
  For left joins whose output carries every column of both sides,
  ``distinct(A LEFT JOIN B) == distinct(A) LEFT JOIN distinct(B)``, so the
  result is the same while the wide joined rows are never shuffled a second
  time, and the distinct hashes on all columns (a hot join key is spread out).
* the joins run on (key, bucket). Rows of a hot key get one of several
  buckets and the matching rows of the other side are copied to each; rows
  with a null key, which match nothing, are spread over all tasks; all other
  rows are in bucket 0. All joins on one key share that partitioning, so the
  big side moves once for all of them.
* the other sides are deduplicated inside the same partitioning, so each of
  them moves once as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import q

SALT = "_unfurl_salt"
#: keys that a frequent-items sketch holds at most; so many partitions and a quarter can be told apart
SKETCH_ITEMS = 1 << 17


def distinct_rows(df: DataFrame) -> DataFrame:
    """G1: full-row distinct (structs and arrays included); partial
    aggregation removes duplicates map-side before the shuffle."""
    return df.dropDuplicates()


def left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left outer equi-join with USING semantics (one key column kept).
    Right keys are not made unique: duplicate right keys multiply rows."""
    return left.join(right, on=key, how="left")


@dataclass
class HotKeys:
    """Join keys to spread, each with its number of buckets."""
    buckets: dict = field(default_factory=dict)

    @property
    def keys(self) -> list:
        return list(self.buckets)


def _parallelism(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


#: key types that the frequent-items sketch takes
_SKETCHED = (T.StringType, T.IntegralType, T.FractionalType, T.DateType, T.TimestampType, T.BooleanType)


def detect_hot_keys(df: DataFrame, key: str, rows_per_task: int | None = None,
                    every: int = 16, groups: int = 64) -> HotKeys:
    """Find the keys whose rows would overflow one task.

    One job over one row in ``every``: each task fills a frequent-items sketch of bounded size,
    the sketches are merged in ``groups`` groups and then in one, and only keys over the limit
    leave the executors, so neither the driver's nor a merging task's load grows with the
    number of tasks. A key is hot when it holds more than ``rows_per_task`` rows, by default
    the average rows per shuffle partition. The sketch keeps four times as many keys as could
    be hot, so a hot key is never missed and its count is off by a quarter of a task's share at
    most. That only decides how rows are dealt, never the result. Null keys need no finding:
    see ``enrich``. Keys of types without a sketch (binary) are counted exactly, with the limit
    applied before they leave the executors.
    """
    rows = df.select(F.col(q(key)).alias("k"))
    if every > 1:
        rows = rows.where(F.pmod(F.monotonically_increasing_id(), F.lit(every)) == 0)
    rows = rows.where(F.col("k").isNotNull())
    # a task's share of a tiny table is no load worth dealing anew
    parts = _parallelism(df)
    limit = (F.greatest(F.lit(1000), F.floor(F.col("total") / parts)) if rows_per_task is None else F.lit(rows_per_task))
    if isinstance(df.schema[key].dataType, _SKETCHED):
        wide = SKETCH_ITEMS if rows_per_task is not None else min(SKETCH_ITEMS, max(1024, 4 * parts))
        some = (rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(groups)).alias("g"))
                .agg(F.expr(f"approx_top_k_accumulate(k, {wide})").alias("s"), F.count(F.lit(1)).alias("n")))
        # grouped, so that no rows give no sketch instead of an empty one
        one = some.groupBy(F.pmod("g", F.lit(1))).agg(F.expr(f"approx_top_k_combine(s, {wide})").alias("s"),
                                                      (F.sum("n") * every).alias("total"))
        found = one.select("total", F.explode(F.expr(f"approx_top_k_estimate(s, {wide // 4})")).alias("e"))
        counts = found.select("total", F.col("e.item").alias("k"), (F.col("e.count") * every).alias("n"))
    else:
        n = rows.groupBy("k").agg((F.count(F.lit(1)) * every).alias("n"))
        counts = n.crossJoin(F.broadcast(rows.agg((F.count(F.lit(1)) * every).alias("total"))))     # one row
    hot = counts.withColumn("share", limit).where("n > share").select("k", F.ceil(F.col("n") / F.col("share")).alias("buckets"))
    return HotKeys({r["k"]: int(r["buckets"]) for r in hot.collect()})


def _buckets(df: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """``df`` with the number of buckets of each row's key (null: not hot). The
    list of hot keys is no longer than a shuffle has partitions."""
    name = SALT + "_n"
    if not hot.buckets:
        return df.withColumn(name, F.lit(None).cast("int"))
    schema = T.StructType([T.StructField(SALT + "_k", df.schema[key].dataType),
                           T.StructField(name, T.IntegerType())])
    listed = df.sparkSession.createDataFrame(list(hot.buckets.items()), schema)
    return (df.join(F.broadcast(listed), F.col(q(key)) == F.col(SALT + "_k"), "left")
            .drop(SALT + "_k"))


def salt_big_side(df: DataFrame, key: str, hot: HotKeys, salt: str = SALT) -> DataFrame:
    """Spread the rows of hot keys over their buckets and null keys over all tasks.

    The bucket is a hash of the row and the partition it comes from: equal
    rows of many partitions are spread too, and a retried task repeats it."""
    cols = [F.col(q(c)) for c in df.columns]
    spread = F.xxhash64(*cols, F.spark_partition_id())
    n = F.col(SALT + "_n")
    bucket = (F.when(F.col(q(key)).isNull(), F.pmod(spread, F.lit(_parallelism(df))))
              .when(n.isNotNull(), F.pmod(spread, n)).otherwise(F.lit(0)))
    return _buckets(df, key, hot).withColumn(salt, bucket.cast("int")).drop(SALT + "_n")


def salt_small_side(df: DataFrame, key: str, hot: HotKeys, salt: str = SALT) -> DataFrame:
    """Copy the rows of hot keys to each of their buckets; others are in bucket 0.
    Rows with a null key match nothing and go."""
    some = df.where(F.col(q(key)).isNotNull())
    if not hot.buckets:
        # not a literal: Catalyst would take it out of the join keys
        return some.withColumn(salt, F.pmod(F.xxhash64(F.col(q(key))), F.lit(1)).cast("int"))
    last = F.coalesce(F.col(SALT + "_n"), F.lit(1)) - F.lit(1)
    return (_buckets(some, key, hot)
            .withColumn(salt, F.explode(F.sequence(F.lit(0), last))).drop(SALT + "_n"))


@dataclass
class Dim:
    """One dimension of an enrichment: a frame, its join key, the columns to
    keep (None keeps all) and whether the joined result is deduplicated after
    this join (full rows, before any final projection)."""
    df: DataFrame
    key: str
    columns: Sequence[str] | None = None
    dedup: bool = False

    def frame(self) -> DataFrame:
        if self.columns is None:
            return self.df
        cols = [self.key] + [c for c in self.columns if c != self.key]
        return self.df.select(*[F.col(q(c)) for c in cols])


def enrich(base: DataFrame, dims: Iterable[Dim],
           skew: str | HotKeys | dict[str, HotKeys] | None = None, counts=None) -> DataFrame:
    """fold of left joins over ``dims`` with optional per-join distinct.

    A distinct flagged on join ``i`` equals a distinct of the base and of
    dims ``1..i`` before joining (see the module note), which is what runs.

    ``skew``: ``"detect"`` finds the hot keys of the base (one extra
    aggregation over a part of the key column, run at once) and spreads them; a
    ``HotKeys`` value (or one per key column) spreads keys that are known;
    ``None`` spreads null keys only. The result is the same in all cases.
    ``counts``: a ``StageCounts`` that observes the rows after each join.
    """
    dims = list(dims)
    last_dedup = max((i for i, d in enumerate(dims) if d.dedup), default=-1)
    out = distinct_rows(base) if last_dedup >= 0 else base
    salts: dict[str, tuple[str, HotKeys]] = {}
    for d in dims:
        if d.key in salts:
            continue
        if skew == "detect":
            hot = detect_hot_keys(base, d.key)
        elif isinstance(skew, dict):
            hot = skew.get(d.key, HotKeys())
        elif skew is None or isinstance(skew, HotKeys):
            hot = skew or HotKeys()
        else:
            raise ValueError(f"skew must be None, 'detect' or HotKeys, got {skew!r}")
        name = f"{SALT}{len(salts)}"
        salts[d.key] = (name, hot)
        out = salt_big_side(out, d.key, hot, name)
    for i, d in enumerate(dims):
        name, hot = salts[d.key]
        right = salt_small_side(d.frame(), d.key, hot, name)
        if i <= last_dedup:
            # one move: the join and the distinct both find the rows in place
            right = distinct_rows(right.repartition(F.col(q(d.key)), F.col(name)))
        out = out.join(right, on=[d.key, name], how="left")
        if counts is not None:
            out = counts.track(out, f"join_{i + 1}")
    return out.drop(*[name for name, _ in salts.values()])
