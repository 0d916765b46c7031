"""Helpers shared by the operators: staged tables, Arrow passes over texts, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unfurl.session import shared_path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the cluster's shared folder and read it back.

    Cuts the lineage: what is read later does not depend on executors that may be lost.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", name, unique=True)
    # nothing reads this plan's shuffles after the write: their files go with it
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


TASK_ROWS = 250_000


def fewer_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``'s last step in no more tasks than ``rows`` narrow rows ask for, but one a core: a small
    table dealt to all shuffle partitions costs a task and a file for each of them. Nothing is
    shuffled anew; a table of many rows keeps its partitions."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(1, cores, -(-rows // TASK_ROWS)))


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, limit: int = 8 << 20) -> None:
    """Send texts to Python in batches of 8 MB at most, where the session leaves Spark's default of 64:
    a batch lies in the executor and in the worker, in several copies."""
    if spark.conf.get(BATCH_BYTES).rstrip("b") == str(64 << 20):
        spark.conf.set(BATCH_BYTES, f"{limit}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of each text of an Arrow column; null gives empty bytes."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [b or b"" for b in column.to_pylist()]


def slices(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer text is a range of its own."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def append_columns(df: DataFrame, inputs: list, fn: Callable[..., list], out: T.StructType,
                   keep: Callable | None = None) -> DataFrame:
    """``df`` with the columns of ``out`` computed from ``inputs`` by one Arrow pass.

    ``inputs`` are Columns; ``fn(arrays)`` returns one list or Arrow array per field
    of ``out``. Whatever else ``df`` holds rides along untouched inside one struct, so
    its column names cannot clash with the new ones. With ``keep``, rows whose new
    values fail it are left out and only ``df``'s own columns come back.
    """
    bound_batches(df.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    n = len(inputs)
    packed = df.select(row, *[c.alias(f"in{i}") for i, c in enumerate(inputs)])
    arrow = [pa.field(f.name, _arrow_type(f.dataType)) for f in out.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            got = fn(*[batch.column(1 + i) for i in range(n)])
            made = [g if isinstance(g, (pa.Array, pa.ChunkedArray)) else pa.array(g, f.type)
                    for g, f in zip(got, arrow)]
            if keep is not None:
                yield pa.RecordBatch.from_arrays([batch.column(0)], ["row"]).filter(keep(*made))
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), *made],
                                                 ["row", *[f.name for f in arrow]])

    fields = [T.StructField("row", packed.schema["row"].dataType)]
    schema = T.StructType(fields + ([] if keep is not None else list(out.fields)))
    done = packed.mapInArrow(run, schema)
    own = [F.col("row").getField(c).alias(c) for c in df.columns]
    return done.select(*own, *([] if keep is not None else [F.col(f.name) for f in out.fields]))


def _arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(t)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from every node of ``edges`` (longs a, b): node, root.

    Rounds of large-star and small-star, each a few joins and grouped minima, so no
    neighbour list is ever collected; the number of rounds grows with the logarithm of
    the longest path. Every round is staged, in as few tasks as its edges ask for. Edges in both directions, repeats and
    self-links are allowed; no edges give no rows.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select("b", "a")) if large else e
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        linked = both.join(low, "a")
        if large:   # larger neighbours move to the smallest one around
            out = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:       # the node and its smaller neighbours move there
            out = (linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
                   .union(low.select("a", F.col("m").alias("b"))))
        return out.where("a <> b").distinct()

    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    cur = stage(fewer_tasks(ordered.distinct(), edges.count()), "components")
    mark = _mark(cur)
    for _ in range(max_rounds):
        for large in (True, False):     # mark[0]: the edges, which a round does not make many more
            cur = stage(fewer_tasks(star(cur, large), mark[0]), "components")
        now = _mark(cur)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def _mark(edges: DataFrame) -> tuple:
    """Row count and an order-free digest of the edge set."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.shiftright(h, 20))).first())
