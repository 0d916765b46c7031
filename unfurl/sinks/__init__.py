"""Sinks (B1-B3, B6): JSON and Parquet, plain or partitioned.

``mode`` is required: the plain writer's default fails when the path exists,
and a silent default would hide that choice.

Partitioned writes are rebalanced on the partition key first (``rebalance``
hint): adaptive execution then merges small partitions and splits a hot
key's partition, so each folder gets a few evenly sized files instead of one
file per task per key, or one giant file for a hot day. It merges by size, and
a folder takes its time however small it is: ``spread_folders`` keeps the merged
partitions numerous enough for all cores. Where a key makes thousands of folders,
``many_folders`` writes them without the cost that Spark's writer has for each (see ``folders``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .folders import write_many_folders

MODES = ("error", "errorifexists", "overwrite", "append", "ignore")


@contextmanager
def _settings(spark: SparkSession, want: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


PER_CORE = 4


def spread_folders(spark: SparkSession):
    """While a partitioned write runs, adaptive execution merges partitions into no fewer than
    ``PER_CORE`` a core. A key's rows stay together, so no folder gets more files."""
    merge = "spark.sql.adaptive.coalescePartitions."
    return _settings(spark, {merge + "minPartitionNum": str(PER_CORE * spark.sparkContext.defaultParallelism),
                             merge + "minPartitionSize": "1b"})


#: so many files below so many bytes are one task's work
SMALL_FILES, SMALL_BYTES = 500, 256 << 10


def read_folders(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    """A partitioned table with its written schema. Its folders are listed by ``PER_CORE`` tasks
    a core; Spark's own choice is a task for each folder, up to 10,000.

    Small files are read by as many tasks at least, and more as their number asks for: Spark counts
    4 MB for the opening of each, so a handful makes a task. Larger ones are split as ever; the two are
    apart since a merge of tasks takes neighbours, and Spark puts the largest files side by side."""
    tasks = PER_CORE * spark.sparkContext.defaultParallelism
    with _settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)}):
        df = spark.read.schema(schema).format(fmt).load(path)
    files = len(df._jdf.inputFiles())
    if files <= tasks:
        return df
    small = F.col("_metadata.file_size") < SMALL_BYTES      # prunes the listing: no file is opened twice
    return df.where(small).coalesce(max(tasks, -(-files // SMALL_FILES))).unionByName(df.where(~small))


def _dealt(df: DataFrame, keys: Sequence[str], rebalance: bool = True) -> DataFrame:
    return df.hint("rebalance", *keys) if keys and rebalance else df


def _prepare(df: DataFrame, mode: str, partition_by: Sequence[str] | None,
             rebalance: bool):
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    keys = list(partition_by or [])
    w = _dealt(df, keys, rebalance).write.mode(mode)
    if keys:
        w = w.partitionBy(*keys)
    return w


def _spread(df: DataFrame, partition_by: Sequence[str] | None):
    return spread_folders(df.sparkSession) if partition_by else nullcontext()


def save_many_folders(df: DataFrame, path: str, fmt: str, mode: str, partition_by: Sequence[str], rebalance: bool = True) -> bool:
    """``write_many_folders`` by all cores; False, and nothing done, where Spark's writer has to do it."""
    with spread_folders(df.sparkSession):
        return write_many_folders(_dealt(df, partition_by, rebalance), path, fmt, mode, partition_by)


def write_json(df: DataFrame, path: str, *, mode: str,
               partition_by: Sequence[str] | None = None, rebalance: bool = True,
               compression: str | None = None, many_folders: bool = False) -> None:
    """B1 (partitioned) and B3 (plain) JSON output.
    Null fields are omitted from the written objects. ``many_folders``: the keys make
    thousands of folders of few rows; the same files are then written by ``write_many_folders``."""
    if many_folders and partition_by and not compression and save_many_folders(df, path, "json", mode, partition_by, rebalance):
        return
    w = _prepare(df, mode, partition_by, rebalance)
    if compression:
        w = w.option("compression", compression)
    with _spread(df, partition_by):
        w.json(path)


def write_parquet(df: DataFrame, path: str, *, mode: str,
                  partition_by: Sequence[str] | None = None, rebalance: bool = True) -> None:
    """B2: Parquet output, by default partitioned by the given keys."""
    w = _prepare(df, mode, partition_by, rebalance)
    with _spread(df, partition_by):
        w.parquet(path)


def write_text(df: DataFrame, path: str, *, mode: str,
               partition_by: Sequence[str] | None = None, file_per_row: bool = False,
               compression: str | None = None) -> None:
    """Text lines (one string column), used to lay out raw log files. With
    ``file_per_row`` every row is a file of its own (a whole document)."""
    w = _prepare(df, mode, partition_by, False)
    if compression:
        w = w.option("compression", compression)
    with _spread(df, partition_by):
        (w.option("maxRecordsPerFile", 1) if file_per_row else w).text(path)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows as a DataFrame (``show(n)`` without printing)."""
    return df.limit(n)


def schema_text(df: DataFrame) -> str:
    """The tree form of ``printSchema`` as a string."""
    return df.schema.treeString()
