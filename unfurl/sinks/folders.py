"""Partitioned writes of very many small folders (B1, A10).

Spark's writer opens each file through Hadoop. On a local or mounted file system without Hadoop's
native library that forks ``chmod`` about four times a file, beside a checksum file: some 30 ms,
more than a small folder's rows take. Here the tasks write the same folders and files themselves.

Rows are rebalanced and sorted on the partition columns, so a task meets each folder once and holds
one Arrow batch, or one row group, of it. A task's files have hidden names until it ends, then it
gives them their own; an attempt that fails removes its own. The table is built beside its place and
moved there when all tasks are through, so readers see the old table or the whole new one.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import col

FOLDER, LINE = "_unfurl_folder", "_unfurl_line"
ROW_GROUP = 32 << 20
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
#: file name ending of each Parquet codec, as Spark has it
CODECS = {"none": "", "uncompressed": "", "snappy": ".snappy", "gzip": ".gz", "zstd": ".zstd"}
_PLAIN = (T.StringType, T.BinaryType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
          T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _known(t: T.DataType) -> bool:
    """A type that Arrow and Spark write alike."""
    if isinstance(t, T.ArrayType):
        return _known(t.elementType)
    if isinstance(t, T.StructType):
        return bool(t.fields) and all(_known(f.dataType) for f in t.fields)
    return type(t) in _PLAIN


def _local_root(spark: SparkSession, path: str):
    """The folder's file system, its full path there and as the operating system has it; None
    where files are not local."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file":
        return None
    p = fs.makeQualified(p)
    return fs, p, p.toUri().getPath()


def _escapes(spark: SparkSession) -> dict[int, str]:
    """The characters that Spark escapes in folder names."""
    say = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return {i: s for i in range(1, 128) if (s := say(chr(i))) != chr(i)}


class _JsonFile:
    """Lines that end in a line feed already: a folder's rows are one stretch of the column's buffer."""

    def __init__(self, path: str, codec: str):
        self.file = open(path, "wb")

    def add(self, rows: pa.RecordBatch) -> None:
        lines = rows.column(0)
        _, offsets, data = lines.buffers()
        ends = memoryview(offsets).cast("q" if pa.types.is_large_string(lines.type) else "i")
        if data is not None:
            self.file.write(memoryview(data)[ends[lines.offset]:ends[lines.offset + len(lines)]])

    def close(self) -> None:
        self.file.close()


class _ParquetFile:
    def __init__(self, path: str, codec: str):
        self.path, self.codec, self.rows, self.held, self.writer = path, codec, [], 0, None

    def add(self, rows: pa.RecordBatch) -> None:
        self.rows.append(rows)
        self.held += rows.nbytes
        if self.held >= ROW_GROUP:
            self._flush()

    def _flush(self) -> None:
        table = pa.Table.from_batches(self.rows)
        if self.writer is None:
            self.writer = pq.ParquetWriter(self.path, table.schema, compression=self.codec, store_schema=False)
        self.writer.write_table(table)
        self.rows, self.held = [], 0

    def close(self) -> None:
        if self.rows:
            self._flush()
        self.writer.close()


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Each folder of a batch sorted by folder, with its rows."""
    where, rows = batch.column(0), batch.select(range(1, batch.num_columns))
    n = len(where)
    cuts = pc.indices_nonzero(pc.not_equal(where.slice(1), where.slice(0, n - 1))).to_pylist() if n else []
    starts = [0, *[i + 1 for i in cuts]] if n else []
    for a, b in zip(starts, [*starts[1:], n]):
        yield where[a].as_py(), rows.slice(a, b - a)


def _task(root: str, keys: Sequence[str], escapes: dict[int, str], run: str, ending: str, kind: type, codec: str) -> Callable:
    def folder(values: str) -> str:
        texts = [NULL_FOLDER if v is None else v.translate(escapes) for v in json.loads(values)]
        return "/".join([root, *[f"{k}={v}" for k, v in zip(keys, texts)]])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{run}.c000{ending}"
        hidden, made, at, out = f".{name}.{task.taskAttemptId()}", [], None, None
        try:
            for batch in batches:
                for values, rows in _stretches(batch):
                    if values != at:
                        if out is not None:
                            out.close()
                        made.append(folder(values))
                        os.makedirs(made[-1], exist_ok=True)
                        at, out = values, kind(f"{made[-1]}/{hidden}", codec)
                    out.add(rows)
            if out is not None:
                out.close()
            for f in made:
                os.replace(f"{f}/{hidden}", f"{f}/{name}")
        except BaseException:
            for f in made:
                if os.path.exists(f"{f}/{hidden}"):
                    os.remove(f"{f}/{hidden}")
            raise
        yield pa.RecordBatch.from_pydict({"files": pa.array([len(made)], pa.int64())})

    return write


def write_many_folders(df: DataFrame, path: str, fmt: str, mode: str, keys: Sequence[str]) -> bool:
    """Write ``df`` as Spark's partitioned writer does, a file for each folder that a task has rows
    of; False, and nothing done, where that writer has to do it: on stores that are not local files,
    for other modes and formats, and for types that Arrow has not alike."""
    spark = df.sparkSession
    if fmt not in ("json", "parquet") or mode not in ("overwrite", "error", "errorifexists") or (local := _local_root(spark, path)) is None:
        return False
    fs, place, root = local
    codec = spark.conf.get("spark.sql.parquet.compression.codec", "snappy").lower()
    data = [c for c in df.columns if c not in keys]
    if (not data or not set(keys) <= set(df.columns) or not all(_known(f.dataType) for f in df.schema.fields)
            or (fmt == "parquet" and codec not in CODECS) or (mode != "overwrite" and fs.exists(place))):
        return False
    # as folder names have them: an empty text is the null partition
    texts = F.to_json(F.array(*[F.nullif(col(k).cast("string"), F.lit("")) for k in keys]))
    if fmt == "json":
        rows = [F.concat(F.to_json(F.struct(*[col(c) for c in data])), F.lit("\n")).alias(LINE)]
        kind, ending = _JsonFile, ".json"
    else:
        rows, kind, ending = [col(c) for c in data], _ParquetFile, f"{CODECS[codec]}.parquet"
    run = str(uuid.uuid4())
    beside = f"{os.path.dirname(root)}/_temporary-{run}"
    staged = spark._jvm.org.apache.hadoop.fs.Path(f"file://{beside}")
    task = _task(beside, [k.translate(e) for k in keys] if (e := _escapes(spark)) else keys, e, run, ending, kind, codec)
    lines = df.select(texts.alias(FOLDER), *rows).sortWithinPartitions(FOLDER)
    # executors need not have this package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    try:
        job = lines.mapInArrow(task, "files long")
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])
    fs.mkdirs(staged)
    try:
        job.write.format("noop").mode("overwrite").save()
        fs.create(spark._jvm.org.apache.hadoop.fs.Path(staged, "_SUCCESS")).close()
        fs.delete(place, True)
        if not fs.rename(staged, place):
            raise OSError(f"cannot move {beside} to {root}")
    finally:
        fs.delete(staged, True)
    return True
