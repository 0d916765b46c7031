"""File sources for every record layout.

Layouts are never guessed: each record path has its own reader.

=========================  =================  ==================================
layout                     reader             splittable
=========================  =================  ==================================
``[{...}, ...]``           read_json_array    no: one task per file
``[[{...}], [{...}]]``     read_json_nested   no: one task per file (whole text)
any JSON, one per file     read_json_document no: one task per file
``{...}`` per line         read_json_lines    yes
any text, per line         read_lines         yes
=========================  =================  ==================================

Documents that do not parse are never lost in silence: a ``counts``
(``StageCounts``) counts them during the one action, and ``on_bad="fail"``
stops the job.

Multi-line documents cannot be split, so at scale the input should be many
moderately sized files (the whole-text reader holds one file in memory and is
limited to 2 GB per file); JSON lines and text lines split freely.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path

Paths = str | Sequence[str]
Schema = T.StructType | str | None


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _reader(spark: SparkSession, schema: Schema, recursive: bool,
            sampling_ratio: float | None = None):
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    elif sampling_ratio is not None:
        r = r.option("samplingRatio", sampling_ratio)
    if recursive:
        # Files in subfolders too (turns partition discovery off)
        r = r.option("recursiveFileLookup", "true")
    return r


def _rejects(df: DataFrame, bad, counts, name: str, on_bad: str) -> DataFrame:
    """Count the rows of ``df`` where ``bad`` holds, or fail on the first."""
    if on_bad not in ("keep", "fail"):
        raise ValueError(f"on_bad must be keep or fail, got {on_bad!r}")
    if on_bad == "fail":
        stop = F.raise_error(F.lit(f"{name}: a document does not parse")).cast("boolean")
        df = df.where(F.when(bad, stop).otherwise(F.lit(True)))
    return df if counts is None else counts.track(df, name, bad)


def read_json_array(spark: SparkSession, paths: Paths, schema: Schema = None, *,
                    recursive: bool = False, sampling_ratio: float | None = None,
                    counts=None, on_bad: str = "keep") -> DataFrame:
    """A1 (record path ``$[*]``) and A4: one row per element of a root array;
    an object file gives one row. ``schema=None`` infers (A11). A file that does
    not parse gives one row of nulls; with ``counts``, ``bad_documents`` counts such rows."""
    r = _reader(spark, schema, recursive, sampling_ratio).option("multiLine", "true")
    df = r.json(_paths(paths))
    if counts is None and on_bad == "keep":
        return df
    empty = F.lit(True)
    for c in df.columns:
        empty = empty & F.col(f"`{c}`").isNull()
    return _rejects(df, empty, counts, "bad_documents", on_bad)


def _whole_texts(spark: SparkSession, paths: Paths, recursive: bool) -> DataFrame:
    text = spark.read.options(**({"recursiveFileLookup": "true"} if recursive else {}))
    return text.text(_paths(paths), wholetext=True)


def _struct(spark: SparkSession, schema: T.StructType | str) -> T.StructType:
    return schema if not isinstance(schema, str) else spark.createDataFrame([], schema).schema


def read_json_nested(spark: SparkSession, paths: Paths, schema: T.StructType | str, *,
                     index: int = 0, recursive: bool = False, counts=None,
                     on_bad: str = "keep") -> DataFrame:
    """A2 (record path ``$[0][*]``): one row per element of the ``index``-th
    inner array of a root array of arrays. Needs an explicit schema; any field
    names will do.

    The plain multi-line reader turns such a file into a single null row, so
    the document is read as whole text and decoded here. A file that does not
    parse, or has another root, contributes no rows; with ``counts``,
    ``bad_documents`` counts such files.
    """
    if schema is None:
        raise ValueError("read_json_nested needs an explicit record schema")
    doc_type = T.ArrayType(T.ArrayType(_struct(spark, schema)))
    docs = _whole_texts(spark, paths, recursive).select(
        F.from_json(F.col("value"), doc_type).alias("d"))
    docs = _rejects(docs, F.col("d").isNull(), counts, "bad_documents", on_bad)
    return docs.select(F.inline(F.get(F.col("d"), index)))


_STEP = re.compile(r"\[\*\]|\[\d+\]|\.[^.\[\]]+|\['[^']+'\]")


def read_json_path(spark: SparkSession, paths: Paths, path: str = "$[0][*]", *, recursive: bool = False,
                   counts=None, on_bad: str = "keep") -> DataFrame:
    """A2 without a schema: one variant ``record`` per value that a record path meets in each file.

    The path is ``$`` and steps ``[n]``, ``.name``, ``['name']`` and ``[*]`` (every element of an
    array, every value of an object). No field is dropped or renamed; leaves come out with
    ``variant_get``. A file where the path leads nowhere gives no rows; one that does not parse
    counts as ``bad_documents`` or fails, as ``on_bad`` says.
    """
    steps = _STEP.findall(path[1:])
    if path[:1] != "$" or "".join(steps) != path[1:]:
        raise ValueError(f"not a record path: {path!r}")
    docs = _whole_texts(spark, paths, recursive).select(F.try_parse_json("value").alias("record"))
    docs = _rejects(docs, F.col("record").isNull(), counts, "bad_documents", on_bad)
    walked = "$"
    for step in [*steps, None]:
        if step not in ("[*]", None):
            walked += step
            continue
        if walked != "$":       # plain steps go in one walk
            docs = docs.select(F.try_variant_get("record", walked, "variant").alias("record")).where("record IS NOT NULL")
            walked = "$"
        if step == "[*]":
            many = F.schema_of_variant("record")
            docs = docs.where(many.startswith("ARRAY") | many.startswith("OBJECT"))
            docs = docs.lateralJoin(spark.tvf.variant_explode(F.col("record").outer())).select(F.col("value").alias("record"))
    return docs


# -- schemas from the data ------------------------------------------------------------------------

def document_schemas(spark: SparkSession, paths: Paths, *, lines: bool = False, recursive: bool = False) -> DataFrame:
    """A11 by file: file, records, bad and the merged schema of its records, in one scan.

    A record is an element of a root array, a root object, or with ``lines`` a line. Schemas merge
    pairwise inside the aggregation (map-side first), so a file's records never meet in one place;
    a field whose records disagree is a VARIANT in it, a field that is always null is VOID. Object
    fields come in the order of their names.
    """
    if lines:
        text = spark.read.options(**({"recursiveFileLookup": "true"} if recursive else {})).text(_paths(paths))
    else:
        text = _whole_texts(spark, paths, recursive)
    docs = text.select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("d"))
    # a root array merges its elements itself: its schema is ARRAY<element>
    by_file = docs.groupBy("file").agg(
        F.count("d").alias("documents"), F.count_if(F.col("d").isNull()).alias("bad"), F.schema_of_variant_agg("d").alias("schema"))
    inner = F.regexp_extract("schema", r"^ARRAY<(.*)>$", 1)
    return by_file.withColumn("schema", F.when(F.col("schema").startswith("ARRAY<"), inner).otherwise(F.col("schema")))


def _as_type(text: str) -> T.DataType:
    """A variant schema text as a Spark type, with the number types that JSON inference gives: whole
    numbers are bigint or wide decimals, others double. VOID (always null) stays for merging."""
    ddl = re.sub(r"\bOBJECT\s*<", "STRUCT<", text)
    ddl = re.sub(r"\bOBJECT\b", "STRUCT<>", ddl)
    ddl = re.sub(r"\bDECIMAL\(\d+,\s*[1-9]\d*\)", "DOUBLE", ddl)
    return T._parse_datatype_string(ddl)


def _settled(t: T.DataType) -> T.DataType:
    """What is always null is text, as JSON inference has it."""
    if isinstance(t, T.NullType):
        return T.StringType()
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_settled(t.elementType))
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in t.fields])
    return t


def conflicts(schema: T.DataType, at: str = "$") -> list[str]:
    """Paths where records disagree on the type."""
    if isinstance(schema, T.VariantType):
        return [at]
    if isinstance(schema, T.ArrayType):
        return conflicts(schema.elementType, f"{at}[*]")
    if isinstance(schema, T.StructType):
        return [c for f in schema.fields for c in conflicts(f.dataType, f"{at}.{f.name}")]
    return []


def infer_schema(spark: SparkSession, paths: Paths, *, lines: bool = False, recursive: bool = False) -> tuple[T.StructType, DataFrame]:
    """A11 in one pass: the schema of all records, and ``document_schemas`` staged for a look at it.

    The files are read and parsed once; the merge over files works on their schema texts, one
    short row each, written to the shared folder.
    """
    path = shared_path(spark, "schemas", unique=True)
    document_schemas(spark, paths, lines=lines, recursive=recursive).write.parquet(path)
    found = spark.read.parquet(path)
    # one short text for each shape that files have
    texts = [r["schema"] for r in found.where("schema <> 'VOID'").select("schema").distinct().collect()]
    merged = _settled(reduce(merge_types, [_as_type(t) for t in texts], T.NullType()))
    return (merged if isinstance(merged, T.StructType) else T.StructType([])), found


def merge_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both: fields by name, numbers widened, a VARIANT where they disagree."""
    if isinstance(a, T.NullType) or a == b:
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        both = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            both[f.name] = merge_types(both.get(f.name, T.NullType()), f.dataType)
        return T.StructType([T.StructField(n, t) for n, t in sorted(both.items())])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merge_types(a.elementType, b.elementType))
    whole = (T.LongType, T.DecimalType)
    if isinstance(a, (*whole, T.DoubleType)) and isinstance(b, (*whole, T.DoubleType)):
        if isinstance(a, whole) and isinstance(b, whole):
            return T.DecimalType(max(t.precision if isinstance(t, T.DecimalType) else 20 for t in (a, b)), 0)
        return T.DoubleType()
    return T.VariantType()


def read_json_document(spark: SparkSession, paths: Paths, schema: Schema = None, *,
                       recursive: bool = False, counts=None, on_bad: str = "keep") -> DataFrame:
    """A3 (record path ``$``): one row per file, whatever its root is.

    Without a schema the whole document is one ``variant`` in column ``document``:
    no field is dropped or renamed. With a struct schema each file's object
    becomes one row; with an array schema the array is kept in ``document``. A
    file that does not parse is a null ``document`` (a row of nulls); with
    ``counts``, ``bad_documents`` counts such files."""
    raw = _whole_texts(spark, paths, recursive)
    if schema is None:
        docs = raw.select(F.try_parse_json("value").alias("document"))
        return _rejects(docs, F.col("document").isNull(), counts, "bad_documents", on_bad)
    if isinstance(schema, str) and not schema.lstrip().lower().startswith("array"):
        schema = _struct(spark, schema)
    docs = raw.select(F.from_json(F.col("value"), schema).alias("document"))
    docs = _rejects(docs, F.col("document").isNull(), counts, "bad_documents", on_bad)
    if isinstance(schema, T.StructType):
        return docs.select(F.inline(F.array("document")))
    return docs


def read_json_lines(spark: SparkSession, paths: Paths, schema: Schema = None, *,
                    recursive: bool = False, sampling_ratio: float | None = None) -> DataFrame:
    """A5: one JSON object per line (splittable). Malformed lines -> nulls."""
    r = _reader(spark, schema, recursive, sampling_ratio).option("multiLine", "false")
    return r.json(_paths(paths))


def read_lines(spark: SparkSession, paths: Paths, *, recursive: bool = False) -> DataFrame:
    """A6 (+A8 with a glob such as ``root/*/*.txt``): one row per line in
    column ``value``."""
    r = spark.read
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.text(_paths(paths))


def daily_paths(pattern: str, begin: dt.date, end: dt.date) -> list[str]:
    """One path per day from ``begin`` to ``end`` inclusive; ``pattern``
    holds ``{}`` (or ``{date}``) for the ``yyyy-MM-dd`` day."""
    if end < begin:
        return []
    days = (end - begin).days + 1
    out = []
    for i in range(days):
        day = (begin + dt.timedelta(days=i)).isoformat()
        out.append(pattern.replace("{date}", day).replace("{}", day))
    return out


def read_daily(spark: SparkSession, pattern: str, begin: dt.date, end: dt.date,
               reader: Callable[..., DataFrame] = read_lines, **kwargs) -> DataFrame:
    """Read a date range of daily folders in one scan (one job, one file
    listing). Every day must exist; a missing day fails the read."""
    return reader(spark, daily_paths(pattern, begin, end), **kwargs)


def read_day_partitions(spark: SparkSession, root: str, column: str, begin: dt.date,
                        end: dt.date, reader: Callable[..., DataFrame] = read_json_lines,
                        **kwargs) -> DataFrame:
    """A9 on a partitioned layout (``root/column=yyyy-MM-dd/``): a range filter
    on the partition column, pruned at planning time (PartitionFilters)."""
    df = reader(spark, root, **kwargs)
    return df.where(F.col(column).between(F.lit(begin.isoformat()), F.lit(end.isoformat())))
