"""String and list scalars as native Column expressions.

The original jobs used row-at-a-time Python UDFs for these rules. Here each
rule is a Catalyst expression, so it stays inside whole-stage codegen, is
visible to the optimizer and can run in SQL through ``register_sql_functions``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# Fixed values that decide results (kept equal to the original jobs):
# marker that starts the kept message tail, the date separator of ISO dates,
# the separator of log timestamps and the partition value used for a missing
# log timestamp.
URL_MARKER = "url="
ISO_DATE_SEPARATOR = "T"
LOG_TIME_SEPARATOR = " "
MISSING_LOG_DATE = "null_time"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def render_list(arr: ColumnOrName) -> Column:
    """Render an array the way a JVM list prints: ``[a, b]``, nulls as ``null``."""
    a = _col(arr)
    # a cast rather than transform(): no lambda, so it stays in whole-stage codegen
    as_text = a.cast("array<string>")
    return F.concat(F.lit("["), F.array_join(as_text, ", ", "null"), F.lit("]"))


def unwrap_single(arr: ColumnOrName) -> Column:
    """A one-element list becomes its element; any other list is rendered
    as text (``[a, b]``, ``[]``); null stays null. Result type is string."""
    a = _col(arr)
    return (F.when(F.size(a) == 1, F.get(a, 0).cast("string"))
            .when(a.isNotNull(), render_list(a)))


def unwrap_value(df: DataFrame, name: str) -> Column:
    """J1 applied by type: arrays are unwrapped, strings pass through and any
    other scalar is cast to string (the rule's declared result type)."""
    dtype = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dtype, T.ArrayType):
        return unwrap_single(c)
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.NullType):
        return F.lit(None).cast("string")
    return c.cast("string")


def suffix_after(text: ColumnOrName, marker: str = URL_MARKER,
                 on_missing: str = "error") -> Column:
    """Everything after the first ``marker`` (the tail, not just the URL).

    Null and empty text are returned unchanged. A non-empty text without the
    marker raises (``on_missing="error"``, the original behaviour, failing the
    job), becomes null (``"null"``) or is kept whole (``"keep"``).
    """
    s = _col(text)
    pos = F.instr(s, marker)
    tail = s.substr(pos + F.lit(len(marker)), F.length(s) + F.lit(1))
    out = F.when(s.isNull() | (s == F.lit("")), s).when(pos > 0, tail)
    if on_missing == "error":
        return out.otherwise(F.raise_error(
            F.concat(F.lit(f"marker '{marker}' not found in text: "), s)).cast("string"))
    if on_missing == "null":
        return out
    if on_missing == "keep":
        return out.otherwise(s)
    raise ValueError(f"on_missing must be error, null or keep, got {on_missing!r}")


def prefix_before(text: ColumnOrName, separator: str, missing=None) -> Column:
    """Text before the first ``separator`` (all of it when absent). Null and
    empty text give ``missing``."""
    s = _col(text)
    return (F.when(s.isNull() | (s == F.lit("")), F.lit(missing).cast("string"))
            .otherwise(F.substring_index(s, separator, 1)))


def extract_date(text: ColumnOrName, separator: str = ISO_DATE_SEPARATOR) -> Column:
    """Date part of an ISO timestamp text; null or empty -> null."""
    return prefix_before(text, separator, None)


def extract_log_date(text: ColumnOrName, separator: str = LOG_TIME_SEPARATOR,
                     missing: str = MISSING_LOG_DATE) -> Column:
    """Text before the first space; null or empty -> ``"null_time"``.
    A leading separator gives ``""`` (kept as in the original rule)."""
    return prefix_before(text, separator, missing)


def safe_cast(c: ColumnOrName, to: str = "double") -> Column:
    """Cast that yields null on text that is no number (ANSI-safe)."""
    return _col(c).try_cast(to)


def register_sql_functions(spark: SparkSession) -> None:
    """Expose J1-J4 to SQL as temporary SQL functions (no Python at run time). The
    list form of J1 takes ``array<string>``: cast other element types first."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION unwrap_single(a ARRAY<STRING>) RETURNS STRING "
        "RETURN CASE WHEN size(a) = 1 THEN get(a, 0) "
        "WHEN a IS NOT NULL THEN concat('[', array_join(a, ', ', 'null'), ']') END")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION extract_date(s STRING) RETURNS STRING "
        "RETURN CASE WHEN s IS NULL OR s = '' THEN NULL "
        f"ELSE substring_index(s, '{ISO_DATE_SEPARATOR}', 1) END")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION extract_log_date(s STRING) RETURNS STRING "
        f"RETURN CASE WHEN s IS NULL OR s = '' THEN '{MISSING_LOG_DATE}' "
        f"ELSE substring_index(s, '{LOG_TIME_SEPARATOR}', 1) END")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION extract_message(s STRING) RETURNS STRING "
        "RETURN CASE WHEN s IS NULL OR s = '' THEN s "
        f"WHEN instr(s, '{URL_MARKER}') > 0 "
        f"THEN substr(s, instr(s, '{URL_MARKER}') + {len(URL_MARKER)}) "
        f"ELSE CAST(raise_error(concat('marker not found in text: ', s)) AS STRING) END")
