"""Operation-log ETL (PL6-PL9) and the pass-through job (PL10).

lines -> [not null] -> [contains '"method":"POST"'] -> decode once -> keep 10
fields -> method = POST, message != '' -> fields.log_type, message tail,
log date -> 11 columns. No shuffle anywhere: the job is a single map stage
and runs unchanged on a stream.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsoncols import decode_once
from ..functions.text import (LOG_TIME_SEPARATOR, URL_MARKER, extract_log_date,
                              suffix_after)
from ..operators.columns import (col, contains_text, ensure_columns, equals, is_not_null,
                                 non_empty, select_columns, where_all)
from ..schemas import LOG_FOCUS_COLUMNS, LOG_LINE_SCHEMA, LOG_OUTPUT_COLUMNS

# Fixed values of the original log jobs: the exact bytes of the text
# prefilter, the method kept and the default for a missing method column.
POST_PREFILTER = '"method":"POST"'
KEPT_METHOD = "POST"
MISSING_METHOD = "BAD"


def log_records_etl(records: DataFrame, *, method: str = KEPT_METHOD,
                    with_log_date: bool = True, marker: str = URL_MARKER,
                    on_missing: str = "error", separator: str = LOG_TIME_SEPARATOR,
                    method_default: str | None = None) -> DataFrame:
    """PL8/PL9 on already-parsed log records (JSON documents or JSON lines).

    method_default: add ``method`` with this value when the column is absent
    (PL8 uses ``"BAD"``, so every row is then filtered out).
    """
    df = records
    if method_default is not None:
        df = ensure_columns(df, {"method": method_default})
    df = where_all(df, is_not_null("method"), equals("method", method), non_empty("message"))
    df = df.withColumns({
        "fields_log_type": F.col("fields.log_type"),
        "message": suffix_after(col("message"), marker, on_missing),
    })
    if with_log_date:
        df = df.withColumn("log_date", extract_log_date(col("log_timestamp"), separator))
        out = LOG_OUTPUT_COLUMNS
    else:
        out = [c for c in LOG_OUTPUT_COLUMNS if c != "log_date"]
    return select_columns(df, out)


def log_etl(lines: DataFrame, *, text_col: str = "value",
            prefilter: str | None = POST_PREFILTER, schema=LOG_LINE_SCHEMA,
            counts=None, **kwargs) -> DataFrame:
    """PL6/PL7: text lines holding one JSON object each.

    prefilter: cheap literal test on the raw line before decoding (pushed to
    the text scan); ``None`` decodes every line. Malformed lines decode to
    nulls and are removed by the method filter; ``counts`` (a ``StageCounts``)
    counts ``lines``, those that pass the prefilter, ``malformed`` ones among
    them, and rows ``written``.
    """
    def seen(df: DataFrame, name: str, where=None) -> DataFrame:
        return df if counts is None else counts.track(df, name, where)

    df = seen(lines, "lines").where(is_not_null(text_col))
    if prefilter:
        df = df.where(contains_text(text_col, prefilter))
    df = decode_once(seen(df, "prefiltered"), text_col, schema)
    df = select_columns(df, LOG_FOCUS_COLUMNS)
    empty = reduce(and_, [col(c).isNull() for c in LOG_FOCUS_COLUMNS])
    return seen(log_records_etl(seen(df, "malformed", empty), **kwargs), "written")


def passthrough(docs: DataFrame, partition_key: str | None = None) -> DataFrame:
    """PL10 on columns: rows unchanged; the sink partitions by ``partition_key``.

    With a key, rows are rebalanced on it so each output folder gets few,
    evenly sized files (adaptive execution splits a hot key's partition)."""
    if partition_key is None:
        return docs
    return docs.hint("rebalance", partition_key)


def passthrough_text(docs: DataFrame, document: str, partition_key: str) -> DataFrame:
    """PL10 on variants: every document as its JSON text with all the fields it
    has, beside the string field to partition by; rebalanced on that."""
    rows = docs.select(F.to_json(F.col(document)).alias("value"),
                       F.try_variant_get(document, f"$.{partition_key}", "string").alias(partition_key))
    return rows.hint("rebalance", partition_key)
