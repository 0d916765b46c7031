"""Search-hit flattening (PL4, PL5).

hits -> fields not null -> fields.* -> rename '.' -> '_' -> unwrap the
one-element lists -> 10 columns -> typed request body (PL4) or message tail
(PL5). One projection chain, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsoncols import typed_body
from ..functions.text import URL_MARKER, suffix_after, unwrap_value
from ..operators.columns import (col, ensure_columns, expand, is_not_null, map_columns,
                                 sanitize_names, select_columns)
from ..schemas import HIT_FOCUS_COLUMNS, REQUEST_BODY_SCHEMA


def hit_flatten(hits: DataFrame, *, body_schema=REQUEST_BODY_SCHEMA,
                message_tail: bool = False, marker: str = URL_MARKER,
                on_missing: str = "error", columns: list[str] | None = None,
                fill_missing: bool = False) -> DataFrame:
    """PL4 (``body_schema`` set) and PL5 (``message_tail=True, body_schema=None``).

    fill_missing: add absent focus columns as nulls instead of failing.
    """
    columns = columns or HIT_FOCUS_COLUMNS
    df = expand(hits.where(is_not_null("fields")), "fields")
    df = sanitize_names(df, ".", "_")
    if fill_missing:
        df = ensure_columns(df, {c: F.lit(None).cast("string") for c in columns})
    df = map_columns(df, columns, unwrap_value)
    if message_tail:
        df = df.withColumn("message", suffix_after(col("message"), marker, on_missing))
    df = select_columns(df, columns)
    if body_schema is not None:
        df = df.withColumn("postData", typed_body(col("postData"), body_schema))
    return df
