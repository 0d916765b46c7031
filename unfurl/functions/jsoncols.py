"""JSON text columns (I1-I3): decode once, typed request bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decode_once(df: DataFrame, text_col: str, schema: T.StructType | str,
                keep: list[str] | None = None) -> DataFrame:
    """I1 + C2: parse a JSON text column and expand its fields to columns.

    ``inline(array(from_json(...)))`` makes the parse a generator, so filters
    written on the decoded fields are evaluated after one parse instead of
    Catalyst copying ``from_json`` into every pushed-down predicate. Malformed
    text gives a row of nulls (permissive mode), as a plain ``from_json`` does.
    """
    keep = keep or []
    parsed = F.from_json(F.col(text_col), schema)
    return df.select(*[F.col(k) for k in keep], F.inline(F.array(parsed)))


def typed_body(c: Column | str, schema: T.StructType | str) -> Column:
    """Replace JSON text by a typed struct; text that does not parse -> null
    fields, absent parts -> null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.from_json(col, schema)
