"""Grouped sums (H1) and row counts (H2).

Both are plain hash aggregations: Spark computes partial sums per task before
the shuffle, so even a key holding a third of all rows sends one partial row
per task to its reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import q


def _product(qty: Column, price: Column, price_type: T.DataType) -> Column:
    """Decimal and integral prices multiply exactly and keep their scale; double and
    text prices are doubles (text that is no number counts as null). Nothing is rounded."""
    if isinstance(price_type, (T.DecimalType, T.IntegralType)):
        return qty * price
    return qty * price.try_cast("double")


def sales_by_key(df: DataFrame, key: str = "sku", qty: str = "qty", price: str = "price",
                 qty_alias: str = "qty", revenue_alias: str = "revenue",
                 revenue_as_double: bool = True) -> DataFrame:
    """H1: ``SELECT key, SUM(qty), SUM(qty * price) FROM t GROUP BY key``.

    ``SUM(qty)`` is returned as bigint for integral quantities. Revenue of decimal
    prices is summed exactly and, by default, returned as double. Revenue of double
    or text prices is a sum of doubles: it keeps every digit of the prices, and its
    own last digit may depend on the order in which partial sums meet.
    """
    qty_type = df.schema[qty].dataType
    price_type = df.schema[price].dataType
    qty_c, price_c = F.col(q(qty)), F.col(q(price))
    total_qty = F.sum(qty_c)
    if isinstance(qty_type, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        total_qty = total_qty.cast("bigint")
    revenue = F.sum(_product(qty_c, price_c, price_type))
    if revenue_as_double:
        revenue = revenue.cast("double")
    return df.groupBy(F.col(q(key))).agg(total_qty.alias(qty_alias),
                                          revenue.alias(revenue_alias))


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """H2: global row count as a one-row frame (partial counts per task)."""
    return df.agg(F.count(F.lit(1)).alias(alias))
