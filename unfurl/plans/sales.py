"""Sales per SKU (PL11)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.aggregate import sales_by_key


def sales_by_sku(sales: DataFrame, sku: str = "sku", qty: str = "qty",
                 price: str = "price") -> DataFrame:
    """``SELECT sku, SUM(qty), SUM(qty*price) FROM test_tb GROUP BY sku``."""
    return sales_by_key(sales, sku, qty, price, qty_alias="qty", revenue_alias="revenue")
