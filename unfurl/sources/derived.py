"""Reference-shaped inputs derived by Spark from the TPC-H-like driver tables.

The jobs this library replaces read nested order JSON and operation logs. The
driver tables are flat Parquet, so these functions re-shape them - still as
distributed DataFrame plans whose work grows with the tables:

* ``lineitem``  -> ``order_items`` (items nested per order and page of a few items)
* ``orders``, ``customer``, ``nation`` -> address, buyer and order dimensions
* ``events``    -> operation-log records, log text lines, search hits
* ``lineitem``  -> ``sales(sku, qty, price)``

``stage_*`` functions write a frame in a given file layout (root JSON array
documents, nested arrays, JSON lines, text lines) to the shared folder, so the
file sources can be exercised on real files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import write_json, write_text

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


@dataclass
class Tables:
    spark: SparkSession
    root: str

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.root.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"

# -- orders domain -------------------------------------------------------------


PAGE_ITEMS = 4


def order_items(lineitem: DataFrame) -> DataFrame:
    """Nested order items: ``amazonOrderId, nextToken, orderItems[]``.

    Like a paginated feed, an order's items come in pages by item number: one order may span any
    number of records, and a record holds few items however many its order has.
    """
    item = F.struct(
        F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber")).alias("orderItemId"),
        F.concat(F.lit("SKU-"), _s("l_partkey")).alias("sellerSKU"),
        F.col("l_quantity").cast("bigint").alias("quantityOrdered"),
        F.struct(_s("l_extendedprice").alias("amount")).alias("itemPrice"),
    )
    page = F.floor((F.col("l_linenumber") - 1) / PAGE_ITEMS)
    flat = lineitem.select(_s("l_orderkey").alias("amazonOrderId"), item.alias("item"), page.alias("page"))
    return (flat.groupBy("amazonOrderId", "page")
            .agg(F.collect_list("item").alias("orderItems"))
            .select("amazonOrderId", F.lit(None).cast("string").alias("nextToken"),
                    "orderItems"))


def _order_customer(orders: DataFrame, customer: DataFrame) -> DataFrame:
    return orders.select("o_orderkey", "o_custkey").join(
        customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
        F.col("o_custkey") == F.col("c_custkey"))


def order_address(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """``amazonOrderId, shippingAddress{countryCode, city}`` per order."""
    oc = _order_customer(orders, customer)
    return (oc.join(nation.select("n_nationkey", "n_name"),
                    F.col("c_nationkey") == F.col("n_nationkey"))
            .select(_s("o_orderkey").alias("amazonOrderId"),
                    F.struct(F.col("n_name").alias("countryCode"),
                             F.col("c_mktsegment").alias("city")).alias("shippingAddress")))


def buyer_email(name: Column) -> Column:
    return F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@example.com"))


def order_buyer_info(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """``amazonOrderId, buyerEmail`` per order."""
    return _order_customer(orders, customer).select(
        _s("o_orderkey").alias("amazonOrderId"), buyer_email(F.col("c_name")).alias("buyerEmail"))


def orders_info(orders: DataFrame) -> DataFrame:
    """``amazonOrderId, purchaseDate, lastUpdateDate, orderStatus`` (ISO text)."""
    updated = F.col("o_orderdate") + F.expr("INTERVAL 36 HOURS")
    return orders.select(_s("o_orderkey").alias("amazonOrderId"),
                         F.date_format("o_orderdate", ISO_SECONDS).alias("purchaseDate"),
                         F.date_format(updated, ISO_SECONDS).alias("lastUpdateDate"),
                         F.col("o_orderstatus").alias("orderStatus"))


def sales(lineitem: DataFrame) -> DataFrame:
    """``sku string, qty int, price decimal(18,2)``, one row per line item."""
    return lineitem.select(F.concat(F.lit("SKU-"), _s("l_partkey")).alias("sku"),
                           F.col("l_quantity").cast("int").alias("qty"),
                           F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))


# -- log domain ----------------------------------------------------------------

def _method() -> Column:
    return F.when(F.col("event_type").isin("purchase", "signup"), F.lit("POST")).otherwise(
        F.lit("GET"))


def _log_timestamp() -> Column:
    # space form for most events, ISO 'T' form for signups, missing for small values
    spaced = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    iso = F.date_format("ts", ISO_SECONDS)
    return (F.when(F.col("value") < 5, F.lit(None).cast("string"))
            .when(F.col("event_type") == "signup", iso).otherwise(spaced))


def _message() -> Column:
    text = F.concat(F.lit("user="), _s("user_id"), F.lit(" url=/"), F.col("event_type"),
                    F.lit("/"), _s("event_id"), F.lit(" method="), _method(),
                    F.lit(" headers=k:"), F.get_json_object("props", "$.k"))
    return F.when(F.col("value") > 400, F.lit("")).otherwise(text)


def log_records(events: DataFrame, hourly: bool = False) -> DataFrame:
    """Operation-log records (the 10 fields of a log line) from ``events``;
    ``hourly`` cuts ``log_timestamp`` to the hour, as collectors that stamp
    batches do.

    ``postData`` is the event's JSON object, kept as an object so a
    string-typed decode yields its compact text."""
    return events.select(
        _method().alias("method"),
        F.date_format("ts", ISO_SECONDS + "'Z'").alias("@timestamp"),
        F.concat(F.lit("req-"), _s("event_id")).alias("request_id"),
        (F.date_format("ts", "yyyy-MM-dd HH:00:00") if hourly else _log_timestamp()).alias("log_timestamp"),
        _message().alias("message"),
        F.from_json("props", "k int").alias("postData"),
        F.concat(F.lit("user"), _s("user_id")).alias("log_user"),
        F.concat(F.lit("host-"), F.col("event_type")).alias("hostname"),
        F.concat(F.lit("/"), F.col("event_type")).alias("log_url"),
        F.struct(F.concat(F.col("event_type"), F.lit("-log")).alias("log_type")).alias("fields"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )


def log_lines(events: DataFrame) -> DataFrame:
    """One JSON text line per event in column ``value`` (compact, no spaces)."""
    rec = log_records(events)
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rec.columns if c != "day"]))
    # emitted through a generator so that filters on ``value`` run on the
    # built text instead of being pushed down as copies of the whole to_json
    return rec.select(F.inline(F.array(F.struct(text.alias("value"), F.col("day")))))


def request_body(events: DataFrame) -> Column:
    """JSON text of a request body derived from one event (POST events only)."""
    k = F.get_json_object("props", "$.k")
    body = F.struct(
        F.struct(F.concat(F.lit("user"), _s("user_id")).alias("name"),
                 F.concat(_s("event_id"), F.lit(" Main St")).alias("line1"),
                 F.concat(F.lit("Unit "), k).alias("line2"),
                 F.concat(F.lit("city-"), F.col("event_type")).alias("city"),
                 F.lit("WA").alias("state"), F.lit("US").alias("countryCode"),
                 F.lpad(k, 5, "0").alias("postalCode")).alias("destinationAddress"),
        # one to three items
        F.transform(F.sequence(F.lit(1), F.pmod(F.col("event_id"), F.lit(3)).cast("int") + 1), lambda i: F.struct(
            F.concat(F.lit("SKU-"), k, F.lit("-"), i.cast("string")).alias("merchantSku"),
            F.concat(F.lit("ASIN"), k).alias("asin"),
            F.concat(F.lit("FN"), k).alias("fnSku"),
            (k.cast("int") + i).alias("quantity"),
            F.concat_ws("-", _s("event_id"), i.cast("string")).alias("referenceItemId"))).alias("items"),
        (F.col("value") > 100).alias("shouldIncludeCOD"),
        F.lit(False).alias("shouldIncludeDeliveryWindows"),
        F.lit(False).alias("isBlankBoxRequired"),
        F.lit(True).alias("blockAMZL"),
    )
    return F.when(_method() == "POST", F.to_json(body))


def _hostnames() -> Column:
    # one value for most hits, two for views, none for errors
    return (F.when(F.col("event_type") == "view", F.array(F.lit("host-a"), F.lit("host-b")))
            .when(F.col("event_type") == "error", F.array().cast("array<string>"))
            .otherwise(F.array(F.concat(F.lit("host-"), F.col("event_type")))))


def search_hits(events: DataFrame, hourly: bool = False) -> DataFrame:
    """Search hits: ``_index, _type, _id, _version, _score, fields{...}`` where
    every field is a list and some keys contain dots. ``hourly`` cuts
    ``log_timestamp`` to the hour."""
    stamp = "yyyy-MM-dd'T'HH:00:00'Z'" if hourly else "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    one = lambda c: F.array(c)
    fields = F.struct(
        one(F.date_format("ts", stamp)).alias("log_timestamp"),
        one(F.concat(F.lit("user"), _s("user_id"))).alias("log_user"),
        one(F.concat(F.col("event_type"), F.lit("-log"))).alias("fields.log_type"),
        one(F.concat(F.col("event_type"), F.lit("-log"))).alias("fields.log_type.keyword"),
        one(_method()).alias("method"),
        _hostnames().alias("hostname"),
        one(F.date_format("ts", ISO_SECONDS + "'Z'")).alias("@timestamp"),
        one(F.concat(F.lit("/"), F.col("event_type"))).alias("log_url"),
        one(F.concat(F.lit("req-"), _s("event_id"))).alias("request_id"),
        one(F.concat(F.lit("user="), _s("user_id"), F.lit(" url=/"), F.col("event_type"),
                     F.lit("/"), _s("event_id"))).alias("message"),
        one(request_body(events)).alias("postData"),
        one(F.col("event_id")).alias("log.offset"),
    )
    return events.select(
        F.concat(F.lit("app-log-"), F.date_format("ts", "yyyy.MM.dd")).alias("_index"),
        F.lit("_doc").alias("_type"),
        F.concat(F.lit("hit-"), _s("event_id")).alias("_id"),
        F.lit(1).cast("bigint").alias("_version"),
        F.lit(None).cast("double").alias("_score"),
        fields.alias("fields"),
    )


# -- file layouts in the shared folder ------------------------------------------

DOC_BYTES = 8 << 20


def _documents(df: DataFrame, doc_bytes: int, before: str, after: str) -> DataFrame:
    """``df`` as documents of about ``doc_bytes`` (four at least), one per row.

    A row's document is a hash of its text and of the partition it comes from, so a
    task that runs again deals its rows to the same documents."""
    rows = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("j"))
    total = rows.agg(F.sum(F.octet_length("j"))).first()[0] or 0
    n = max(4, -(-total // doc_bytes))
    doc = F.pmod(F.xxhash64("j", F.spark_partition_id()), F.lit(n))
    docs = rows.groupBy(doc.alias("doc")).agg(F.collect_list("j").alias("items"))
    return docs.select(F.concat(F.lit(before), F.array_join("items", ","), F.lit(after)).alias("value"))


def stage_json_array(df: DataFrame, path: str, doc_bytes: int = DOC_BYTES, compression: str | None = None) -> str:
    """Write ``df`` as root-array documents ``[{...}, ...]``, one per file, in a
    subfolder (read back with ``recursive=True``). Every row is written.

    ``compression="gzip"``: Spark's multi-line reader goes back into a plain file for every
    object under a string field, and reads it some forty times over; a compressed one it reads once."""
    write_text(_documents(df, doc_bytes, "[", "]"), f"{path}/docs", mode="overwrite", file_per_row=True, compression=compression)
    return path


def stage_json_nested(df: DataFrame, path: str, doc_bytes: int = DOC_BYTES, compression: str | None = None) -> str:
    """Like ``stage_json_array`` with layout ``[[{...}, ...], []]``: records in
    the first inner array, an empty second one."""
    write_text(_documents(df, doc_bytes, "[[", "],[]]"), f"{path}/docs", mode="overwrite", file_per_row=True, compression=compression)
    return path


def stage_json_lines(df: DataFrame, path: str, partition_by: list[str] | None = None,
                     mode: str = "overwrite") -> str:
    write_json(df, path, mode=mode, partition_by=partition_by)
    return path


def stage_text_lines(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    write_text(df, path, mode="overwrite", partition_by=partition_by)
    return path

