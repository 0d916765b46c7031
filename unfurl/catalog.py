"""Registered queries over the driver tables and their DuckDB SQL twins.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built by the
library's operators over whole tables. ``ORACLE_SQL`` holds the same result
written directly in SQL against the tables, with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans.hits import hit_flatten
from .plans.logs import log_etl
from .plans.orders import order_enrich, order_preview
from .plans.sales import sales_by_sku
from .sources import derived as D

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


# -- SQL building blocks mirroring the derived shapes -----------------------------

SQL_ORDER_ROWS = """
SELECT CAST(l.l_orderkey AS VARCHAR) AS amazonOrderId,
       lower(replace(c.c_name, '#', '.')) || '@example.com' AS buyerEmail,
       n.n_name AS countryCode,
       c.c_mktsegment AS city,
       strftime(o.o_orderdate, '%Y-%m-%d') AS order_date,
       strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') AS purchaseDate,
       strftime(o.o_orderdate + INTERVAL 36 HOUR, '%Y-%m-%dT%H:%M:%S') AS lastUpdateDate,
       o.o_orderstatus AS orderStatus,
       'SKU-' || CAST(l.l_partkey AS VARCHAR) AS SKU,
       CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS orderItemId,
       CAST(l.l_quantity AS BIGINT) AS quantity,
       l.l_extendedprice AS price
FROM lineitem l
LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
"""

# log line fields derived from events (see sources.derived.log_records)
SQL_LOG_ROWS = """
SELECT e.*,
       CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
       CASE WHEN value < 5 THEN NULL
            WHEN event_type = 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS log_timestamp,
       CASE WHEN value > 400 THEN ''
            ELSE 'user=' || CAST(user_id AS VARCHAR) || ' url=/' || event_type || '/'
                 || CAST(event_id AS VARCHAR) || ' method='
                 || CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END
                 || ' headers=k:' || json_extract_string(props, '$.k') END AS message
FROM events e
"""

SQL_LOG_OUTPUT = """
SELECT CASE WHEN log_timestamp IS NULL OR log_timestamp = '' THEN 'null_time'
            ELSE split_part(log_timestamp, ' ', 1) END AS log_date,
       log_timestamp,
       'user' || CAST(user_id AS VARCHAR) AS log_user,
       method,
       'host-' || event_type AS hostname,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS "@timestamp",
       '/' || event_type AS log_url,
       'req-' || CAST(event_id AS VARCHAR) AS request_id,
       event_type || '-log' AS fields_log_type,
       substr(message, instr(message, 'url=') + 4) AS message,
       '{"k":' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) || '}'
           AS postData
FROM (""" + SQL_LOG_ROWS + """) r
WHERE method = 'POST' AND message <> ''
"""


# -- whole jobs ------------------------------------------------------------------------

def _order_inputs(spark: SparkSession, sf_dir: str):
    t = D.tables(spark, sf_dir)
    return (D.order_items(t.lineitem), D.order_address(t.orders, t.customer, t.nation),
            D.order_buyer_info(t.orders, t.customer), D.orders_info(t.orders))


@register("order_enrich", f"""
SELECT DISTINCT amazonOrderId, buyerEmail, countryCode, city, order_date, purchaseDate,
       orderStatus, SKU, orderItemId, quantity, price
FROM ({SQL_ORDER_ROWS}) x
""")
def q_order_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL1: items exploded, three left joins with full-row distinct, order date."""
    items, address, buyer, orders = _order_inputs(spark, sf_dir)
    return order_enrich(items, address, buyer, orders, date_col="purchaseDate", dedup="each")


@register("order_enrich_nodedup", f"""
SELECT amazonOrderId, buyerEmail, countryCode, city, lastUpdateDate, orderStatus, SKU,
       orderItemId, quantity, price
FROM ({SQL_ORDER_ROWS}) x
""")
def q_order_enrich_nodedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL2: no distinct, ``lastUpdateDate``, no order date column."""
    items, address, buyer, orders = _order_inputs(spark, sf_dir)
    return order_enrich(items, address, buyer, orders, date_col="lastUpdateDate",
                        dedup="none", with_order_date=False)


@register("log_etl", SQL_LOG_OUTPUT)
def q_log_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL6: log text lines -> prefilter, decode once, filters, tail, log date."""
    lines = D.log_lines(D.tables(spark, sf_dir).events)
    return log_etl(lines)


# one row per request item; a hit without a request body gives one row
SQL_HITS = """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS log_timestamp,
       'user' || CAST(user_id AS VARCHAR) AS log_user,
       event_type || '-log' AS fields_log_type,
       CASE WHEN post THEN 'POST' ELSE 'GET' END AS method,
       CASE event_type WHEN 'view' THEN '[host-a, host-b]' WHEN 'error' THEN '[]'
            ELSE 'host-' || event_type END AS hostname,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS "@timestamp",
       '/' || event_type AS log_url,
       'req-' || CAST(event_id AS VARCHAR) AS request_id,
       'user=' || CAST(user_id AS VARCHAR) || ' url=/' || event_type || '/'
           || CAST(event_id AS VARCHAR) AS message,
       CASE WHEN post THEN 'user' || CAST(user_id AS VARCHAR) END AS body_name,
       CASE WHEN post THEN CAST(event_id AS VARCHAR) || ' Main St' END AS body_line1,
       CASE WHEN post THEN 'Unit ' || k END AS body_line2,
       CASE WHEN post THEN 'city-' || event_type END AS body_city,
       CASE WHEN post THEN 'WA' END AS body_state,
       CASE WHEN post THEN 'US' END AS body_country,
       CASE WHEN post THEN lpad(k, 5, '0') END AS body_postal,
       CASE WHEN post THEN 'SKU-' || k || '-' || CAST(i AS VARCHAR) END AS item_sku,
       CASE WHEN post THEN 'ASIN' || k END AS item_asin,
       CASE WHEN post THEN 'FN' || k END AS item_fnsku,
       CASE WHEN post THEN CAST(CAST(k AS INTEGER) + i AS INTEGER) END AS item_quantity,
       CASE WHEN post THEN CAST(event_id AS VARCHAR) || '-' || CAST(i AS VARCHAR) END AS item_ref,
       CASE WHEN post THEN value > 100 END AS body_cod,
       CASE WHEN post THEN false END AS body_windows,
       CASE WHEN post THEN false END AS body_blank_box,
       CASE WHEN post THEN true END AS body_block
FROM (SELECT *, event_type IN ('purchase', 'signup') AS post,
             json_extract_string(props, '$.k') AS k,
             unnest(range(1, CASE WHEN event_type IN ('purchase', 'signup')
                                  THEN event_id % 3 + 2 ELSE 2 END)) AS i FROM events)
"""


def _body_columns(df: DataFrame) -> DataFrame:
    """Every leaf of the request body, one row per item."""
    body = F.col("postData")
    own = [F.col(f"`{c}`") for c in df.columns if c != "postData"]
    df = df.select(*own, "postData", F.explode_outer(body["items"]).alias("item"))
    address, item = body["destinationAddress"], F.col("item")
    leaves = {
        "body_name": address["name"], "body_line1": address["line1"],
        "body_line2": address["line2"], "body_city": address["city"],
        "body_state": address["state"], "body_country": address["countryCode"],
        "body_postal": address["postalCode"], "item_sku": item["merchantSku"],
        "item_asin": item["asin"], "item_fnsku": item["fnSku"],
        "item_quantity": item["quantity"], "item_ref": item["referenceItemId"],
        "body_cod": body["shouldIncludeCOD"],
        "body_windows": body["shouldIncludeDeliveryWindows"],
        "body_blank_box": body["isBlankBoxRequired"], "body_block": body["blockAMZL"],
    }
    return df.select(*own, *[c.alias(n) for n, c in leaves.items()])


@register("hit_flatten", SQL_HITS)
def q_hit_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL4: hits -> fields.* -> '.'->'_' -> unwrap lists -> typed request body."""
    hits = D.search_hits(D.tables(spark, sf_dir).events)
    return _body_columns(hit_flatten(hits))


@register("sales_by_sku", """
SELECT 'SKU-' || CAST(l_partkey AS VARCHAR) AS sku,
       CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS qty,
       CAST(SUM(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(18, 2)))
            AS DOUBLE) AS revenue
FROM lineitem GROUP BY 1
""")
def q_sales_by_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL11/H1: SUM(qty), SUM(qty*price) per SKU."""
    return sales_by_sku(D.sales(D.tables(spark, sf_dir).lineitem))


# -- more whole-job variants ---------------------------------------------------------

@register("order_preview", f"""
SELECT amazonOrderId, buyerEmail, countryCode, city, order_date, lastUpdateDate, orderStatus,
       SKU, orderItemId, quantity, price
FROM (SELECT DISTINCT amazonOrderId, buyerEmail, countryCode, city, order_date, lastUpdateDate,
             orderStatus, SKU, orderItemId, quantity, price
      FROM ({SQL_ORDER_ROWS.replace("strftime(o.o_orderdate, '%Y-%m-%d') AS order_date",
                                    "strftime(o.o_orderdate + INTERVAL 36 HOUR, '%Y-%m-%d') AS order_date")}) x) y
ORDER BY orderItemId, SKU, price, quantity LIMIT 10
""")
def q_order_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL3 + B6: distinct after the address join only, lastUpdateDate, first 10
    rows in a stated order (a top-k, not a full sort)."""
    items, address, buyer, orders = _order_inputs(spark, sf_dir)
    enriched = order_enrich(items, address, buyer, orders, date_col="lastUpdateDate",
                            dedup="first")
    return order_preview(enriched, 10, ["orderItemId", "SKU", "price", "quantity"])


SQL_HITS_TAIL = """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS log_timestamp,
       'user' || CAST(user_id AS VARCHAR) AS log_user,
       event_type || '-log' AS fields_log_type,
       CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
       CASE event_type WHEN 'view' THEN '[host-a, host-b]' WHEN 'error' THEN '[]'
            ELSE 'host-' || event_type END AS hostname,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS "@timestamp",
       '/' || event_type AS log_url,
       'req-' || CAST(event_id AS VARCHAR) AS request_id,
       '/' || event_type || '/' || CAST(event_id AS VARCHAR) AS message
FROM events
"""


@register("hit_flatten_tail", SQL_HITS_TAIL)
def q_hit_flatten_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL5: hits flattened, message tail after 'url=', request body left out."""
    hits = D.search_hits(D.tables(spark, sf_dir).events)
    df = hit_flatten(hits, body_schema=None, message_tail=True)
    return df.drop("postData")


def _log_no_date_sql() -> str:
    return SQL_LOG_OUTPUT.replace(
        """SELECT CASE WHEN log_timestamp IS NULL OR log_timestamp = '' THEN 'null_time'
            ELSE split_part(log_timestamp, ' ', 1) END AS log_date,
       log_timestamp,""", "SELECT log_timestamp,")


@register("log_etl_records", _log_no_date_sql())
def q_log_etl_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL9 on parsed records: method/message filters, fields.log_type, tail."""
    from .plans.logs import log_records_etl
    recs = D.log_records(D.tables(spark, sf_dir).events)
    recs = recs.withColumn("postData", F.to_json("postData"))
    return log_records_etl(recs, with_log_date=False)


# -- single operators ------------------------------------------------------------------

from .functions import text as TX  # noqa: E402
from .functions.jsoncols import decode_once, typed_body  # noqa: E402
from .operators import columns as C  # noqa: E402
from .operators.aggregate import row_count  # noqa: E402
from .operators.joins import distinct_rows, left_join  # noqa: E402
from .plans.orders import flatten_items  # noqa: E402
from .schemas import LOG_LINE_SCHEMA  # noqa: E402


@register("explode_items", """
SELECT CAST(l_orderkey AS VARCHAR) AS amazonOrderId,
       TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS price,
       CAST(l_quantity AS BIGINT) AS quantity,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS orderItemId,
       'SKU-' || CAST(l_partkey AS VARCHAR) AS SKU
FROM lineitem
""")
def q_explode_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + C3 + C4 + C8: nested items exploded back to one row per item."""
    return flatten_items(D.order_items(D.tables(spark, sf_dir).lineitem))


@register("left_join_using", """
SELECT l.l_orderkey AS orderkey, l.l_linenumber, l.l_quantity, o.o_orderstatus, o.o_totalprice
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
""")
def q_left_join_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    """left outer join USING one key column."""
    t = D.tables(spark, sf_dir)
    left = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity")
    right = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus", "o_totalprice")
    return left_join(left, right, "orderkey")


@register("distinct_rows", """
SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem
""")
def q_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: full-row distinct."""
    t = D.tables(spark, sf_dir)
    return distinct_rows(t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity"))


@register("row_count", "SELECT COUNT(*) AS row_count FROM lineitem")
def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: global row count."""
    return row_count(D.tables(spark, sf_dir).lineitem)


@register("text_contains", """
SELECT event_id, props FROM events WHERE contains(props, '"k": 1')
""")
def q_text_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal substring filter."""
    ev = D.tables(spark, sf_dir).events
    return ev.where(C.contains_text("props", '"k": 1')).select("event_id", "props")


@register("not_null_eq_nonempty", """
SELECT event_id, method, message FROM (""" + SQL_LOG_ROWS + """) r
WHERE method IS NOT NULL AND method = 'POST' AND message <> ''
""")
def q_not_null_eq_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + D2 + D3 chained."""
    ev = D.tables(spark, sf_dir).events
    recs = D.log_records(ev).select(
        "method", "message", F.regexp_extract("request_id", "req-(.*)", 1)
        .cast("bigint").alias("event_id"))
    return C.where_all(recs, C.is_not_null("method"), C.equals("method", "POST"),
                       C.non_empty("message")).select("event_id", "method", "message")


@register("json_body", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def q_json_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text -> typed struct -> leaf."""
    ev = D.tables(spark, sf_dir).events
    return ev.select("event_id", typed_body("props", "k int")["k"].alias("k"))


@register("json_string_leaf", """
SELECT 'req-' || CAST(event_id AS VARCHAR) AS request_id,
       '{"k":' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) || '}'
           AS postData,
       event_type || '-log' AS log_type
FROM events
""")
def q_json_string_leaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + I3: decode each log line once; an object under a string field
    arrives as compact JSON text."""
    lines = D.log_lines(D.tables(spark, sf_dir).events)
    dec = decode_once(lines, "value", LOG_LINE_SCHEMA)
    return dec.select("request_id", "postData", F.col("fields.log_type").alias("log_type"))


@register("unwrap_single", """
SELECT event_id,
       CASE event_type WHEN 'view' THEN '[host-a, host-b]' WHEN 'error' THEN '[]'
            ELSE 'host-' || event_type END AS hostname,
       '[' || CAST(event_id AS VARCHAR) || ', ' || CAST(user_id AS VARCHAR) || ']' AS pair,
       CAST(user_id AS VARCHAR) AS single_long
FROM events
""")
def q_unwrap_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-element lists unwrapped, other lists rendered as text."""
    ev = D.tables(spark, sf_dir).events
    arrays = ev.select("event_id", D._hostnames().alias("hostname"),
                       F.array("event_id", "user_id").alias("pair"),
                       F.array("user_id").alias("single_long"))
    return arrays.select("event_id", TX.unwrap_single("hostname").alias("hostname"),
                         TX.unwrap_single("pair").alias("pair"),
                         TX.unwrap_single("single_long").alias("single_long"))


@register("suffix_after", """
SELECT page_id,
       CASE WHEN url IS NULL OR url = '' THEN url
            WHEN instr(url, 'ref=') > 0 THEN substr(url, instr(url, 'ref=') + 4) END AS ref
FROM pages
""")
def q_suffix_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 (lenient): text after the first 'ref=' marker, null when absent."""
    pages = D.tables(spark, sf_dir).pages
    return pages.select("page_id", TX.suffix_after("url", "ref=", on_missing="null").alias("ref"))


@register("message_tail", """
SELECT event_id,
       CASE WHEN message = '' THEN message ELSE substr(message, instr(message, 'url=') + 4) END
           AS message
FROM (""" + SQL_LOG_ROWS + """) r
""")
def q_message_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 (strict): tail after 'url=' on every message; empty stays empty."""
    ev = D.tables(spark, sf_dir).events
    recs = D.log_records(ev).select(
        F.regexp_extract("request_id", "req-(.*)", 1).cast("bigint").alias("event_id"),
        "message")
    return recs.select("event_id", TX.suffix_after("message").alias("message"))


@register("date_prefix", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders
""")
def q_date_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date part before 'T' of an ISO timestamp text."""
    o = D.tables(spark, sf_dir).orders
    iso = F.date_format("o_orderdate", D.ISO_SECONDS)
    return o.select("o_orderkey", TX.extract_date(iso).alias("order_date"))


@register("log_date_prefix", """
SELECT event_id,
       CASE WHEN log_timestamp IS NULL OR log_timestamp = '' THEN 'null_time'
            ELSE split_part(log_timestamp, ' ', 1) END AS log_date
FROM (""" + SQL_LOG_ROWS + """) r
""")
def q_log_date_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text before the first space; missing -> 'null_time'; ISO 'T' text
    has no space and is kept whole."""
    ev = D.tables(spark, sf_dir).events
    recs = D.log_records(ev).select(
        F.regexp_extract("request_id", "req-(.*)", 1).cast("bigint").alias("event_id"),
        "log_timestamp")
    return recs.select("event_id", TX.extract_log_date("log_timestamp").alias("log_date"))


@register("safe_cast", """
SELECT page_id, TRY_CAST(regexp_extract(url, '/([^/?#]*)([?#].*)?$', 1) AS DOUBLE) AS page_no
FROM pages
""")
def q_safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text -> double, null for text that is no number (the last path
    segment: numbers, numbers with a file ending, and nothing)."""
    pages = D.tables(spark, sf_dir).pages
    raw = F.regexp_extract("url", "/([^/?#]*)([?#].*)?$", 1)
    return pages.select("page_id", TX.safe_cast(raw, "double").alias("page_no"))


@register("sql_string_rules", """
SELECT event_id,
       CASE event_type WHEN 'view' THEN '[host-a, host-b]' WHEN 'error' THEN '[]'
            ELSE 'host-' || event_type END AS hostname,
       CASE WHEN message = '' THEN message ELSE substr(message, instr(message, 'url=') + 4) END
           AS tail,
       strftime(ts, '%Y-%m-%d') AS iso_date,
       CASE WHEN log_timestamp IS NULL THEN 'null_time'
            ELSE split_part(log_timestamp, ' ', 1) END AS log_date
FROM (""" + SQL_LOG_ROWS + """) r
""")
def q_sql_string_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: J1 to J4 called from SQL text."""
    TX.register_sql_functions(spark)
    ev = D.tables(spark, sf_dir).events
    rows = ev.select("event_id", D._hostnames().alias("hosts"), D._message().alias("message"),
                     F.date_format("ts", D.ISO_SECONDS).alias("iso"),
                     D._log_timestamp().alias("log_timestamp"))
    return spark.sql("SELECT event_id, unwrap_single(hosts) AS hostname, "
                     "extract_message(message) AS tail, extract_date(iso) AS iso_date, "
                     "extract_log_date(log_timestamp) AS log_date FROM {rows}", rows=rows)


@register("struct_expand", """
SELECT c_custkey, c_name AS name, c_mktsegment AS segment, n.n_name AS nation
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def q_struct_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 + C3: pack columns into a struct, then expand it back with ``s.*``
    and copy a nested leaf."""
    t = D.tables(spark, sf_dir)
    packed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"),
                             "left").select(
        "c_custkey",
        F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                 F.struct(F.col("n_name").alias("name")).alias("nation")).alias("info"))
    out = C.leaves(packed, {"nation": "info.nation.name"})
    return C.expand(out.withColumn("info", F.col("info").dropFields("nation")), "info",
                    keep=["c_custkey", "nation"])


@register("drop_cols", """
SELECT c_custkey, c_name FROM customer
""")
def q_drop_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: drop listed columns; absent names are ignored."""
    cust = D.tables(spark, sf_dir).customer
    return C.drop_columns(cust, "c_nationkey", "c_acctbal", "c_mktsegment", "no_such_column")


@register("dotted_rename", """
SELECT 'req-' || CAST(event_id AS VARCHAR) AS request_id,
       event_type || '-log' AS fields_log_type,
       event_type || '-log' AS fields_log_type_keyword,
       event_id AS log_offset
FROM events
""")
def q_dotted_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 + C5: expand hit fields, rename '.' to '_'."""
    hits = D.search_hits(D.tables(spark, sf_dir).events)
    df = C.sanitize_names(C.expand(hits, "fields"))
    return df.select(F.get("request_id", 0).alias("request_id"),
                     F.get("fields_log_type", 0).alias("fields_log_type"),
                     F.get("fields_log_type_keyword", 0).alias("fields_log_type_keyword"),
                     F.get("log_offset", 0).alias("log_offset"))


@register("map_columns", """
SELECT 'req-' || CAST(event_id AS VARCHAR) AS request_id,
       'user' || CAST(user_id AS VARCHAR) AS log_user,
       CASE event_type WHEN 'view' THEN '[host-a, host-b]' WHEN 'error' THEN '[]'
            ELSE 'host-' || event_type END AS hostname,
       CAST(event_id AS VARCHAR) AS log_offset
FROM events
""")
def q_map_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule (unwrap) over a list of columns in a single projection."""
    hits = D.search_hits(D.tables(spark, sf_dir).events)
    df = C.sanitize_names(C.expand(hits, "fields"))
    cols = ["request_id", "log_user", "hostname", "log_offset"]
    return C.select_columns(C.map_columns(df, cols, TX.unwrap_value), cols)


@register("ensure_columns", """
SELECT event_id, event_type, 'BAD' AS method FROM events
""")
def q_ensure_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add absent columns as constants; present ones are kept."""
    ev = D.tables(spark, sf_dir).events.select("event_id", "event_type")
    return C.ensure_columns(ev, {"method": "BAD", "event_type": "unused"})


# -- sources over staged files ---------------------------------------------------------

import datetime as _dt  # noqa: E402

from pyspark.sql import types as T  # noqa: E402

from .plans.logs import log_records_etl, passthrough_text  # noqa: E402
from .schemas import (ORDER_ADDRESS_SCHEMA, ORDER_BUYER_SCHEMA,  # noqa: E402
                      ORDER_ITEMS_SCHEMA, ORDERS_SCHEMA)
from .session import shared_path  # noqa: E402
from .sinks import read_folders, write_json, write_parquet, write_text  # noqa: E402
from .sinks.partitions import commits, list_files, replace_partitions  # noqa: E402
from .sources import arrivals as SRC_A  # noqa: E402
from .sources import files as SRC  # noqa: E402
from .sources.arrivals import ArrivalLedger  # noqa: E402
from .streaming.incremental import file_stream, run_batches, run_incremental  # noqa: E402
from .streaming.orders import OrderTable, run_orders  # noqa: E402
from .streaming.state import DistinctSink, SumsSink  # noqa: E402

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])
SQL_CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _stage(spark: SparkSession, name: str) -> str:
    return shared_path(spark, "stage", name, unique=True)


@register("read_array", SQL_CUSTOMER)
def q_read_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A7 + A12: root-array documents in subfolders, explicit schema."""
    path = D.stage_json_array(D.tables(spark, sf_dir).customer, _stage(spark, "cust_array"))
    return SRC.read_json_array(spark, path, CUSTOMER_SCHEMA, recursive=True)


@register("read_array_inferred", SQL_CUSTOMER)
def q_read_array_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A11: the same layout with the schema inferred (ints come back as
    bigint and are cast)."""
    path = D.stage_json_array(D.tables(spark, sf_dir).customer, _stage(spark, "cust_array_inf"))
    df = SRC.read_json_array(spark, path, None, recursive=True)
    return df.select("c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"),
                     "c_acctbal", "c_mktsegment")


@register("read_nested_array", SQL_CUSTOMER)
def q_read_nested_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: ``[[{...}], []]`` documents read by record path ``$[0][*]``."""
    path = D.stage_json_nested(D.tables(spark, sf_dir).customer, _stage(spark, "cust_nested"))
    return SRC.read_json_nested(spark, path, CUSTOMER_SCHEMA, recursive=True)


@register("read_nested_variant", SQL_CUSTOMER)
def q_read_nested_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 without a schema: the same documents walked as variants by ``$[0][*]``, leaves by path."""
    path = D.stage_json_nested(D.tables(spark, sf_dir).customer, _stage(spark, "cust_nested_v"))
    rows = SRC.read_json_path(spark, path, "$[0][*]", recursive=True)
    return rows.select(*[F.variant_get("record", f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
                         for f in CUSTOMER_SCHEMA.fields])


@register("read_array_one_pass", SQL_CUSTOMER)
def q_read_array_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 in one pass: the schema is merged over variants, one row per file, and then used to read."""
    path = D.stage_json_array(D.tables(spark, sf_dir).customer, _stage(spark, "cust_one_pass"))
    schema, _ = SRC.infer_schema(spark, path, recursive=True)
    df = SRC.read_json_array(spark, path, schema, recursive=True)
    return df.select("c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"),
                     "c_acctbal", "c_mktsegment")


@register("read_document", SQL_CUSTOMER)
def q_read_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: record path ``$`` - one row per document (the whole array), then
    exploded to check nothing is lost."""
    path = D.stage_json_array(D.tables(spark, sf_dir).customer, _stage(spark, "cust_doc"))
    docs = SRC.read_json_document(spark, path, T.ArrayType(CUSTOMER_SCHEMA), recursive=True)
    return docs.select(F.inline("document"))


@register("read_document_variant", SQL_CUSTOMER)
def q_read_document_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 without a schema: one variant per document, no field dropped, then its
    elements and leaves by path."""
    path = D.stage_json_array(D.tables(spark, sf_dir).customer, _stage(spark, "cust_variant"))
    docs = SRC.read_json_document(spark, path, recursive=True)
    rows = docs.lateralJoin(spark.tvf.variant_explode(F.col("document").outer())).select("value")
    return rows.select(*[F.variant_get("value", f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
                         for f in CUSTOMER_SCHEMA.fields])


def _stage_log_records(spark: SparkSession, sf_dir: str, name: str) -> str:
    recs = D.log_records(D.tables(spark, sf_dir).events)
    return D.stage_json_lines(recs, _stage(spark, name), partition_by=["day"])


@register("read_lines_json", _log_no_date_sql())
def q_read_lines_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + PL9: JSON lines with an explicit schema -> log ETL without date."""
    path = _stage_log_records(spark, sf_dir, "log_jsonl")
    recs = SRC.read_json_lines(spark, path, LOG_LINE_SCHEMA)
    return log_records_etl(recs, with_log_date=False)


@register("read_text", SQL_LOG_OUTPUT)
def q_read_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + A7 + PL6: text lines in daily subfolders -> full log ETL."""
    lines = D.log_lines(D.tables(spark, sf_dir).events)
    path = D.stage_text_lines(lines, _stage(spark, "log_text"), partition_by=["day"])
    return log_etl(SRC.read_lines(spark, path, recursive=True))


@register("read_glob", _log_no_date_sql())
def q_read_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + PL7: files selected by a ``*/*.txt`` glob -> log ETL without date."""
    lines = D.log_lines(D.tables(spark, sf_dir).events)
    path = D.stage_text_lines(lines, _stage(spark, "log_glob"), partition_by=["day"])
    return log_etl(SRC.read_lines(spark, f"{path}/*/*.txt"), with_log_date=False)


DAYS = (_dt.date(2024, 1, 5), _dt.date(2024, 1, 20))
SQL_DAYS = f"CAST(ts AS DATE) BETWEEN DATE '{DAYS[0]}' AND DATE '{DAYS[1]}'"


@register("read_daily_range", SQL_LOG_OUTPUT + f" AND {SQL_DAYS}")
def q_read_daily_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of days of a partitioned layout, pruned on the partition
    column -> log ETL."""
    path = _stage_log_records(spark, sf_dir, "log_daily")
    schema = T.StructType(LOG_LINE_SCHEMA.fields + [T.StructField("day", T.StringType())])
    recs = SRC.read_day_partitions(spark, path, "day", *DAYS, reader=SRC.read_json_lines,
                                   schema=schema)
    return log_records_etl(recs)


@register("read_daily_paths", SQL_LOG_OUTPUT + f" AND {SQL_DAYS}")
def q_read_daily_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same range as a list of folders, one per day, in one scan."""
    path = _stage_log_records(spark, sf_dir, "log_paths")
    recs = SRC.read_daily(spark, path + "/day={}", *DAYS, reader=SRC.read_json_lines,
                          schema=LOG_LINE_SCHEMA)
    return log_records_etl(recs)


def _stage_log_documents(spark: SparkSession, sf_dir: str, name: str, drop: list[str]) -> str:
    recs = D.log_records(D.tables(spark, sf_dir).events).drop("day", *drop)
    return D.stage_json_array(recs, _stage(spark, name), compression="gzip")


@register("log_etl_documents", SQL_LOG_OUTPUT)
def q_log_etl_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL8: multi-line log documents -> missing-column default (unused: the
    documents have ``method``) -> log ETL with date."""
    path = _stage_log_documents(spark, sf_dir, "log_docs", [])
    return log_records_etl(SRC.read_json_array(spark, path, LOG_LINE_SCHEMA, recursive=True),
                           method_default="BAD")


@register("log_etl_defaults", """
SELECT 'BAD' AS method, 'req-' || CAST(event_id AS VARCHAR) AS request_id,
       event_type || '-log' AS fields_log_type,
       CASE WHEN log_timestamp IS NULL OR log_timestamp = '' THEN 'null_time'
            ELSE split_part(log_timestamp, ' ', 1) END AS log_date
FROM (""" + SQL_LOG_ROWS + """) r WHERE message <> ''
""")
def q_log_etl_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL8: multi-line documents without ``method``: the default fires. The job
    keeps one method; asked for the default, it returns the rows it marked."""
    path = _stage_log_documents(spark, sf_dir, "log_docs_bad", ["method"])
    schema = T.StructType([f for f in LOG_LINE_SCHEMA.fields if f.name != "method"])
    recs = SRC.read_json_array(spark, path, schema, recursive=True)
    out = log_records_etl(recs, method="BAD", method_default="BAD")
    return out.select("method", "request_id", "fields_log_type", "log_date")


@register("hit_flatten_json", SQL_HITS)
def q_hit_flatten_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + PL4: multi-line hit documents, flattened."""
    hits = D.search_hits(D.tables(spark, sf_dir).events)
    path = D.stage_json_array(hits, _stage(spark, "hits"))
    return _body_columns(hit_flatten(SRC.read_json_array(spark, path, hits.schema, recursive=True)))


def _stage_orders(spark: SparkSession, sf_dir: str, nested: bool, doc_bytes: int = D.DOC_BYTES):
    items, address, buyer, orders = _order_inputs(spark, sf_dir)
    stage = D.stage_json_nested if nested else D.stage_json_array
    paths = [stage(df, _stage(spark, n), doc_bytes, "gzip") for df, n in
             [(items, "order_items"), (address, "order_address"), (buyer, "order_buyer_info")]]
    paths.append(D.stage_json_array(orders, _stage(spark, "orders"), doc_bytes, "gzip"))
    return paths


@register("order_enrich_json", ORACLE_SQL["order_enrich_nodedup"])
def q_order_enrich_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL2 end to end on files: three ``$[0][*]`` datasets and one ``$[*]``."""
    p_items, p_addr, p_buyer, p_orders = _stage_orders(spark, sf_dir, nested=True)
    items = SRC.read_json_nested(spark, p_items, ORDER_ITEMS_SCHEMA, recursive=True)
    address = SRC.read_json_nested(spark, p_addr, ORDER_ADDRESS_SCHEMA, recursive=True)
    buyer = SRC.read_json_nested(spark, p_buyer, ORDER_BUYER_SCHEMA, recursive=True)
    orders = SRC.read_json_array(spark, p_orders, ORDERS_SCHEMA, recursive=True)
    return order_enrich(items, address, buyer, orders, date_col="lastUpdateDate",
                        dedup="none", with_order_date=False)


# -- sinks, read back with the written schema ----------------------------------------------

@register("sink_parquet_partitioned", ORACLE_SQL["order_enrich"])
def q_sink_parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL1 end to end: four ``$[*]`` datasets -> enrich with distinct -> Parquet
    partitioned by order_date (B2) -> read back."""
    schemas = (ORDER_ITEMS_SCHEMA, ORDER_ADDRESS_SCHEMA, ORDER_BUYER_SCHEMA, ORDERS_SCHEMA)
    inputs = [SRC.read_json_array(spark, p, s, recursive=True)
              for p, s in zip(_stage_orders(spark, sf_dir, nested=False), schemas)]
    out = order_enrich(*inputs, date_col="purchaseDate", dedup="each")
    path = _stage(spark, "sink_parquet")
    write_parquet(out, path, mode="overwrite", partition_by=["order_date"])
    return spark.read.schema(out.schema).parquet(path)


@register("sink_json_partitioned", SQL_LOG_OUTPUT)
def q_sink_json_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: log ETL output as JSON partitioned by log_date, read back as text
    partition values."""
    out = log_etl(D.log_lines(D.tables(spark, sf_dir).events))
    path = _stage(spark, "sink_json_part")
    write_json(out, path, mode="overwrite", partition_by=["log_date"], many_folders=True)
    return read_folders(spark, path, out.schema, "json")


@register("sink_json", ORACLE_SQL["order_enrich_nodedup"])
def q_sink_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unpartitioned JSON output of PL2, read back."""
    out = q_order_enrich_nodedup(spark, sf_dir)
    path = _stage(spark, "sink_json")
    write_json(out, path, mode="overwrite", compression="gzip")
    return spark.read.schema(out.schema).json(path)


@register("sink_json_hits_tail", SQL_HITS_TAIL)
def q_sink_json_hits_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL5 to its sink: JSON written by all tasks (a single output file would pass
    everything through one), read back."""
    out = q_hit_flatten_tail(spark, sf_dir)
    path = _stage(spark, "sink_hits_tail")
    write_json(out, path, mode="overwrite")
    return spark.read.schema(out.schema).json(path)


@register("sink_json_hits_partitioned", SQL_HITS.replace("%Y-%m-%dT%H:%M:%S.%g", "%Y-%m-%dT%H:00:00"))
def q_sink_json_hits_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL4 to its sink: hits with the nested typed body as JSON partitioned by
    ``log_timestamp`` (stamped by the hour here), read back, every leaf compared."""
    out = hit_flatten(D.search_hits(D.tables(spark, sf_dir).events, hourly=True))
    path = _stage(spark, "sink_hits_part")
    write_json(out, path, mode="overwrite", partition_by=["log_timestamp"])
    return _body_columns(spark.read.schema(out.schema).json(path).select(*[C.col(c) for c in out.columns]))


@register("repartition_passthrough", """
SELECT strftime(ts, '%Y-%m-%d %H:00:00') AS log_timestamp, method,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS "@timestamp",
       'req-' || CAST(event_id AS VARCHAR) AS request_id, message,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS post_k,
       'user' || CAST(user_id AS VARCHAR) AS log_user, 'host-' || event_type AS hostname,
       '/' || event_type AS log_url, event_type || '-log' AS log_type,
       strftime(ts, '%Y-%m-%d') AS day, 'unlisted' AS extra
FROM (""" + SQL_LOG_ROWS + """) r
""")
def q_repartition_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PL10: whole documents (A3, no schema) passed through with every field they
    have, written by ``log_timestamp`` (stamped by the hour here), read back."""
    recs = D.log_records(D.tables(spark, sf_dir).events, hourly=True)
    src = D.stage_json_array(recs.withColumn("extra", F.lit("unlisted")), _stage(spark, "pass_src"))
    docs = SRC.read_json_document(spark, src, recursive=True)
    rows = docs.lateralJoin(spark.tvf.variant_explode(F.col("document").outer())).select("value")
    path = _stage(spark, "pass_out")
    write_text(passthrough_text(rows, "value", "log_timestamp"), path, mode="overwrite",
               partition_by=["log_timestamp"])
    return _passed_on(spark.read.schema("value string, log_timestamp string").text(path))


def _passed_on(back: DataFrame) -> DataFrame:
    """Leaves of documents that were passed on as text."""
    leaf = lambda p, t="string": F.variant_get(F.parse_json("value"), p, t)
    names = ["method", "@timestamp", "request_id", "message", "log_user", "hostname", "log_url",
             "day", "extra"]
    return back.select("log_timestamp", *[leaf(f"$['{c}']").alias(c) for c in names],
                       leaf("$.postData.k", "int").alias("post_k"),
                       leaf("$.fields.log_type").alias("log_type"))


# -- incremental ------------------------------------------------------------------------

CUT = "2024-01-16"


def _two_drops(spark: SparkSession, rows: DataFrame, cut, fmt: str, stream, transform, name: str,
               partition_by: list[str] | None = None, many_folders: bool = False) -> str:
    """Rows arrive in two drops; each run processes only new files, a third none."""
    src, sink, ckpt = (_stage(spark, f"{name}_{n}") for n in ("src", "sink", "ckpt"))
    drops = (rows.where(cut), rows.where(~cut | cut.isNull()))
    for i, drop in enumerate(drops):
        getattr(drop.drop("day").write.mode("overwrite"), fmt)(f"{src}/drop={i}")
        run_incremental(stream(f"{src}/*"), transform, sink, ckpt, partition_by=partition_by, many_folders=many_folders)
    run_incremental(stream(f"{src}/*"), transform, sink, ckpt, partition_by=partition_by, many_folders=many_folders)
    return sink


@register("incremental_log", SQL_LOG_OUTPUT)
def q_incremental_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: log lines in two drops, written by log_date."""
    lines = D.log_lines(D.tables(spark, sf_dir).events)
    stream = lambda p: file_stream(spark, p, "value string", fmt="text")
    sink = _two_drops(spark, lines, F.col("day") < CUT, "text", stream, log_etl, "inc_log",
                      ["log_date"], many_folders=True)
    schema = log_etl(lines.select("value")).schema
    return read_folders(spark, sink, schema, "parquet").select(*[C.col(c) for c in schema.names])


@register("incremental_hits", SQL_HITS)
def q_incremental_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + PL4: search hits in two drops, flattened with their typed body and
    written by log_date, read back, every leaf compared."""
    hits = D.search_hits(D.tables(spark, sf_dir).events)
    stream = lambda p: file_stream(spark, p, hits.schema)

    def flat(df: DataFrame) -> DataFrame:
        return hit_flatten(df).withColumn("log_date", TX.extract_date("log_timestamp"))

    cut = F.get("fields.log_timestamp", 0) < CUT
    sink = _two_drops(spark, hits, cut, "json", stream, flat, "inc_hits", ["log_date"])
    back = spark.read.schema(flat(hits).schema).parquet(sink)
    return _body_columns(back.select(*[C.col(c) for c in flat(hits).columns if c != "log_date"]))


@register("incremental_orders", ORACLE_SQL["order_enrich_nodedup"])
def q_incremental_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + PL2: order items arrive in two drops and are joined to static
    dimensions; the result is the batch job's."""
    items, address, buyer, orders = _order_inputs(spark, sf_dir)
    stream = lambda p: file_stream(spark, p, items.schema)

    def job(df: DataFrame) -> DataFrame:
        return order_enrich(df, address, buyer, orders, date_col="lastUpdateDate", dedup="none",
                            with_order_date=False, skew=None)

    cut = F.pmod(F.xxhash64("amazonOrderId"), F.lit(2)) == 0
    sink = _two_drops(spark, items, cut, "json", stream, job, "inc_orders")
    return spark.read.schema(job(items).schema).parquet(sink)


@register("incremental_documents", SQL_LOG_OUTPUT)
def q_incremental_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + PL8: multi-line log documents in two drops, the method default on, then the log job."""
    recs = D.log_records(D.tables(spark, sf_dir).events)
    src, sink, ckpt = (_stage(spark, f"inc_docs_{n}") for n in ("src", "sink", "ckpt"))
    job = lambda df: log_records_etl(df, method_default="BAD")
    for i, drop in enumerate((recs.where(F.col("day") < CUT), recs.where(F.col("day") >= CUT))):
        D.stage_json_array(drop.drop("day"), f"{src}/drop={i}", compression="gzip")
        run_incremental(file_stream(spark, f"{src}/*/docs", LOG_LINE_SCHEMA, multiLine="true"), job, sink, ckpt)
    return spark.read.schema(job(SRC.read_json_array(spark, f"{src}/*/docs", LOG_LINE_SCHEMA)).schema).parquet(sink)


@register("incremental_passthrough", ORACLE_SQL["repartition_passthrough"])
def q_incremental_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + PL10: whole documents in two drops, every field passed on, written by ``log_timestamp``
    into a folder per batch, read back."""
    recs = D.log_records(D.tables(spark, sf_dir).events, hourly=True).withColumn("extra", F.lit("unlisted"))
    src, sink = (_stage(spark, f"inc_pass_{n}") for n in ("src", "sink"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        docs = batch.select(F.try_parse_json("value").alias("document"))
        rows = docs.lateralJoin(batch.sparkSession.tvf.variant_explode(F.col("document").outer())).select("value")
        write_text(passthrough_text(rows, "value", "log_timestamp"), f"{sink}/batch={batch_id}", mode="overwrite",
                   partition_by=["log_timestamp"])

    for i, drop in enumerate((recs.where(F.col("day") < CUT), recs.where(F.col("day") >= CUT))):
        D.stage_json_array(drop, f"{src}/drop={i}")
        run_batches(file_stream(spark, f"{src}/*/docs", "value string", fmt="text", wholetext="true"), handle, f"{sink}.checkpoint")
    return _passed_on(spark.read.schema("value string, log_timestamp string").text(sink))


def _mod(c: str, n: int):
    return F.pmod(F.xxhash64(c), F.lit(n))


@register("incremental_late_dimensions", ORACLE_SQL["order_enrich"])
def q_incremental_late_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + PL1: all four inputs arrive in drops, dimensions partly after the items they belong to,
    some records twice. Orders that a late record touches are joined anew and their partitions
    rewritten, so that the table equals the batch job."""
    items, address, buyer, orders = _order_inputs(spark, sf_dir)
    k = "amazonOrderId"
    drops = [    # a part of each input per drop: first items alone, then what belongs to them
        {"items": items.where(_mod(k, 3) < 2), "address": address.where(_mod(k, 3) == 1)},
        {"address": address.where(_mod(k, 3) == 0), "buyer": buyer.where(_mod(k, 5) < 4), "orders": orders.where(_mod(k, 2) == 0)},
        {"items": items.where(_mod(k, 3) > 0), "address": address.where(_mod(k, 3) == 2), "buyer": buyer, "orders": orders},
    ]
    schemas = {"items": items.schema, "address": address.schema, "buyer": buyer.schema, "orders": orders.schema}
    src = {n: _stage(spark, f"late_{n}") for n in schemas}

    def job(*inputs: DataFrame, **kwargs) -> DataFrame:     # by month here: few folders for few rows
        return order_enrich(*inputs, **kwargs).withColumn("order_month", F.substring("order_date", 1, 7))

    table = OrderTable(spark, _stage(spark, "late_table"), schemas, job, partition="order_month")
    for i, drop in enumerate(drops):
        for n, schema in schemas.items():
            write_json(drop.get(n, spark.createDataFrame([], schema)), f"{src[n]}/drop={i}", mode="error", compression="gzip")
        run_orders(table, {n: file_stream(spark, f"{src[n]}/*", schema) for n, schema in schemas.items()},
                   f"{table.root}/checkpoint")
    return table.read().drop("order_month")


@register("incremental_distinct", "SELECT DISTINCT * FROM (" + SQL_LOG_OUTPUT + ") x")
def q_incremental_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + G1: a drop delivered twice, and one that repeats rows of an earlier one; every row is
    written once, by a ledger of row digests."""
    lines = D.log_lines(D.tables(spark, sf_dir).events)
    src = _stage(spark, "distinct_src")
    schema = log_etl(lines.select("value")).schema
    sink = DistinctSink(spark, _stage(spark, "distinct_sink"), _stage(spark, "distinct_ledger"), schema)
    half = F.col("day") < CUT
    drops = [lines.where(half), lines.where(half), lines.where(~half).unionByName(lines.where(half & (_mod("value", 4) == 0)))]
    for i, drop in enumerate(drops):
        drop.select("value").write.text(f"{src}/drop={i}")
        run_batches(log_etl(file_stream(spark, f"{src}/*", "value string", fmt="text")), sink, f"{sink.sink}.checkpoint")
        if i == 1:
            sink.compact(i)
    return sink.read(spark).select(*[C.col(c) for c in schema.names])


@register("incremental_sums", ORACLE_SQL["sales_by_sku"])
def q_incremental_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + H1: sums per SKU over three drops; the second batch is handed over twice, as after a
    crash between its writes and its commit."""
    sales = D.sales(D.tables(spark, sf_dir).lineitem)
    src = _stage(spark, "sums_src")
    sums = SumsSink(spark, _stage(spark, "sums"), sales, compact_every=2)

    def handle(batch: DataFrame, batch_id: int) -> None:
        sums(batch, batch_id)
        if batch_id == 1:
            sums(batch, batch_id)

    for i in range(3):
        sales.where(F.pmod(F.xxhash64("sku", "qty", "price"), F.lit(3)) == i).write.parquet(f"{src}/drop={i}")
        run_batches(file_stream(spark, f"{src}/*", sales.schema, fmt="parquet"), handle, f"{src}.checkpoint")
    return sums.read()


RERUN = "2024-01-10"


def _rerun_day(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The log job's output by day, in which one day was first written short and then re-run."""
    out = log_etl(D.log_lines(D.tables(spark, sf_dir).events)).withColumn("day", F.substring("log_date", 1, 10))
    path = _stage(spark, "rerun")
    short = out.where((F.col("day") != RERUN) | (_mod("request_id", 2) == 0))
    replace_partitions(short, path, partition_by=["day"], run="all")
    again = out.where(F.col("day") == RERUN)
    replace_partitions(again, path, partition_by=["day"], run="again")
    replace_partitions(again.limit(0), path, partition_by=["day"], run="again")     # committed before: nothing is done
    return out, path


@register("rerun_partition", SQL_LOG_OUTPUT)
def q_rerun_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1/B2 + A10: a day is re-run and replaces its own folder only; the table as it is then."""
    out, path = _rerun_day(spark, sf_dir)
    return spark.read.schema(out.schema).parquet(path).select(*[C.col(c) for c in out.columns if c != "day"])


@register("rerun_commits", f"""
WITH r AS (SELECT substr(log_date, 1, 10) AS day FROM ({SQL_LOG_OUTPUT}) x)
SELECT CASE WHEN day = '{RERUN}' THEN 'again' ELSE 'all' END AS run, 'day=' || day AS partition, COUNT(*) AS row_count
FROM r GROUP BY 1, 2
""")
def q_rerun_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 + A10: rows of every partition as the commit records of the two runs state them, but for
    the files that the re-run replaced."""
    _, path = _rerun_day(spark, sf_dir)
    record = commits(spark, path).where("file IS NOT NULL").withColumn("name", F.substring_index("file", "/", -2))
    there = list_files(spark, path, "*.parquet").select(F.substring_index("path", "/", -2).alias("name"))
    return (record.join(there, "name", "left_semi").groupBy("run", "partition")
            .agg(F.sum("rows").alias("row_count")))


# -- arrivals ----------------------------------------------------------------------------------------

ABSENT, CHANGED = "2024-01-09", "2024-01-12"


@register("arrival_days", f"""
SELECT d.day, d.day = DATE '{CHANGED}' AND n IS NOT NULL AS changed, n IS NULL AS missing
FROM (SELECT CAST(unnest(generate_series(DATE '{DAYS[0]}', DATE '{DAYS[1]}', INTERVAL 1 DAY)) AS DATE) AS day) d
LEFT JOIN (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events WHERE CAST(ts AS DATE) <> DATE '{ABSENT}' GROUP BY 1) e
ON e.day = d.day
""")
def q_arrival_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 + A10: daily folders of which one never comes and one is replaced after it was seen; a
    ledger of files reports both."""
    recs = D.log_records(D.tables(spark, sf_dir).events).where(F.col("day") != ABSENT)
    root = D.stage_json_lines(recs, _stage(spark, "arrivals"), partition_by=["day"])
    ledger = ArrivalLedger(spark, _stage(spark, "arrival_ledger"), root)
    ledger.record(1)
    day = recs.where(F.col("day") == CHANGED).withColumn("message", F.concat("message", F.lit(" (corrected)")))
    day.drop("day").write.mode("overwrite").json(f"{root}/day={CHANGED}")
    found = ledger.record(2)
    # a replaced folder has files of other names: the old ones are gone, the new ones new
    again = found.where("status <> 'new'").select("day").distinct().withColumn("again", F.lit(True))
    days = ledger.days(*DAYS)
    return days.join(F.broadcast(again), "day", "left").select(
        "day", F.coalesce("again", F.lit(False)).alias("changed"), "missing")


@register("read_present_days", SQL_LOG_OUTPUT + f" AND {SQL_DAYS} AND CAST(ts AS DATE) <> DATE '{ABSENT}'")
def q_read_present_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of days of which one is missing, read in one scan over those that exist."""
    recs = D.log_records(D.tables(spark, sf_dir).events).where(F.col("day") != ABSENT)
    path = D.stage_json_lines(recs, _stage(spark, "present"), partition_by=["day"])
    df, missing = SRC_A.read_present_days(spark, path + "/day={}", *DAYS, reader=SRC.read_json_lines, schema=LOG_LINE_SCHEMA)
    return log_records_etl(df)


# -- observed counts ---------------------------------------------------------------------

from .operators.metrics import CommittedCounts, StageCounts  # noqa: E402


SQL_ENRICHED_ROWS = "SELECT COUNT(*) FROM (SELECT DISTINCT * FROM (" + SQL_ORDER_ROWS + ") x) y"


SQL_STAGE_COUNTS = f"""
SELECT 'order_items' AS stage, COUNT(*) AS row_count
FROM (SELECT DISTINCT l_orderkey, (l_linenumber - 1) // {D.PAGE_ITEMS} FROM lineitem) r
UNION ALL SELECT 'items', COUNT(*) FROM lineitem
UNION ALL SELECT 'address', COUNT(*) FROM orders
UNION ALL SELECT 'join_1', ({SQL_ENRICHED_ROWS})
UNION ALL SELECT 'buyer', COUNT(*) FROM orders
UNION ALL SELECT 'join_2', ({SQL_ENRICHED_ROWS})
UNION ALL SELECT 'orders', COUNT(*) FROM orders
UNION ALL SELECT 'join_3', ({SQL_ENRICHED_ROWS})
UNION ALL SELECT 'enriched', ({SQL_ENRICHED_ROWS})
"""


def _stage_counts(spark: SparkSession, sf_dir: str, counts: StageCounts) -> DataFrame:
    out = order_enrich(*_order_inputs(spark, sf_dir), dedup="each", counts=counts)
    out.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(counts.get().items()), "stage string, row_count bigint")


@register("stage_counts", SQL_STAGE_COUNTS)
def q_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at the nine points of PL1 (every input, the exploded items, after
    each join), observed during one action instead of a ``count()`` each."""
    return _stage_counts(spark, sf_dir, StageCounts())


@register("stage_counts_committed", SQL_STAGE_COUNTS)
def q_stage_counts_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same nine numbers from the footers of committed files, which no repeated task changes."""
    return _stage_counts(spark, sf_dir, CommittedCounts(spark))


@register("log_rejects", """
WITH r AS (SELECT *, event_id % 97 = 0 AS broken FROM (""" + SQL_LOG_ROWS + """))
SELECT 'lines' AS stage, COUNT(*) AS row_count FROM r
UNION ALL SELECT 'prefiltered', COUNT(*) FROM r WHERE method = 'POST'
UNION ALL SELECT 'malformed', COUNT(*) FROM r WHERE method = 'POST' AND broken
UNION ALL SELECT 'written', COUNT(*) FROM r WHERE method = 'POST' AND NOT broken AND message <> ''
""")
def q_log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 + T7: log lines of which some are cut off; the job drops them and counts
    what it drops."""
    events = D.tables(spark, sf_dir).events
    lines = D.log_lines(events).select("value", F.regexp_extract("value", '"req-(\\d+)"', 1)
                                       .cast("bigint").alias("event_id"))
    cut = F.when(F.col("event_id") % 97 == 0, F.substring("value", 1, 40)).otherwise(F.col("value"))
    path = D.stage_text_lines(lines.select(cut.alias("value")), _stage(spark, "log_broken"))
    counts = StageCounts()
    log_etl(SRC.read_lines(spark, path), counts=counts).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(counts.get().items()), "stage string, row_count bigint")


# -- skewed join key ------------------------------------------------------------------------

from .operators.joins import Dim, enrich  # noqa: E402


@register("left_join_skewed", """
SELECT l.l_orderkey, l.l_linenumber, l.k, o.o_orderstatus, o.o_totalprice
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_partkey % 3 = 0 THEN (SELECT min(o_orderkey) FROM orders)
                  WHEN l_partkey % 3 = 1 AND l_linenumber = 1 THEN NULL ELSE l_orderkey END AS k
      FROM lineitem) l
LEFT JOIN orders o ON o.o_orderkey = l.k
""")
def q_left_join_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 on a skewed key: a third of the line items share one order, some have
    none. ``skew="detect"`` finds such keys exactly and spreads them, so no task
    receives a whole hot key; the orders are sort-merge joined at any size."""
    t = D.tables(spark, sf_dir)
    hot = t.orders.agg(F.min("o_orderkey")).first()[0]
    k = (F.when(F.col("l_partkey") % 3 == 0, F.lit(hot))
         .when((F.col("l_partkey") % 3 == 1) & (F.col("l_linenumber") == 1), F.lit(None))
         .otherwise(F.col("l_orderkey")))
    base = t.lineitem.select("l_orderkey", "l_linenumber", k.cast("bigint").alias("k"))
    orders = t.orders.select(F.col("o_orderkey").alias("k"), "o_orderstatus", "o_totalprice")
    return enrich(base, [Dim(orders.hint("merge"), "k")], skew="detect").select(
        "l_orderkey", "l_linenumber", "k", "o_orderstatus", "o_totalprice")


# -- bucketed layout --------------------------------------------------------------------------

from .operators.layout import bucket_count, enrich_laid_out, lay_out  # noqa: E402
from .plans.orders import finish_orders, order_dims  # noqa: E402


@register("order_enrich_bucketed", ORACLE_SQL["order_enrich"])
def q_order_enrich_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 + PL1 on tables bucketed by the order once: joins and distincts move nothing."""
    items, address, buyer, orders = _order_inputs(spark, sf_dir)
    # the rows as the file footers state them
    buckets = bucket_count(row_count(D.tables(spark, sf_dir).lineitem).first()[0])
    layout = lay_out(flatten_items(items), order_dims(address, buyer, orders, "purchaseDate", "each"), "orders", buckets)
    return finish_orders(enrich_laid_out(layout), "purchaseDate", True)
