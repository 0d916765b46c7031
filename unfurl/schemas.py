"""Fixed schemas (A12) for the record layouts the jobs read.

Explicit schemas are the default for every source: they skip the inference
pass over the input, keep types stable across runs, and let a streaming query
start (a stream cannot infer).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# The field names and types of each record layout and the
# column orders of the job outputs below must equal those of the original
# jobs for results to match; they are data-model values, listed in their
# natural order.

# One operation-log line (a JSON object per text line).
LOG_FIELDS_SCHEMA = T.StructType([T.StructField("log_type", S)])
LOG_LINE_SCHEMA = T.StructType([
    T.StructField("method", S),
    T.StructField("@timestamp", S),
    T.StructField("request_id", S),
    T.StructField("log_timestamp", S),
    T.StructField("message", S),
    T.StructField("postData", S),
    T.StructField("log_user", S),
    T.StructField("hostname", S),
    T.StructField("log_url", S),
    T.StructField("fields", LOG_FIELDS_SCHEMA),
])

# Columns the log jobs keep, in output order.
LOG_FOCUS_COLUMNS = ["log_timestamp", "log_user", "method", "hostname", "@timestamp",
                     "log_url", "request_id", "fields", "message", "postData"]
LOG_OUTPUT_COLUMNS = ["log_date", "log_timestamp", "log_user", "method", "hostname",
                      "@timestamp", "log_url", "request_id", "fields_log_type", "message",
                      "postData"]

# Search hit: fields of interest after '.' -> '_' renaming, in output order.
HIT_FOCUS_COLUMNS = ["log_timestamp", "log_user", "fields_log_type", "method", "hostname",
                     "@timestamp", "log_url", "request_id", "message", "postData"]

# Request body carried as JSON text in postData. The address holds line1 and
# line2 (the original declared line1 twice, which makes line1 ambiguous and
# drops line2; corrected on purpose).
ADDRESS_SCHEMA = T.StructType([
    T.StructField("name", S),
    T.StructField("line1", S),
    T.StructField("line2", S),
    T.StructField("city", S),
    T.StructField("state", S),
    T.StructField("countryCode", S),
    T.StructField("postalCode", S),
])
BODY_ITEM_SCHEMA = T.StructType([
    T.StructField("merchantSku", S),
    T.StructField("asin", S),
    T.StructField("fnSku", S),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("referenceItemId", S),
])
REQUEST_BODY_SCHEMA = T.StructType([
    T.StructField("destinationAddress", ADDRESS_SCHEMA),
    T.StructField("items", T.ArrayType(BODY_ITEM_SCHEMA)),
    T.StructField("shouldIncludeCOD", T.BooleanType()),
    T.StructField("shouldIncludeDeliveryWindows", T.BooleanType()),
    T.StructField("isBlankBoxRequired", T.BooleanType()),
    T.StructField("blockAMZL", T.BooleanType()),
])

# Order datasets keyed by amazonOrderId.
ORDER_ITEM_SCHEMA = T.StructType([
    T.StructField("orderItemId", S),
    T.StructField("sellerSKU", S),
    T.StructField("quantityOrdered", T.LongType()),
    T.StructField("itemPrice", T.StructType([T.StructField("amount", S)])),
])
ORDER_ITEMS_SCHEMA = T.StructType([
    T.StructField("amazonOrderId", S),
    T.StructField("nextToken", S),
    T.StructField("orderItems", T.ArrayType(ORDER_ITEM_SCHEMA)),
])
ORDER_ADDRESS_SCHEMA = T.StructType([
    T.StructField("amazonOrderId", S),
    T.StructField("shippingAddress", T.StructType([
        T.StructField("countryCode", S), T.StructField("city", S)])),
])
ORDER_BUYER_SCHEMA = T.StructType([
    T.StructField("amazonOrderId", S),
    T.StructField("buyerEmail", S),
])
ORDERS_SCHEMA = T.StructType([
    T.StructField("amazonOrderId", S),
    T.StructField("purchaseDate", S),
    T.StructField("lastUpdateDate", S),
    T.StructField("orderStatus", S),
])
