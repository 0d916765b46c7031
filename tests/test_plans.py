"""Whole jobs on hand-made fixtures holding every case of FIXTURES.md."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from unfurl.operators.columns import ColumnNameCollision
from unfurl.plans.hits import hit_flatten
from unfurl.plans.logs import log_etl, log_records_etl
from unfurl.plans.orders import order_enrich
from unfurl.plans.sales import sales_by_sku
from unfurl.schemas import LOG_OUTPUT_COLUMNS


def line(**kw):
    base = {"method": "POST", "@timestamp": "2021-10-01T05:50:08Z", "request_id": "r",
            "log_timestamp": "2021-10-01 05:50:08", "message": "x url=/a/b method=POST",
            "postData": {"a": 1}, "log_user": "u", "hostname": "h", "log_url": "/a",
            "fields": {"log_type": "core-info-log"}}
    base.update(kw)
    return json.dumps(base, separators=(",", ":"))


LINES = [
    line(request_id="valid"),
    line(request_id="spaced").replace('"method":"POST"', '"method": "POST"'),
    line(request_id="get", method="GET", message='GET url=/x "method":"POST"'),
    '{"method":"POST", broken',
    "",
    line(request_id="empty", message=""),
    line(request_id="nullmsg", message=None),
    line(request_id="twourl", message="a url=b url=c"),
    line(request_id="newline", message="a url=/p\nsecond line"),
    line(request_id="strbody", postData='{"k":"v"}'),
    line(request_id="ts_t", log_timestamp="2021-10-22T05:50:08.563Z"),
    line(request_id="ts_null", log_timestamp=None),
    line(request_id="ts_empty", log_timestamp=""),
    line(request_id="ts_space", log_timestamp=" 2021-10-01 05:50"),
]


def lines_df(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_log_etl_cases(spark):
    out = {r.request_id: r for r in log_etl(lines_df(spark, LINES + [None])).collect()}
    assert set(out) == {"valid", "twourl", "newline", "strbody", "ts_t", "ts_null", "ts_empty",
                        "ts_space"}
    assert list(log_etl(lines_df(spark, LINES)).columns) == LOG_OUTPUT_COLUMNS
    v = out["valid"]
    assert (v.log_date, v.message, v.fields_log_type, v.postData) == (
        "2021-10-01", "/a/b method=POST", "core-info-log", '{"a":1}')
    assert out["twourl"].message == "b url=c"
    assert out["newline"].message == "/p\nsecond line"
    assert out["strbody"].postData == '{"k":"v"}'
    assert out["ts_t"].log_date == "2021-10-22T05:50:08.563Z"
    assert out["ts_null"].log_date == "null_time" and out["ts_empty"].log_date == "null_time"
    assert out["ts_space"].log_date == ""


def test_log_etl_without_prefilter_keeps_spaced_method(spark):
    out = log_etl(lines_df(spark, LINES), prefilter=None)
    assert "spaced" in {r.request_id for r in out.collect()}


def test_log_etl_missing_marker(spark):
    bad = lines_df(spark, [line(request_id="nourl", message="no marker")])
    with pytest.raises(Exception, match="not found"):
        log_etl(bad).collect()
    assert log_etl(bad, on_missing="null").first().message is None


def test_log_etl_plan_decodes_once_without_python(spark):
    plan = plan_text(log_etl(lines_df(spark, LINES)), "extended")
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("from_json") == 1
    assert "BatchEvalPython" not in physical and "ArrowEvalPython" not in physical


def test_log_records_default_method(spark):
    recs = spark.createDataFrame([("m url=/x", "2021-10-01 01:00", ("t",))],
                                 "message string, log_timestamp string, fields struct<log_type: string>")
    recs = recs.withColumns({c: F.lit(None).cast("string") for c in
                             ["@timestamp", "request_id", "postData", "log_user", "hostname",
                              "log_url"]})
    assert log_records_etl(recs, method_default="BAD").count() == 0
    assert log_records_etl(recs, method_default="POST").count() == 1


HIT_FIELDS = ("struct<log_timestamp: array<string>, log_user: array<string>, "
              "`fields.log_type`: array<string>, method: array<string>, hostname: array<string>, "
              "`@timestamp`: array<string>, log_url: array<string>, request_id: array<string>, "
              "message: array<string>, postData: array<string>>")


def hit(rid, hostname, body=None, message="m url=/x"):
    return (rid, (["2021-10-22T05:50:08.563Z"], ["u"], ["core"], ["POST"], hostname,
                  ["2021-10-22T05:50:08Z"], ["/a"], [rid], [message], [body]))


def test_hit_flatten_cases(spark):
    body = json.dumps({"destinationAddress": {"line1": "1 Main", "line2": "Unit 2",
                                              "city": "Town"},
                       "items": [{"merchantSku": "S1", "quantity": 2}],
                       "shouldIncludeCOD": True})
    rows = [hit("one", ["h1"], body), hit("two", ["h1", "h2"], "{\"items\": []}"),
            hit("empty", [], "not json"), hit("null", None, ""), hit("nullelem", [None]),
            ("nofields", None)]
    df = spark.createDataFrame(rows, f"_id string, fields {HIT_FIELDS}")
    out = {r.request_id: r for r in hit_flatten(df).collect()}
    assert set(out) == {"one", "two", "empty", "null", "nullelem"}
    assert out["one"].hostname == "h1" and out["two"].hostname == "[h1, h2]"
    assert out["empty"].hostname == "[]" and out["null"].hostname is None
    assert out["nullelem"].hostname is None
    b = out["one"].postData
    assert (b.destinationAddress.line2, b.items[0].quantity, b.shouldIncludeCOD) == (
        "Unit 2", 2, True)
    assert out["two"].postData.destinationAddress is None
    # text that is no JSON decodes to a struct of nulls (permissive mode)
    for rid in ("empty", "null"):
        body = out[rid].postData
        assert body is None or all(v is None for v in body)
    tail = {r.request_id: r.message for r in
            hit_flatten(df, body_schema=None, message_tail=True).collect()}
    assert tail["one"] == "/x"


def test_hit_flatten_name_collision(spark):
    df = spark.createDataFrame([(("a", "b"),)], "fields struct<`a.b`: string, a_b: string>")
    with pytest.raises(ColumnNameCollision):
        hit_flatten(df, columns=["a_b"])


ITEMS = ("amazonOrderId string, nextToken string, orderItems array<struct<orderItemId: string, "
         "sellerSKU: string, quantityOrdered: bigint, itemPrice: struct<amount: string>>>")


def test_order_enrich_cases(spark):
    items = spark.createDataFrame([
        ("o1", "t", [("i1", "S1", 2, ("9.5",)), ("i2", "S2", 1, ("abc",))]),
        ("o1", "t", [("i1", "S1", 2, ("9.5",)), ("i2", "S2", 1, ("abc",))]),  # exact duplicate
        ("o2", None, []),
        ("o3", None, None),
        ("o4", None, [("i4", None, None, None)]),  # missing fields
    ], ITEMS)
    addr = spark.createDataFrame([("o1", ("US", "NYC")), ("o1", ("US", "NYC")), ("o9", ("X", "Y"))],
                                 "amazonOrderId string, shippingAddress struct<countryCode: string, city: string>")
    buyer = spark.createDataFrame([("o1", "a@x"), ("o1", "b@x")], "amazonOrderId string, buyerEmail string")
    orders = spark.createDataFrame([("o1", "2021-10-01T10:00:00", "2021-10-02T00:00:00", "Shipped"),
                                    ("o4", "", "", "Pending")],
                                   "amazonOrderId string, purchaseDate string, lastUpdateDate string, orderStatus string")
    pl1 = order_enrich(items, addr, buyer, orders, dedup="each").collect()
    # o1: 2 items x 2 buyer emails after dedup; o4: 1 row; o2/o3 dropped
    assert len(pl1) == 5
    o1 = [r for r in pl1 if r.amazonOrderId == "o1"]
    assert {r.order_date for r in o1} == {"2021-10-01"}
    assert {r.price for r in o1} == {9.5, None}
    o4 = [r for r in pl1 if r.amazonOrderId == "o4"][0]
    assert o4.order_date is None and o4.countryCode is None and o4.SKU is None
    pl2 = order_enrich(items, addr, buyer, orders, date_col="lastUpdateDate", dedup="none",
                       with_order_date=False)
    assert "order_date" not in pl2.columns and pl2.count() == 2 * 2 * 2 * 2 + 1
    outer = order_enrich(items, addr, buyer, orders, dedup="each", outer_items=True)
    assert {r.amazonOrderId for r in outer.collect()} == {"o1", "o2", "o3", "o4"}


def test_sales_by_sku(spark):
    df = spark.createDataFrame([("A", 2, "1.10"), ("A", 3, "2.05"), ("B", 1, "0.10")],
                               "sku string, qty int, price string").withColumn(
        "price", F.col("price").cast("decimal(10,2)"))
    out = {r.sku: (r.qty, r.revenue) for r in sales_by_sku(df).collect()}
    assert out == {"A": (5, 8.35), "B": (1, 0.1)}


def test_sales_keep_every_digit(spark):
    from decimal import Decimal
    from unfurl.plans.sales import sales_by_sku
    for price, kind in ((0.004, "double"), ("0.004", "string"), (Decimal("0.004"), "decimal(10,4)")):
        df = spark.createDataFrame([("a", 1000, price), ("a", 500, price)], f"sku string, qty int, price {kind}")
        assert tuple(sales_by_sku(df).first()) == ("a", 1500, 6.0)
    df = spark.createDataFrame([("a", 2, "x"), ("a", 3, "1.5"), ("b", 1, None)], "sku string, qty int, price string")
    assert sorted(map(tuple, sales_by_sku(df).collect())) == [("a", 5, 4.5), ("b", 1, None)]
