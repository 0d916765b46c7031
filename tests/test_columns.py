"""C1-C8, D1-D5, E1."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from unfurl.operators import columns as C


def test_sanitize_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, c int")
    assert C.sanitize_names(df).columns == ["a_b", "c"]


def test_sanitize_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, a_b int")
    with pytest.raises(C.ColumnNameCollision, match="a_b"):
        C.sanitize_names(df)


def test_ensure_columns(spark):
    df = spark.createDataFrame([("POST",)], "method string")
    out = C.ensure_columns(df, {"method": "BAD", "message": None})
    assert out.columns == ["method", "message"]
    assert tuple(out.first()) == ("POST", None)
    absent = C.ensure_columns(spark.createDataFrame([(1,)], "x int"), {"method": "BAD"})
    assert absent.first()["method"] == "BAD"


def test_explode_items(spark):
    df = spark.createDataFrame([("o1", [1, 2]), ("o2", []), ("o3", None)],
                               "id string, items array<int>")
    assert C.explode_items(df, "items").count() == 2
    outer = C.explode_items(df, "items", outer=True).orderBy("id", "item").collect()
    assert [(r.id, r.item) for r in outer] == [("o1", 1), ("o1", 2), ("o2", None), ("o3", None)]


def test_predicates(spark):
    df = spark.createDataFrame([("POST", "m"), ("POST", ""), ("GET", "m"), (None, "m"),
                                ("POST", None)], "method string, message string")
    out = C.where_all(df, C.is_not_null("method"), C.equals("method", "POST"),
                      C.non_empty("message"))
    assert [tuple(r) for r in out.collect()] == [("POST", "m")]


def test_leaves_and_expand(spark):
    df = spark.createDataFrame([("k", ("a", ("b",)))],
                               "k string, s struct<x: string, y: struct<z: string>>")
    out = C.leaves(df, {"z": "s.y.z"}, drop=["s"])
    assert tuple(out.first()) == ("k", "b")
    assert C.expand(df, "s", keep=["k"]).columns == ["k", "x", "y"]


def test_map_columns_single_projection(spark):
    df = spark.createDataFrame([(["a"], ["b", "c"])], "x array<string>, y array<string>")
    from unfurl.functions.text import unwrap_value
    out = C.map_columns(df, ["x", "y"], unwrap_value)
    assert tuple(out.first()) == ("a", "[b, c]")


def test_contains_pushed_to_text_scan(spark, tmp_dir):
    path = f"{tmp_dir}/lines"
    spark.createDataFrame([('{"method":"POST"}',), ("other",)], "value string") \
        .write.text(path)
    df = spark.read.text(path).where(C.contains_text("value", '"method":"POST"'))
    assert "StringContains" in plan_text(df)
    assert df.count() == 1


def test_select_special_names(spark):
    df = spark.createDataFrame([(1, 2)], "`@timestamp` int, `a.b` int")
    assert C.select_columns(df, ["a.b", "@timestamp"]).columns == ["a.b", "@timestamp"]
    assert C.drop_columns(df, "absent", "a.b").columns == ["@timestamp"]
