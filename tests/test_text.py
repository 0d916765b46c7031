"""Cases, and properties that any input must show."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from unfurl.functions import text as TX


def test_unwrap_cases(spark):
    rows = [(["x", "y"],), ([],), (None,), ([None],), (["a"],), (["x", None],)]
    df = spark.createDataFrame(rows, "a array<string>")
    got = [r[0] for r in df.select(TX.unwrap_single("a")).collect()]
    assert got == ["[x, y]", "[]", None, None, "a", "[x, null]"]


def test_unwrap_value_by_type(spark):
    df = spark.createDataFrame([("s", [7], 3)], "s string, l array<bigint>, n int")
    got = df.select(TX.unwrap_value(df, "s"), TX.unwrap_value(df, "l"),
                    TX.unwrap_value(df, "n")).first()
    assert tuple(got) == ("s", "7", "3")


texts = st.one_of(st.none(), st.text(alphabet="ab =url\nT-:", max_size=12))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.one_of(st.none(), st.text(max_size=4)),
                                               max_size=3)), min_size=1, max_size=20))
def test_unwrap_properties(spark, arrays):
    df = spark.createDataFrame([(a,) for a in arrays], "a array<string>")
    got = [r[0] for r in df.select(TX.unwrap_single("a")).collect()]
    for a, text in zip(arrays, got):
        if a is None:
            assert text is None
        elif len(a) != 1:
            assert text[0] == "[" and text[-1] == "]"
            assert len(text) == 2 + sum(4 if x is None else len(x) for x in a) + 2 * max(len(a) - 1, 0)
        else:
            assert text == a[0]


@settings(max_examples=30, deadline=None)
@given(st.lists(texts, min_size=1, max_size=25))
def test_dates_are_prefixes(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    for v, r in zip(values, df.select("s", TX.extract_date("s"), TX.extract_log_date("s")).collect()):
        _, day, log_day = r
        if not v:
            assert day is None and log_day == "null_time"
            continue
        for part, mark in ((day, "T"), (log_day, " ")):
            assert mark not in part and v.startswith(part)
            assert part == v or v[len(part)] == mark


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(texts, texts), min_size=1, max_size=25))
def test_tail_and_head_give_the_text(spark, pairs):
    # head + marker + tail is the text, and the head holds no earlier marker
    values = [f"{a or ''}url={b or ''}" for a, b in pairs]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    for v, (tail,) in zip(values, df.select(TX.suffix_after("s")).collect()):
        head = v[:len(v) - len(tail)]
        assert head + tail == v and head.endswith("url=") and head.find("url=") == len(head) - 4


def test_tail_cases(spark):
    rows = [("GET url=/a method=POST headers=x",), ("a url=b url=c",), ("",), (None,),
            ("x url=line1\nline2",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(TX.suffix_after("s")).collect()]
    assert got == ["/a method=POST headers=x", "b url=c", "", None, "line1\nline2"]


def test_tail_missing_marker(spark):
    df = spark.createDataFrame([("no marker here",)], "s string")
    with pytest.raises(Exception, match="not found"):
        df.select(TX.suffix_after("s")).collect()
    assert df.select(TX.suffix_after("s", on_missing="null")).first()[0] is None
    assert df.select(TX.suffix_after("s", on_missing="keep")).first()[0] == "no marker here"


def test_log_timestamp_forms(spark):
    rows = [("2021-10-01 05:50:08",), ("2021-10-22T05:50:08.563Z",), (None,), ("",),
            (" 2021-10-01 05:50",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(TX.extract_log_date("s")).collect()]
    assert got == ["2021-10-01", "2021-10-22T05:50:08.563Z", "null_time", "null_time", ""]
    iso = [r[0] for r in df.select(TX.extract_date("s")).collect()]
    assert iso == ["2021-10-01 05:50:08", "2021-10-22", None, None, " 2021-10-01 05:50"]


def test_safe_cast(spark):
    df = spark.createDataFrame([("12.5",), ("abc",), ("",), (None,)], "s string")
    got = [r[0] for r in df.select(TX.safe_cast("s")).collect()]
    assert got == [12.5, None, None, None]


def test_sql_functions(spark):
    TX.register_sql_functions(spark)
    row = spark.sql("SELECT extract_log_date('2021-10-01 05:50'), extract_date('2021-10-01T05'),"
                    " extract_message('x url=/y'), extract_log_date(NULL), unwrap_single(array('a')),"
                    " unwrap_single(array('a', NULL)), unwrap_single(array()), unwrap_single(NULL)").first()
    assert tuple(row) == ("2021-10-01", "2021-10-01", "/y", "null_time", "a", "[a, null]", "[]", None)


def test_native_rules_stay_in_jvm(spark):
    df = spark.createDataFrame([("a url=b", "2021-01-01 00:00")], "m string, t string")
    out = df.select(TX.suffix_after("m"), TX.extract_log_date("t"))
    from conftest import plan_text
    plan = plan_text(out)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
