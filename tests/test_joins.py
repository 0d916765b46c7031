"""F1, F2, G1: enrichment equals the original join/distinct chain; salting is exact."""

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import plan_text
from unfurl.operators.joins import (SALT, Dim, HotKeys, detect_hot_keys, distinct_rows, enrich,
                                    left_join, salt_big_side)

keys = st.sampled_from(["k1", "k2", "k3", "k4", None])
small = st.sampled_from(["a", "b"])


def chain(base, dims, dedup_after):
    """The original jobs' literal order: join, then distinct, per flag."""
    out = base
    for (df, key), flag in zip(dims, dedup_after):
        out = out.join(df, key, "left")
        if flag:
            out = out.dropDuplicates()
    return out


def bag(df):
    cols = sorted(df.columns)
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(keys, small), min_size=1, max_size=12),
       st.lists(st.tuples(keys, small, small), max_size=8),
       st.lists(st.tuples(keys, small), max_size=8),
       st.sampled_from([(True, True), (True, False), (False, False), (False, True)]))
def test_enrich_equals_chain(spark, base_rows, d1_rows, d2_rows, flags):
    base = spark.createDataFrame(base_rows, "k string, item string")
    d1 = spark.createDataFrame(d1_rows, "k string, city string, extra string")
    d2 = spark.createDataFrame(d2_rows, "k string, email string")
    expected = chain(base, [(d1, "k"), (d2, "k")], flags)
    got = enrich(base, [Dim(d1, "k", None, dedup=flags[0]), Dim(d2, "k", None, dedup=flags[1])])
    assert bag(got) == bag(expected)


def test_duplicate_key_differing_in_dropped_column(spark):
    # Dedup runs before the final projection, so rows that differ only
    # in a column dropped afterwards stay apart.
    base = spark.createDataFrame([("o1", "i1")], "k string, item string")
    addr = spark.createDataFrame([("o1", "NY", "home"), ("o1", "NY", "work"),
                                  ("o1", "NY", "home")], "k string, city string, kind string")
    out = enrich(base, [Dim(addr, "k", None, dedup=True)]).select("k", "item", "city")
    assert out.count() == 2
    # Right keys are not unique, so without distinct the left row multiplies
    assert enrich(base, [Dim(addr, "k", None)]).count() == 3


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(keys, small), min_size=1, max_size=30),
       st.lists(st.tuples(keys, small), max_size=8), st.integers(2, 5))
def test_salted_join_is_exact(spark, base_rows, dim_rows, buckets):
    base = spark.createDataFrame(base_rows, "k string, item string")
    dim = spark.createDataFrame(dim_rows, "k string, city string")
    plain = enrich(base, [Dim(dim, "k")])
    hot = HotKeys({"k1": buckets, "k2": 2, "absent": 7})
    salted = enrich(base, [Dim(dim, "k")], skew=hot)
    assert bag(salted) == bag(plain)


def test_detect_hot_keys(spark):
    rows = [("hot", i) for i in range(300)] + [(f"c{i}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, v int")
    hot = detect_hot_keys(df, "k", rows_per_task=50, every=1)
    assert hot.buckets == {"hot": 6}
    dim = spark.createDataFrame([("hot", "x"), ("c1", "y")], "k string, d string")
    auto = enrich(df, [Dim(dim, "k")], skew="detect")
    assert bag(auto) == bag(enrich(df, [Dim(dim, "k")]))


def test_all_hot_keys_are_found(spark):
    # 400 keys over the threshold: none is left out
    rows = [(f"k{i % 400}", i) for i in range(4000)] + [(f"c{i}", i) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, v int")
    hot = detect_hot_keys(df, "k", rows_per_task=5, every=1)
    assert set(hot.keys) == {f"k{i}" for i in range(400)} and set(hot.buckets.values()) == {2}
    dim = spark.createDataFrame([(f"k{i}", str(i)) for i in range(0, 400, 3)], "k string, d string")
    assert bag(enrich(df, [Dim(dim, "k")], skew=hot)) == bag(left_join(df, dim, "k"))


def test_hot_keys_are_found_by_part_of_the_rows(spark):
    df = spark.range(200_000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) k").repartition(8)
    hot = detect_hot_keys(df, "k")
    assert hot.keys == ["hot"] and hot.buckets["hot"] == 2      # a third of the rows, over 4 partitions


def test_detection_does_not_grow_with_the_partitions(spark):
    """Every task sends one sketch, sketches merge on executors, only hot keys reach the driver."""
    from pyspark.sql import functions as F
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"))
    few, many = rows.repartition(4), rows.repartition(300)
    assert detect_hot_keys(few, "k", every=1).buckets == detect_hot_keys(many, "k", every=1).buckets == {"hot": 2}
    seen = []
    collect = type(rows).collect

    def counting(self):
        out = collect(self)
        seen.append((len(out), plan_text(self, "simple")))
        return out

    type(rows).collect = counting
    try:
        detect_hot_keys(many, "k", every=1)
    finally:
        type(rows).collect = collect
    assert [n for n, _ in seen] == [1]
    assert "TakeOrderedAndProject" not in seen[0][1] and "approx_top_k_combine" in seen[0][1]


def test_detection_takes_any_key_type(spark):
    import datetime
    for t in ("cast(id % 2 as int)", "cast(id % 2 as decimal(5,0))", "date_add(date'2024-01-01', cast(id % 2 as int))", "cast(cast(id % 2 as string) as binary)",
              "id % 2 = 0", "cast(id % 2 as double)", "array(id % 2)"):
        df = spark.range(9000).selectExpr(f"{t} k")
        hot = detect_hot_keys(df, "k", every=1) if not t.startswith("array") else None
        assert hot is None or sorted(hot.buckets.values()) == [2, 2], t
    assert detect_hot_keys(spark.createDataFrame([(None,)] * 50, "k date"), "k", every=1).buckets == {}
    assert detect_hot_keys(spark.createDataFrame([(datetime.date(2024, 1, 1),)], "k date").limit(0), "k").buckets == {}


def test_laid_out_tables_join_in_place(spark):
    """Bucketed inputs: no hash exchange for the three joins and their distincts."""
    from unfurl.operators.layout import enrich_laid_out, lay_out
    base = spark.range(400).selectExpr("cast(id % 97 as string) k", "id % 5 item").repartition(6)
    d1 = spark.range(150).selectExpr("cast(id % 90 as string) k", "id % 2 city")
    d2 = spark.range(120).selectExpr("cast(id as string) k", "'m' mail", "id extra")
    dims = [Dim(d1, "k", None, True), Dim(d2, "k", ["mail"], True)]
    out = enrich_laid_out(lay_out(base, dims, "t", buckets=4, hot=HotKeys()))
    assert "Exchange" not in plan_text(out, "simple").replace("ReusedExchange", "")
    assert bag(out) == bag(enrich(base, dims))
    plain = [Dim(d1, "k"), Dim(d2, "k", ["mail"])]
    assert bag(enrich_laid_out(lay_out(base, plain, "t", buckets=3, hot=HotKeys()))) == bag(enrich(base, plain))


def test_hot_and_null_keys_stay_out_of_the_buckets(spark):
    from unfurl.operators.layout import enrich_laid_out, lay_out
    base = spark.range(9000).selectExpr("case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else cast(id as string) end k", "id % 50 v")
    d1 = spark.range(4000).selectExpr("if(id < 3000, 'dim', cast(id as string)) k", "id % 4 city").union(
        spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3)], "k string, city long"))
    d2 = spark.createDataFrame([("hot", "x"), ("dim", "y"), ("5", "z")], "k string, mail string")
    layout = lay_out(base, [Dim(d1, "k"), Dim(d2, "k")], "skew", buckets=4)
    assert {"hot", "dim"} <= set(layout.hot.keys)
    assert layout.base.bucketed.where("k = 'hot' or k is null").count() == 0 and layout.dims[0].bucketed.where("k = 'dim'").count() == 0
    assert bag(enrich_laid_out(layout)) == bag(enrich(base, [Dim(d1, "k"), Dim(d2, "k")]))
    flagged = [Dim(d1, "k", None, True), Dim(d2, "k", None, True)]
    assert bag(enrich_laid_out(lay_out(base, flagged, "skew", buckets=4))) == bag(enrich(base, flagged))


def largest_bucket(df, key, hot):
    n = salt_big_side(df, key, hot).groupBy(key, SALT).count().agg({"count": "max"}).first()[0]
    return n / df.count()


def test_null_keys_are_spread(spark):
    df = spark.range(8000).selectExpr("cast(null as string) k", "id v").repartition(8)
    dim = spark.createDataFrame([(None, "x"), ("a", "y")], "k string, d string")
    assert largest_bucket(df, "k", HotKeys()) < 0.4       # over the session's 4 partitions
    out = enrich(df.union(spark.createDataFrame([("a", 1)], "k string, v long")), [Dim(dim, "k")])
    assert out.count() == 8001 and out.where("d is not null").count() == 1


def test_equal_rows_of_a_hot_key_are_spread(spark):
    df = spark.range(10000).selectExpr("'hot' k", "1 v").repartition(32)
    assert largest_bucket(df, "k", HotKeys({"hot": 8})) < 0.4
    dim = spark.createDataFrame([("hot", "x"), ("hot", "y")], "k string, d string")
    assert bag(enrich(df, [Dim(dim, "k")], skew="detect")) == {("x", "hot", 1): 10000, ("y", "hot", 1): 10000}


def test_dimension_hot_on_a_key_the_base_never_holds(spark):
    # two dimensions with 2,000 rows each on that key: no product of them is built
    hot = spark.range(2000).selectExpr("'absent' k", "id x")
    base = spark.createDataFrame([("a", 1)], "k string, v int")
    d1, d2 = hot.withColumnRenamed("x", "d1"), hot.withColumnRenamed("x", "d2")
    out = enrich(base, [Dim(d1, "k"), Dim(d2, "k")])
    assert [tuple(r) for r in out.collect()] == [("a", 1, None, None)]
    assert "FullOuter" not in plan_text(out, "simple")


def test_join_counts(spark):
    from unfurl.operators.metrics import StageCounts
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    d1 = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, d string")
    d2 = spark.createDataFrame([("a", "p")], "k string, e string")
    counts = StageCounts()
    enrich(base, [Dim(d1, "k"), Dim(d2, "k")], counts=counts).collect()
    assert counts.get() == {"join_1": 3, "join_2": 3}


def test_left_join_using_keeps_one_key(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "p"), (1, "q")], "k int, b string")
    out = left_join(a, b, "k")
    assert out.columns == ["k", "a", "b"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", "p"), (1, "x", "q"),
                                                        (2, "y", None)]


def test_distinct_rows_nested(spark):
    df = spark.createDataFrame([("a", [1], (1,)), ("a", [1], (1,)), ("a", [2], (1,))],
                               "k string, arr array<int>, s struct<x: int>")
    assert distinct_rows(df).count() == 2


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    from unfurl import catalog
    from unfurl.operators.layout import bucket_count

    assert [bucket_count(n) for n in (0, 600_000, 2_000_001, 36_000_000)] == [8, 8, 9, 144]
    seen = {}

    class Stop(Exception):
        pass

    def lay_out(base, dims, name, buckets):
        seen["buckets"] = buckets
        raise Stop

    monkeypatch.setattr(catalog, "lay_out", lay_out)
    monkeypatch.setattr(catalog, "_order_inputs", lambda *a: [spark.range(0)] * 4)
    monkeypatch.setattr(catalog, "flatten_items", lambda df: df)
    monkeypatch.setattr(catalog, "order_dims", lambda *a: [])
    monkeypatch.setattr(catalog.D, "tables", lambda *a: type("T", (), {"lineitem": spark.range(5_000_000)}))
    with pytest.raises(Stop):
        catalog.q_order_enrich_bucketed(spark, "")
    assert seen == {"buckets": 20}
