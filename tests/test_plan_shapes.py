"""Plan shapes that matter at scale: map-only jobs, pre-aggregation, one big join."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from unfurl.operators.joins import distinct_rows
from unfurl.plans.hits import hit_flatten
from unfurl.plans.logs import log_etl, passthrough
from unfurl.plans.orders import order_enrich
from unfurl.plans.sales import sales_by_sku
from unfurl.sources import derived as D
from unfurl.sources import files as SRC

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_log_etl_on_text_is_map_only(spark, tmp_dir):
    t = D.tables(spark, SF)
    path = D.stage_text_lines(D.log_lines(t.events), f"{tmp_dir}/lines", partition_by=["day"])
    plan = plan_text(log_etl(SRC.read_lines(spark, path, recursive=True)))
    assert "Exchange" not in plan
    assert "StringContains" in plan


def test_hit_flatten_is_map_only(spark):
    plan = plan_text(hit_flatten(D.search_hits(D.tables(spark, SF).events)))
    assert "Exchange" not in plan and "BatchEvalPython" not in plan


def test_grouped_sum_pre_aggregates(spark):
    plan = plan_text(sales_by_sku(D.sales(D.tables(spark, SF).lineitem)))
    assert plan.count("Exchange hashpartitioning") == 1 or plan.count("Exchange (") == 1
    assert "partial_sum" in plan


def test_distinct_pre_aggregates_on_all_columns(spark):
    df = D.tables(spark, SF).lineitem.select("l_orderkey", "l_returnflag")
    plan = plan_text(distinct_rows(df))
    assert "hashpartitioning(l_orderkey" in plan and "l_returnflag" in plan.split(
        "hashpartitioning(")[1].split(")")[0]
    assert plan.index("HashAggregate") < plan.rindex("HashAggregate")


def staged_orders(spark, tmp_dir):
    """Inputs read from files, as the jobs read them: no shuffle before the job's own."""
    t = D.tables(spark, SF)
    frames = (D.order_items(t.lineitem), D.order_address(t.orders, t.customer, t.nation),
              D.order_buyer_info(t.orders, t.customer), D.orders_info(t.orders))
    return [SRC.read_json_array(spark, D.stage_json_array(f, f"{tmp_dir}/{i}"), f.schema, recursive=True)
            for i, f in enumerate(frames)]


def hash_exchanges(df, spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan_text(df, "simple").count("Exchange hashpartitioning")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_order_enrich_moves_every_input_once(spark, tmp_dir):
    inputs = staged_orders(spark, tmp_dir)
    # PL2: the items and three dimensions, one exchange each
    assert hash_exchanges(order_enrich(*inputs, date_col="lastUpdateDate", dedup="none"), spark) == 4
    # PL1: one more, for the items' distinct on all columns with its map-side part
    out = order_enrich(*inputs, dedup="each")
    assert hash_exchanges(out, spark) == 5
    plan = plan_text(out, "simple")
    assert plan.count("LeftOuter") >= 3 and "FullOuter" not in plan


def test_hot_orders_keep_the_plan(spark, tmp_dir):
    from unfurl.operators.joins import HotKeys
    inputs = staged_orders(spark, tmp_dir)
    hot = HotKeys({"1": 4, "2": 3})
    assert hash_exchanges(order_enrich(*inputs, date_col="lastUpdateDate", dedup="none", skew=hot), spark) == 4


def test_partitioned_write_is_rebalanced(spark):
    df = passthrough(spark.range(10).withColumn("day", F.lit("2024-01-01")), "day")
    assert "REBALANCE" in plan_text(df, "simple").upper()


def test_stage_counts_keep_the_records_of_an_order(spark, monkeypatch):
    # one order holds all items, numbered through: no record may hold more than a page of them
    from unfurl import catalog
    t = D.tables(spark, SF)
    one = t.lineitem.withColumn("l_orderkey", F.lit(1)).withColumn("l_linenumber", F.monotonically_increasing_id() + 1)
    items = D.order_items(one)
    inputs = (items, *catalog._order_inputs(spark, SF)[1:])
    seen = []

    def enrich(records, *args, **kw):
        seen.append(records)
        return order_enrich(records, *args, **kw)

    monkeypatch.setattr(catalog, "_order_inputs", lambda *_: inputs)
    monkeypatch.setattr(catalog, "order_enrich", enrich)
    got = {r.stage: r.row_count for r in catalog.q_stage_counts(spark, SF).collect()}
    n = t.lineitem.count()
    assert got["order_items"] == seen[0].count() >= n // D.PAGE_ITEMS and got["items"] == n
    assert seen[0].agg(F.max(F.size("orderItems"))).first()[0] <= D.PAGE_ITEMS
