"""The shape of the physical plans, on stored tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import intermediate, marts, pipeline, serving
from shelfwise.plans.contract import full_contract
from shelfwise.session import new_folder
from shelfwise.sources.standin import StandIn
from shelfwise.sources.tables import Warehouse
from oracles import PART_CATEGORIES

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def built(spark):
    warehouse = Warehouse(spark, new_folder(spark, "warehouse"))
    raw = StandIn(spark, FOLDER)
    at = F.to_timestamp(F.lit("2026-07-18 00:00:00"))
    return warehouse, raw, at, pipeline.build(raw, warehouse, at)


def test_build_twice_gives_the_same_tables(spark, built):
    warehouse, raw, at, first = built
    rows = {name: df.count() for name, df in first.items()}
    second = pipeline.build(raw, warehouse, at)
    assert {name: df.count() for name, df in second.items()} == rows
    assert rows["fct_sales"] == 5832 and rows["quarantine_sales"] == 168
    assert rows["suppliers_snapshot"] == rows["dim_suppliers"] == 10


def test_contract_on_a_build(spark, built):
    warehouse, raw, at, _ = built
    results = pipeline.check(warehouse, "r1", at, PART_CATEGORIES)
    assert results.count() == 119
    bad = {(r.table_name, r.column_name) for r in results.filter("not passed").collect()}
    # The stand-in inventory covers only the last week of the sales.
    assert bad == {("fct_sales", "sale_date")}


def test_latest_snapshot_prunes_partitions(spark, built):
    text = plan(serving.latest_snapshot(built[3]["fct_inventory"]))
    assert "PartitionFilters: [isnotnull(snapshot_date" in text
    assert "subquery" in text.split("PartitionFilters:")[1].split("\n")[0]


def test_demand_reads_four_columns_of_the_last_days(spark, built):
    text = plan(intermediate.daily_demand(built[3]["fct_sales"]))
    filters = [line for line in text.splitlines() if "PartitionFilters" in line]
    assert any("subquery" in line for line in filters)
    assert "unit_price_eur" not in text and "amount_eur" not in text


def test_at_risk_plan(spark, built):
    t = built[3]
    text = plan(serving.at_risk(
        t["fct_inventory"], t["dim_products"], t["dim_stores"], t["dim_suppliers"]))
    assert "TakeOrderedAndProject" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "LessThan(days_of_cover,7.0)" in pushed and "EqualTo(in_transit_qty,0)" in pushed


def test_fact_is_grouped_before_it_is_joined(spark, built):
    t = built[3]
    text = plan(serving.stockout_rate_by_tier(
        t["fct_inventory"], t["dim_products"], t["dim_suppliers"]))
    assert "ReadSchema: struct<product_id:string,is_stockout:boolean>" in text
    head = text.split("(1) Scan")[0]
    assert head.index("Join") < head.rindex("HashAggregate")


def test_masks_are_decided_at_planning_time(spark, built):
    dim = built[3]["dim_suppliers"]
    assert "supplier_name" not in plan(
        marts.dim_suppliers_secure(dim, "ANALYST").drop("nothing")
    ).split("ReadSchema:")[1].split("\n")[0]


def test_no_query_has_a_cross_or_nested_loop_join(spark):
    from __spark_entry__ import _warehouse_queries as queries

    # These store tables by day; what they store comes out of plans that other queries have too.
    writes_by_day = {"fct_sales_table_load", "pipeline_build", "union_by_name_load",
                     "positional_load", "changed_files", "stream_load", "raw_row_counts",
                     "raw_lineage", "zone_to_marts", "zone_second_build", "measured_run",
                     "stored_contract"}
    for name, query in queries().items():
        if name not in writes_by_day:
            text = plan(query(spark, FOLDER))
            assert "CartesianProduct" not in text, name
            assert "NestedLoop" not in text, name


def test_views(spark):
    pipeline.create_views(pipeline.Models(StandIn(spark, FOLDER)), ["stg_stores", "po_delays"])
    row = spark.sql("select (select count(*) from stg_stores), count(*) from po_delays").first()
    assert tuple(row) == (25, 1500)


def test_contract_names_only_known_tables():
    assert set(full_contract()) <= set(dir(pipeline.Models))


def test_inventory_is_not_broadcast_to_its_policy(spark):
    """Both sides of the join by series grow with the table, whatever the planner takes them for."""
    from __spark_entry__ import queries

    text = plan(queries()["replenishment_orders"](spark, FOLDER))
    assert re.search(r"SortMergeJoin.*\n(.*\n)?.*store_id", text)
    assert not re.search(r"Broadcast\w+Join.*\n.*store_id", text)
