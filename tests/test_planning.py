from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import date, timedelta

from pyspark.sql import functions as F

from shelfwise.operators import replenishment as planning
from shelfwise.operators import usage

START = date(2026, 7, 1)


def day(n):
    return START + timedelta(days=n)


def fixture(spark, hot: bool):
    """A small world; with ``hot`` one series holds most movements."""
    rnd = random.Random(7)
    series = [("A", "x"), ("A", "y"), ("B", "x")]
    inventory = [(day(d), *s, rnd.randint(0, 50)) for s in series for d in range(10) if d != 4]
    pick = lambda: series[0] if hot and rnd.random() < .8 else rnd.choice(series)
    sales = [(day(rnd.randint(-5, 14)), *pick(), rnd.randint(1, 5)) for _ in range(200)]
    orders = []
    for _ in range(200):
        placed = rnd.randint(-20, 14)
        arrives = placed + rnd.randint(0, 12) if rnd.random() < .8 else None
        qty = rnd.randint(1, 9)
        orders.append((day(placed), *pick(), qty,
                       None if arrives is None else day(arrives),
                       None if arrives is None else max(1, qty - rnd.randint(0, 1))))
    return (
        (inventory, spark.createDataFrame(
            inventory, "snapshot_date date, store_id string, product_id string, on_hand_qty int")),
        (sales, spark.createDataFrame(
            sales, "sale_date date, store_id string, product_id string, quantity int")),
        (orders, spark.createDataFrame(
            orders, "order_date date, store_id string, product_id string, ordered_qty int, "
            "actual_delivery_date date, received_qty int")),
    )


def test_ledger_against_brute_force(spark):
    for hot in (False, True):
        (inv, inv_df), (sold, sold_df), (po, po_df) = fixture(spark, hot)
        by_series = defaultdict(list)
        for d, s, p, q in sorted(inv):
            by_series[s, p].append((d, q))
        want = {}
        for (s, p), rows in by_series.items():
            for (d0, q0), (d1, q1) in zip(rows, rows[1:]):
                moved = sum(r for _, s_, p_, _, a, r in po
                            if (s_, p_) == (s, p) and a and d0 < a <= d1)
                moved -= sum(q for d, s_, p_, q in sold if (s_, p_) == (s, p) and d0 < d <= d1)
                want[d1, s, p] = (q0 + moved, q1 - q0 - moved)
        got = {(r.snapshot_date, r.store_id, r.product_id): (r.expected_qty, r.unexplained_qty)
               for r in planning.stock_ledger(inv_df, sold_df, po_df).collect()}
        assert got == want


def test_in_transit_against_brute_force(spark):
    for hot in (False, True):
        (inv, inv_df), _, (po, po_df) = fixture(spark, hot)
        want = {
            (d, s, p): sum(r if r is not None else o for placed, s_, p_, o, a, r in po
                           if (s_, p_) == (s, p) and placed < d and (a is None or a > d))
            for d, s, p, _ in inv
        }
        got = {(r.snapshot_date, r.store_id, r.product_id): r.derived_in_transit_qty
               for r in planning.in_transit(inv_df, po_df).collect()}
        assert got == want


def test_reorder_policy_and_orders(spark):
    demand = spark.createDataFrame(
        [("A", "x", 2.0)], "store_id string, product_id string, avg_daily_units double")
    products = spark.createDataFrame([("x", "s")], "product_id string, supplier_id string")
    suppliers = spark.createDataFrame(
        [("s", 8)], "supplier_id string, nominal_lead_time_days int")
    policy = planning.reorder_policy(demand, products, suppliers)
    row = policy.first()
    point = math.ceil(16 + 1.5 * 4)
    assert (row.policy_reorder_point, row.order_up_to) == (point, point + 28)
    latest = spark.createDataFrame(
        [("A", "x", q, t) for q, t in ((point, 0), (point + 1, 0), (0, 20))],
        "store_id string, product_id string, on_hand_qty int, in_transit_qty int")
    orders = planning.replenishment_orders(latest, policy).collect()
    assert [(r.on_hand_qty, r.order_qty) for r in orders] == [(point, 28)]


def test_weekday_profile_recovers_factors(spark):
    # Demand multipliers Monday to Sunday.
    factors = [0.9, 0.9, 0.95, 1.0, 1.15, 1.3, 0.6]
    monday = date(2026, 6, 1)
    rows = [(monday + timedelta(days=i), int(factors[i % 7] * 100)) for i in range(28)]
    df = spark.createDataFrame(rows, "sale_date date, quantity int")
    got = {r.iso_day_of_week: r.demand_factor for r in planning.weekday_profile(df).collect()}
    mean = sum(int(f * 100) for f in factors) / 7
    assert got == {i + 1: round(int(f * 100) / mean, 4) for i, f in enumerate(factors)}


def test_fill_rate(spark):
    df = spark.createDataFrame(
        [("s", 10, 10), ("s", 10, 6), ("s", 10, None), ("t", 0, 0)],
        "supplier_id string, ordered_qty int, received_qty int")
    got = {r.supplier_id: (r.delivered_orders, r.short_orders, r.fill_rate)
           for r in planning.fill_rate(df).collect()}
    assert got == {"s": (2, 1, 0.8), "t": (1, 0, None)}


def test_usage_reports(spark):
    log = spark.createDataFrame(
        [("big", 4.0), ("big", 2.0), ("small", 1.0), ("idle", None)],
        "resource string, amount double")
    got = [(r.resource, r.credits, r.cost_eur, r.metering_periods)
           for r in usage.usage_by_group(log).collect()]
    assert got == [("big", 6.0, 16.5, 2), ("small", 1.0, 2.75, 1), ("idle", 0.0, 0.0, 1),
                   ("TOTAL", 7.0, 19.25, 4)]
    assert tuple(usage.usage_total(log, "none").first()) == (0.0, 0.0)
    top = usage.busiest_types(log, rows=3).collect()
    assert [r.resource for r in top] == ["big", "small", "idle"] and top[2].seconds is None
    storage = spark.createDataFrame(
        [(day(0), 1e12, 1.0), (day(10), 2.0 * 2**30, None), (day(17), 4.0 * 2**30, None)],
        "usage_date date, storage_bytes double, stage_bytes double")
    row = usage.storage_average(storage, today=F.lit(day(17))).first()
    assert (row.table_gib, row.stage_gib) == (3.0, 0.0)
