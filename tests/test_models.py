from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from shelfwise.plans import intermediate, marts, serving

DAY = date.fromisoformat


def sales(spark, rows):
    return spark.createDataFrame(
        [(DAY(d), s, p, q, a) for d, s, p, q, a in rows],
        "sale_date date, store_id string, product_id string, quantity int, amount_eur double")


def test_demand_covers_28_days_up_to_the_global_last_day(spark):
    df = sales(spark, [
        ("2026-07-28", "A", "x", 28, 1.0), ("2026-07-01", "B", "x", 14, 1.0),
        ("2026-06-30", "B", "x", 99, 1.0), ("2026-07-10", "A", "x", 28, 1.0),
    ])
    got = {(r.store_id, r.product_id): (r.units_last_28d, r.avg_daily_units)
           for r in intermediate.daily_demand(df).collect()}
    assert got == {("A", "x"): (56, 2.0), ("B", "x"): (14, 0.5)}


def test_stock_status(spark):
    inventory = spark.createDataFrame(
        [(DAY("2026-07-28"), "A", "x", 0, 5, 0), (DAY("2026-07-28"), "A", "y", 5, 5, 0),
         (DAY("2026-07-28"), "A", "z", None, 5, 0)],
        "snapshot_date date, store_id string, product_id string, on_hand_qty int, "
        "reorder_point int, in_transit_qty int")
    demand = spark.createDataFrame(
        [("A", "x", 1.5), ("A", "y", 0.0)], "store_id string, product_id string, "
        "avg_daily_units double")
    got = {r.product_id: r for r in intermediate.stock_status(inventory, demand).collect()}
    assert got["x"].is_stockout and got["x"].days_of_cover == 0.0
    assert not got["y"].is_stockout and got["y"].below_reorder_point
    assert got["y"].days_of_cover is None
    assert got["z"].is_stockout is None and got["z"].avg_daily_units == 0.0


def orders(spark, rows):
    return spark.createDataFrame(
        [(i, DAY(o), s, "p", "st", 10, DAY(p) if p else None, DAY(a) if a else None,
          10 if a else None) for i, o, s, p, a in rows],
        "po_id string, order_date date, supplier_id string, product_id string, "
        "store_id string, ordered_qty int, promised_date date, actual_delivery_date date, "
        "received_qty int")


def test_delays(spark):
    df = orders(spark, [
        ("late", "2026-07-01", "S", "2026-07-05", "2026-07-08"),
        ("early", "2026-07-01", "S", "2026-07-05", "2026-07-04"),
        ("open", "2026-07-01", "S", "2026-07-05", None),
        ("vague", "2026-07-01", "S", None, "2026-07-04"),
    ])
    got = {r.po_id: r for r in intermediate.purchase_order_delays(df).collect()}
    assert (got["late"].delay_days, got["late"].is_late) == (3, True)
    assert (got["early"].delay_days, got["early"].is_late) == (-1, False)
    assert got["open"].is_open and got["open"].is_late is None
    assert got["open"].actual_lead_time_days is None
    assert got["vague"].is_late is False and got["vague"].promised_lead_time_days is None


def test_dimensions(spark):
    suppliers = spark.createDataFrame(
        [("a", .95), ("b", .85), ("c", .849), ("d", None)], "id string, reliability_score double")
    tiers = {r.id: r.t for r in suppliers.select(
        "id", marts.reliability_tier().alias("t")).collect()}
    assert tiers == {"a": "High", "b": "Medium", "c": "Low", "d": "Low"}
    products = spark.createDataFrame(
        [("p", "n", "c", "s", 6.0, 8.0), ("q", "n", "c", "s", 6.0, 0.0)],
        "product_id string, product_name string, category string, supplier_id string, "
        "unit_cost_eur double, unit_price_eur double")
    got = {r.product_id: r for r in marts.dim_products(products).collect()}
    assert (got["p"].unit_margin_eur, got["p"].margin_pct) == (2.0, 0.25)
    assert got["q"].margin_pct is None


def test_masking_by_role(spark):
    dim = spark.createDataFrame(
        [("s", "Acme", "FR", "Paris", 5, .9, "Medium", DAY("2026-01-01"))],
        "supplier_id string, supplier_name string, country string, city string, "
        "nominal_lead_time_days int, reliability_score double, reliability_tier string, "
        "valid_from date")
    hidden = marts.dim_suppliers_secure(dim, "ANALYST").first()
    assert hidden.supplier_name == "*** RESTRICTED ***"
    assert hidden.reliability_score is None and hidden.reliability_tier == "Medium"
    for role in ("ACCOUNTADMIN", "TRANSFORMER", "LOADER"):
        assert marts.dim_suppliers_secure(dim, role).first().supplier_name == "Acme"
    assert marts.dim_suppliers_secure(dim, "BUYER", ["BUYER"]).first().reliability_score == .9


def inventory_fact(spark, rows):
    return spark.createDataFrame(
        [(DAY(d), s, p, q, t, c, q == 0) for d, s, p, q, t, c in rows],
        "snapshot_date date, store_id string, product_id string, on_hand_qty int, "
        "in_transit_qty int, days_of_cover double, is_stockout boolean"
    ).withColumn("avg_daily_units", F.lit(1.234))


def test_kpis_store_choice(spark):
    stock = inventory_fact(spark, [
        ("2026-07-28", "A", "x", 0, 0, 0.0), ("2026-07-28", "B", "x", 3, 0, 6.9),
        ("2026-07-28", "B", "y", 3, 9, 1.0), ("2026-07-28", "B", "z", 3, 0, None),
        ("2026-07-27", "A", "y", 0, 0, 0.0),
    ])
    po = intermediate.purchase_order_delays(
        orders(spark, [("1", "2026-07-01", "S", "2026-07-05", None)]))
    sold = sales(spark, [("2026-07-28", "A", "x", 1, 10.4), ("2026-07-28", "B", "x", 1, 5.2)])
    assert tuple(serving.kpis(stock, po, sold).first()) == (1, 2, 1, 16.0)
    assert tuple(serving.kpis(stock, po, sold, ["B"]).first()) == (0, 1, 1, 5.0)
    assert tuple(serving.kpis(stock, po, sold, []).first()) == (0, 0, 1, None)
    assert serving.revenue_by_day(sold, []).count() == 0


def test_at_risk_order_and_limit(spark):
    stock = inventory_fact(spark, [
        ("2026-07-28", "A", "x", 1, 0, 2.0), ("2026-07-28", "B", "x", 1, 0, 1.0),
        ("2026-07-28", "A", "y", 1, 0, 1.0), ("2026-07-28", "A", "orphan", 1, 0, 0.5),
    ])
    products = spark.createDataFrame(
        [("x", "X", "c", "s"), ("y", "Y", "c", "s")],
        "product_id string, product_name string, category string, supplier_id string")
    stores = spark.createDataFrame([("A", "a"), ("B", "b")], "store_id string, store_name string")
    suppliers = spark.createDataFrame(
        [("s", "S", "Low")], "supplier_id string, supplier_name string, reliability_tier string")
    got = serving.at_risk(stock, products, stores, suppliers, rows=2).collect()
    assert [(r.store_name, r.product_name, r.daily_demand) for r in got] == [
        ("a", "Y", 1.23), ("b", "X", 1.23)]


def test_supplier_lateness_merges_equal_names(spark):
    rows = [(f"{s}{i}", "2026-07-01", s, "2026-07-05",
             "2026-07-07" if i < late else "2026-07-05")
            for s, n, late in (("S1", 15, 3), ("S2", 10, 2), ("S3", 20, 20), ("S4", 30, 0))
            for i in range(n)]
    suppliers = spark.createDataFrame(
        [("S1", "Same"), ("S2", "Same"), ("S3", "Few"), ("S4", "Punctual")],
        "supplier_id string, supplier_name string")
    po = intermediate.purchase_order_delays(orders(spark, rows))
    got = [tuple(r) for r in serving.supplier_lateness(po, suppliers).collect()]
    assert got == [("Same", 25, 20.0, 2.0), ("Punctual", 30, 0.0, None)]


def test_tiers_come_in_order(spark):
    stock = inventory_fact(spark, [("2026-07-28", "A", p, q, 0, None)
                                   for p, q in (("l", 0), ("m", 1), ("h", 1), ("l", 1))])
    products = spark.createDataFrame(
        [(p, p) for p in "lmh"], "product_id string, supplier_id string")
    suppliers = spark.createDataFrame(
        [("l", "Low"), ("m", "Medium"), ("h", "High")],
        "supplier_id string, reliability_tier string")
    got = [tuple(r) for r in serving.stockout_rate_by_tier(stock, products, suppliers).collect()]
    assert got == [("High", 0.0), ("Medium", 0.0), ("Low", 50.0)]
