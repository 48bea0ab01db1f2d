"""Planning measures: weekday profile, reorder policy, stock ledger, fill rate, in transit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfwise.functions import iso_day_of_week, round_to

# Fixed values of the reorder policy.
SAFETY_FACTOR = 1.5
COVER_DAYS = 14

SERIES = ("store_id", "product_id")


def weekday_profile(sales: DataFrame) -> DataFrame:
    """Mean daily units of each weekday relative to the mean of all days."""
    daily = sales.groupBy("sale_date").agg(F.sum("quantity").alias("units"))
    weekdays = daily.groupBy(iso_day_of_week("sale_date").alias("iso_day_of_week")).agg(
        F.count(F.lit(1)).alias("days"), F.sum("units").alias("units")
    )
    everything = Window.partitionBy(F.lit(1))  # at most seven rows
    overall = F.sum("units").over(everything) / F.sum("days").over(everything)
    return weekdays.select(
        "iso_day_of_week", "days", "units",
        round_to(F.col("units") / F.col("days") / overall, 4).alias("demand_factor"),
    )


def reorder_policy(demand: DataFrame, products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Reorder point and order-up-to level per store and product from the demand rate."""
    lead_times = products.select("product_id", "supplier_id").join(
        suppliers.select("supplier_id", "nominal_lead_time_days"), "supplier_id"
    )
    base = F.col("avg_daily_units")
    during_lead = base * F.col("nominal_lead_time_days")
    point = F.ceil(during_lead + SAFETY_FACTOR * F.sqrt(during_lead))
    return (
        demand.select(*SERIES, "avg_daily_units")
        .join(lead_times, "product_id")
        .select(
            *SERIES, "supplier_id", "avg_daily_units", "nominal_lead_time_days",
            point.alias("policy_reorder_point"),
            (point + F.ceil(base * COVER_DAYS)).alias("order_up_to"),
        )
    )


def replenishment_orders(latest: DataFrame, policy: DataFrame) -> DataFrame:
    """Orders to place now: at or below the policy's point with nothing on the way.

    Both sides have a row per series. The planner underrates inventory that fans out from its
    parts, so a merge is asked for: neither side is ever gathered on the driver.
    """
    return (
        latest.filter(F.col("in_transit_qty") == 0)
        .select(*SERIES, "on_hand_qty")
        .hint("merge")
        .join(policy.select(*SERIES, "supplier_id", "policy_reorder_point", "order_up_to"),
              list(SERIES))
        .filter(F.col("on_hand_qty") <= F.col("policy_reorder_point"))
        .select(
            *SERIES, "supplier_id", "on_hand_qty", "policy_reorder_point", "order_up_to",
            (F.col("order_up_to") - F.col("on_hand_qty")).alias("order_qty"),
        )
    )


def _movements(*parts: DataFrame) -> DataFrame:
    """Net movement per series and day.

    Summed up before the shuffle, so a series with very many movements reaches the windows
    below with no more rows than there are days.
    """
    return reduce(DataFrame.unionByName, parts).groupBy(*SERIES, "day").agg(
        F.sum("net").alias("net")
    )


def _movement(rows: DataFrame, date: Column, quantity: Column) -> DataFrame:
    return rows.select(*SERIES, date.alias("day"), quantity.cast("bigint").alias("net"))


def _with_running_total(inventory: DataFrame, movements: DataFrame) -> DataFrame:
    """Snapshots and movements in one series, with the movement up to and including each row.

    Snapshots are shuffled once, by series; the window over them needs nothing more. A
    movement sorts before the snapshot of its day. A hash of the series leads the sort, which
    tells most rows apart without comparing their keys.
    """
    snapshots = inventory.select(
        *SERIES, F.col("snapshot_date").alias("day"), F.lit(0).cast("bigint").alias("net"),
        "on_hand_qty", F.lit(True).alias("counted"),
    )
    rows = snapshots.unionByName(
        movements.withColumns(
            {"on_hand_qty": F.lit(None).cast("int"), "counted": F.lit(False)}
        )
    )
    rows = rows.withColumn("series", F.xxhash64(*SERIES))
    running = F.sum("net").over(
        _by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.withColumn("moved", running).filter("counted")


def _period(inventory: DataFrame) -> tuple[Column, Column]:
    """First and last snapshot date, out of one subquery."""
    day = F.col("snapshot_date")
    both = inventory.agg(F.struct(F.min(day).alias("first"), F.max(day).alias("last"))).scalar()
    return both.getField("first"), both.getField("last")


def _by_day() -> WindowSpec:
    return Window.partitionBy("series", *SERIES).orderBy("day", "counted")


def stock_ledger(inventory: DataFrame, sales: DataFrame, orders: DataFrame) -> DataFrame:
    """Stock expected from the previous snapshot, receipts and sales, next to the counted one.

    Movements between two snapshots count towards the later one, so a missing day does no
    harm. Movements outside the snapshot period are filtered out before anything is shuffled.
    """
    first, last = _period(inventory)
    arrived = F.col("actual_delivery_date")
    movements = _movements(
        _movement(orders.filter(arrived.between(first, last)), arrived, F.col("received_qty")),
        _movement(sales.filter(F.col("sale_date").between(first, last)),
                  F.col("sale_date"), -F.col("quantity")),
    )
    before = F.lag("on_hand_qty").over(_by_day())
    since = F.col("moved") - F.lag("moved").over(_by_day())
    return (
        _with_running_total(inventory, movements)
        .withColumn("expected_qty", before + since)
        .filter(F.col("expected_qty").isNotNull())
        .select(
            F.col("day").alias("snapshot_date"), *SERIES, "on_hand_qty", "expected_qty",
            (F.col("on_hand_qty") - F.col("expected_qty")).alias("unexplained_qty"),
        )
    )


def fill_rate(orders: DataFrame) -> DataFrame:
    """Delivered orders per supplier: how many came short, and the share received."""
    ordered, received = F.col("ordered_qty"), F.col("received_qty")
    return (
        orders.filter(received.isNotNull())
        .groupBy("supplier_id")
        .agg(
            F.count(F.lit(1)).alias("delivered_orders"),
            F.count_if(received < ordered).alias("short_orders"),
            F.sum(ordered).alias("ordered_units"),
            F.sum(received).alias("received_units"),
        )
        .withColumn(
            "fill_rate", round_to(F.try_divide("received_units", "ordered_units"), 4)
        )
    )


def in_transit(inventory: DataFrame, orders: DataFrame) -> DataFrame:
    """Units on the way at each snapshot: ordered before that day, arriving after it.

    Each order adds its quantity the day after it is placed and takes it off on arrival; the
    running sum replaces a range join. Everything before the first snapshot is folded into
    that day, so a series has at most one movement per day of the snapshot period.
    """
    first, last = _period(inventory)
    quantity = F.coalesce("received_qty", "ordered_qty")
    starts = F.date_add("order_date", 1)
    ends = F.greatest(F.col("actual_delivery_date"), starts)
    placed = orders.filter(starts <= last)
    arrived = placed.filter(F.col("actual_delivery_date").isNotNull() & (ends <= last))
    movements = _movements(
        _movement(placed, F.greatest(starts, first), quantity),
        _movement(arrived, F.greatest(ends, first), -quantity),
    )
    return _with_running_total(inventory, movements).select(
        F.col("day").alias("snapshot_date"), *SERIES,
        F.col("moved").alias("derived_in_transit_qty"),
    )
