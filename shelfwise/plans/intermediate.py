"""Demand, stock status and delivery delays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import day_diff, round_to

DEMAND_DAYS = 28


def daily_demand(sales: DataFrame, window_days: int = DEMAND_DAYS) -> DataFrame:
    """Units and mean daily units per store and product over the trailing window.

    The window ends at the last sale date of all stores. The bound is a scalar subquery over
    a bare column, so on sales stored by ``sale_date`` it prunes partitions. The divisor is
    the window length even when the history is shorter.
    """
    last_day = sales.agg(F.max("sale_date")).scalar()
    return (
        sales.filter(F.col("sale_date") > F.date_sub(last_day, window_days))
        .groupBy("store_id", "product_id")
        .agg(F.sum("quantity").alias("units_last_28d"))
        .withColumn("avg_daily_units", F.col("units_last_28d") / float(window_days))
    )


def stock_status(inventory: DataFrame, demand: DataFrame) -> DataFrame:
    """Every snapshot with the current demand rate and what follows from it."""
    rate = F.coalesce("avg_daily_units", F.lit(0.0))
    rates = demand.select("store_id", "product_id", "avg_daily_units")
    return inventory.join(rates, ["store_id", "product_id"], "left").select(
        "snapshot_date",
        "store_id",
        "product_id",
        "on_hand_qty",
        "reorder_point",
        "in_transit_qty",
        rate.alias("avg_daily_units"),
        (F.col("on_hand_qty") == 0).alias("is_stockout"),
        (F.col("on_hand_qty") <= F.col("reorder_point")).alias("below_reorder_point"),
        F.when(rate != 0, round_to(F.col("on_hand_qty") / F.col("avg_daily_units"), 1))
        .alias("days_of_cover"),
    )


def purchase_order_delays(orders: DataFrame) -> DataFrame:
    """Lead times and lateness. Delays are NULL while an order is open, negative when early."""
    arrived = F.col("actual_delivery_date")
    return orders.select(
        "po_id",
        "order_date",
        "supplier_id",
        "product_id",
        "store_id",
        "ordered_qty",
        "received_qty",
        "promised_date",
        "actual_delivery_date",
        day_diff("order_date", "promised_date").alias("promised_lead_time_days"),
        day_diff("order_date", arrived).alias("actual_lead_time_days"),
        day_diff("promised_date", arrived).alias("delay_days"),
        arrived.isNull().alias("is_open"),
        F.when(arrived.isNotNull(), F.coalesce(arrived > F.col("promised_date"), F.lit(False)))
        .alias("is_late"),
    )
