"""The operating questions, asked of the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import round_to

COVER_THRESHOLD = 7
AT_RISK_ROWS = 40
LATE_SUPPLIER_ROWS = 10
MIN_DELIVERED_ORDERS = 20
TIER_ORDER = ("High", "Medium", "Low")


def in_stores(facts: DataFrame, store_ids: Sequence[str] | None) -> DataFrame:
    """Rows of the chosen stores: ``None`` means all of them, an empty choice means none."""
    if store_ids is None:
        return facts
    if not store_ids:
        return facts.filter(F.lit(False))
    return facts.filter(F.col("store_id").isin(list(store_ids)))


def latest_snapshot(inventory: DataFrame) -> DataFrame:
    """The last snapshot date of all stores; on stored inventory, one partition."""
    last = inventory.agg(F.max("snapshot_date")).scalar()
    return inventory.filter(F.col("snapshot_date") == last)


def is_at_risk(threshold: float = COVER_THRESHOLD) -> Column:
    """Little cover and nothing on the way."""
    return (
        F.col("days_of_cover").isNotNull()
        & (F.col("days_of_cover") < threshold)
        & (F.col("in_transit_qty") == 0)
    )


def data_as_of(inventory: DataFrame) -> DataFrame:
    return inventory.agg(F.max("snapshot_date").alias("as_of"))


def store_list(stores: DataFrame) -> DataFrame:
    return stores.select("store_id", "store_name").orderBy(F.asc_nulls_last("store_id"))


def kpis(
    inventory: DataFrame,
    orders: DataFrame,
    sales: DataFrame,
    store_ids: Sequence[str] | None = None,
    threshold: float = COVER_THRESHOLD,
) -> DataFrame:
    """One row: stockouts, products at risk, open orders of all stores, revenue.

    Each fact is read once; both stock counts come out of one pass over the last snapshot.
    """
    open_orders = orders.agg(F.count_if("is_open")).scalar()
    revenue = in_stores(sales, store_ids).agg(round_to(F.sum("amount_eur"), 0)).scalar()
    return (
        in_stores(latest_snapshot(inventory), store_ids)
        .agg(
            F.count_if("is_stockout").alias("stockouts"),
            F.count_if(is_at_risk(threshold)).alias("at_risk"),
        )
        .select(
            "stockouts", "at_risk", open_orders.alias("open_orders"), revenue.alias("revenue")
        )
    )


def at_risk(
    inventory: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    suppliers: DataFrame,
    store_ids: Sequence[str] | None = None,
    threshold: float = COVER_THRESHOLD,
    rows: int = AT_RISK_ROWS,
) -> DataFrame:
    """The products closest to running out, with the supplier behind each.

    The cover filter runs before the joins, so they see only the rows at risk. Ties in cover
    are broken by store and product. Join strategy is left to the planner, which broadcasts
    a dimension only below its size threshold.
    """
    risky = in_stores(latest_snapshot(inventory), store_ids).filter(is_at_risk(threshold))
    return (
        risky.join(products.select("product_id", "product_name", "category", "supplier_id"),
                   "product_id")
        .join(stores.select("store_id", "store_name"), "store_id")
        .join(suppliers.select("supplier_id", "supplier_name", "reliability_tier"),
              "supplier_id")
        .orderBy(F.asc_nulls_last("days_of_cover"), "store_id", "product_id")
        .limit(rows)
        .select(
            "store_name",
            "product_name",
            "category",
            "on_hand_qty",
            round_to("avg_daily_units", 2).alias("daily_demand"),
            "days_of_cover",
            "supplier_name",
            "reliability_tier",
        )
    )


def supplier_lateness(
    orders: DataFrame,
    suppliers: DataFrame,
    min_orders: int = MIN_DELIVERED_ORDERS,
    rows: int = LATE_SUPPLIER_ROWS,
) -> DataFrame:
    """Suppliers with the largest share of late deliveries; equal names are merged.

    Orders are summed up per supplier key before the join, so the join and the final
    grouping see one row per supplier, however many orders one supplier has.
    """
    per_supplier = (
        orders.filter(~F.col("is_open"))
        .groupBy("supplier_id")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_if("is_late").alias("late"),
            F.sum(F.when(F.col("is_late"), F.col("delay_days"))).alias("days_late"),
            F.count(F.when(F.col("is_late"), F.col("delay_days"))).alias("days_late_n"),
        )
    )
    return (
        per_supplier.join(suppliers.select("supplier_id", "supplier_name"), "supplier_id")
        .groupBy("supplier_name")
        .agg(*(F.sum(c).alias(c) for c in ("orders", "late", "days_late", "days_late_n")))
        .filter(F.col("orders") > min_orders)
        .select(
            "supplier_name",
            "orders",
            round_to(100.0 * (F.col("late") / F.col("orders")), 1).alias("late_pct"),
            round_to(F.try_divide("days_late", "days_late_n"), 1).alias("avg_days_late"),
        )
        .orderBy(F.desc_nulls_last("late_pct"), F.asc_nulls_last("supplier_name"))
        .limit(rows)
    )


def tier_rank(tier: str = "reliability_tier") -> Column:
    """Sort key High, Medium, Low, then anything else."""
    rank = F.when(F.col(tier) == TIER_ORDER[0], 0)
    for position, name in enumerate(TIER_ORDER[1:], start=1):
        rank = rank.when(F.col(tier) == name, position)
    return rank.otherwise(len(TIER_ORDER))


def stockout_rate_by_tier(
    inventory: DataFrame, products: DataFrame, suppliers: DataFrame
) -> DataFrame:
    """Share of snapshots out of stock per supplier tier, over all dates and stores.

    Snapshots are counted per product before the joins: the fact is never shuffled whole.
    """
    per_product = inventory.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("snapshots"), F.count_if("is_stockout").alias("stockouts")
    )
    return (
        per_product.join(products.select("product_id", "supplier_id"), "product_id")
        .groupBy("supplier_id")
        .agg(F.sum("snapshots").alias("snapshots"), F.sum("stockouts").alias("stockouts"))
        .join(suppliers.select("supplier_id", "reliability_tier"), "supplier_id")
        .groupBy("reliability_tier")
        .agg(F.sum("snapshots").alias("snapshots"), F.sum("stockouts").alias("stockouts"))
        .select(
            "reliability_tier",
            round_to(100.0 * F.col("stockouts") / F.col("snapshots"), 2)
            .alias("stockout_rate_pct"),
        )
        .orderBy(tier_rank())
    )


def revenue_by_day(sales: DataFrame, store_ids: Sequence[str] | None = None) -> DataFrame:
    return (
        in_stores(sales, store_ids)
        .groupBy("sale_date")
        .agg(round_to(F.sum("amount_eur"), 2).alias("revenue_eur"))
        .orderBy(F.asc_nulls_last("sale_date"))
    )
