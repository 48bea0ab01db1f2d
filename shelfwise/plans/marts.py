"""Star schema: four dimensions and three facts on natural keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import PRIVILEGED_ROLES, calendar_columns, masked, nulled, round_to
from shelfwise.plans.intermediate import daily_demand, purchase_order_delays, stock_status

# Lowest score of each tier, best first; anything else, NULL included, is Low.
RELIABILITY_TIERS = (("High", 0.95), ("Medium", 0.85))
LOWEST_TIER = "Low"

FCT_SALES_COLUMNS = (
    "sale_id", "sale_date", "store_id", "product_id",
    "quantity", "unit_price_eur", "discount_pct", "amount_eur",
)


def reliability_tier(score: Column | str = "reliability_score") -> Column:
    score = F.col(score) if isinstance(score, str) else score
    (best, bound), *rest = RELIABILITY_TIERS
    tier = F.when(score >= bound, best)
    for name, bound in rest:
        tier = tier.when(score >= bound, name)
    return tier.otherwise(LOWEST_TIER)


def dim_suppliers(suppliers: DataFrame) -> DataFrame:
    return suppliers.select(
        "supplier_id", "supplier_name", "country", "city", "nominal_lead_time_days",
        "reliability_score", reliability_tier().alias("reliability_tier"), "valid_from",
    )


def dim_products(products: DataFrame) -> DataFrame:
    margin = F.col("unit_price_eur") - F.col("unit_cost_eur")
    price = F.nullif("unit_price_eur", F.lit(0.0))
    return products.select(
        "product_id", "product_name", "category", "supplier_id",
        "unit_cost_eur", "unit_price_eur",
        round_to(margin, 2).alias("unit_margin_eur"),
        round_to(margin / price, 3).alias("margin_pct"),
    )


def dim_stores(stores: DataFrame) -> DataFrame:
    return stores.select("store_id", "store_name", "city", "region")


def dim_date(inventory: DataFrame) -> DataFrame:
    """One row per snapshot date that occurs; no generated calendar."""
    days = inventory.select(F.col("snapshot_date").alias("date_day")).distinct()
    return days.select(*calendar_columns("date_day"))


def dim_suppliers_secure(
    dimension: DataFrame, role: Column | str, privileged: Iterable[str] = PRIVILEGED_ROLES
) -> DataFrame:
    """The supplier dimension as ``role`` may see it; the tier stays visible to all."""
    privileged = tuple(privileged)
    return dimension.select(
        "supplier_id", masked("supplier_name", role, privileged), "country", "city",
        "nominal_lead_time_days", nulled("reliability_score", role, privileged),
        "reliability_tier", "valid_from",
    )


def fct_sales(sales: DataFrame) -> DataFrame:
    """A full load; see ``operators.incremental`` for the daily one."""
    return sales.select(*FCT_SALES_COLUMNS)


def daily_sums(sales: DataFrame) -> DataFrame:
    """Units by day, store and product: what demand over any window is added up from."""
    return sales.groupBy("sale_date", "store_id", "product_id").agg(
        F.sum("quantity").alias("quantity"))


def fct_inventory(inventory: DataFrame, sales: DataFrame) -> DataFrame:
    return stock_status(inventory, daily_demand(sales))


def fct_purchase_orders(orders: DataFrame) -> DataFrame:
    return purchase_order_delays(orders)
