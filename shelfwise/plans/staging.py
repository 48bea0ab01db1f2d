"""RAW text to typed rows: one function per source, lineage columns dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import clean_cast, sales_row_is_valid
from shelfwise.sources.schemas import RAW_COLUMNS

# Staging type of every raw column that is not kept as text.
STAGING_TYPES = {
    "nominal_lead_time_days": "int",
    "reliability_score": "double",
    "valid_from": "date",
    "unit_cost_eur": "double",
    "unit_price_eur": "double",
    "sale_date": "date",
    "quantity": "int",
    "discount_pct": "double",
    "amount_eur": "double",
    "snapshot_date": "date",
    "on_hand_qty": "int",
    "reorder_point": "int",
    "in_transit_qty": "int",
    "order_date": "date",
    "ordered_qty": "int",
    "promised_date": "date",
    "actual_delivery_date": "date",
    "received_qty": "int",
}


def typed(name: str) -> Column:
    """Text columns, keys included, pass through uncleaned."""
    if name in STAGING_TYPES:
        return clean_cast(name, STAGING_TYPES[name]).alias(name)
    return F.col(name)


def stage(raw: DataFrame, table: str, *further: str) -> DataFrame:
    """The typed columns of a raw table, and ``further`` columns as they are."""
    return raw.select(*(typed(name) for name in RAW_COLUMNS[table]), *further)


def stg_suppliers(raw: DataFrame) -> DataFrame:
    return stage(raw, "suppliers")


def stg_products(raw: DataFrame) -> DataFrame:
    return stage(raw, "products")


def stg_stores(raw: DataFrame) -> DataFrame:
    return stage(raw, "stores")


def stg_inventory_snapshots(raw: DataFrame) -> DataFrame:
    return stage(raw, "inventory_snapshots")


def stg_purchase_orders(raw: DataFrame) -> DataFrame:
    """The dates come out of a generator, so that filters on them read values."""
    dates = [name for name in RAW_COLUMNS["purchase_orders"] if STAGING_TYPES.get(name) == "date"]
    parsed = F.inline(F.array(F.struct(*(typed(name) for name in dates))))
    kept = (typed(name) for name in RAW_COLUMNS["purchase_orders"] if name not in dates)
    return raw.select(*kept, parsed).select(*RAW_COLUMNS["purchase_orders"])


# The typed columns that decide whether a sale row is valid.
CHECKED = ("sale_date", "quantity", "discount_pct", "amount_eur")


def typed_sales(raw: DataFrame, *further: str) -> DataFrame:
    """Typed but unfiltered sales, the common input of the valid and the quarantined rows.

    The checked columns come out of a generator. A filter on them stays above it and reads
    their values; over a plain projection it would be pushed down and parse them again.
    """
    parsed = F.inline(F.array(F.struct(*(typed(name) for name in CHECKED))))
    kept = (typed(name) for name in RAW_COLUMNS["sales"] if name not in CHECKED)
    return raw.select(*kept, *further, parsed).select(*RAW_COLUMNS["sales"], *further)


def stg_sales(typed_rows: DataFrame) -> DataFrame:
    return typed_rows.filter(sales_row_is_valid())
