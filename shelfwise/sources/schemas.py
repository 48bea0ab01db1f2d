"""The six raw tables. Every raw column is text; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Raw column names in file order.
RAW_COLUMNS = {
    "suppliers": (
        "supplier_id", "supplier_name", "country", "city",
        "nominal_lead_time_days", "reliability_score", "valid_from",
    ),
    "products": (
        "product_id", "product_name", "category", "supplier_id",
        "unit_cost_eur", "unit_price_eur",
    ),
    "stores": ("store_id", "store_name", "city", "region"),
    "sales": (
        "sale_id", "sale_date", "store_id", "product_id", "quantity",
        "unit_price_eur", "discount_pct", "amount_eur",
    ),
    "inventory_snapshots": (
        "snapshot_date", "store_id", "product_id",
        "on_hand_qty", "reorder_point", "in_transit_qty",
    ),
    "purchase_orders": (
        "po_id", "order_date", "supplier_id", "product_id", "store_id",
        "ordered_qty", "promised_date", "actual_delivery_date", "received_qty",
    ),
}

# Where each table's files lie below the raw zone.
RAW_PATHS = {
    "suppliers": "suppliers/*.{csv,csv.gz}",
    "products": "products/*.{csv,csv.gz}",
    "stores": "stores/*.{csv,csv.gz}",
    "sales": "sales/dt=*/*.{csv,csv.gz}",
    "inventory_snapshots": "inventory/dt=*/*.{csv,csv.gz}",
    "purchase_orders": "purchase_orders/dt=*/*.{csv,csv.gz}",
}

DIMENSIONS = ("suppliers", "products", "stores")
# Fact table -> (directory, date column).
FACTS = {
    "sales": ("sales", "sale_date"),
    "inventory_snapshots": ("inventory", "snapshot_date"),
    "purchase_orders": ("purchase_orders", "order_date"),
}

SOURCE_FILE = "_source_file"
LOADED_AT = "_loaded_at"


def text_schema(columns) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in columns])


RAW_SCHEMAS = {table: text_schema(columns) for table, columns in RAW_COLUMNS.items()}
