"""The rules every table must keep: 62 for staging, 54 for the marts, 3 business rules."""

from __future__ import annotations

from shelfwise.operators.quality import (
    TableChecks,
    delivery_fields_disagree,
    lateness_disagrees,
    revenue_drifts,
)

# Accepted product categories and reliability tiers.
CATEGORIES = ("Épicerie", "Frais", "Boissons", "Hygiène", "Surgelés")
TIERS = ("High", "Medium", "Low")

AT_LEAST_0 = (0, None)
AT_LEAST_1 = (1, None)
SHARE = (0, 1)


def staging_contract(categories=CATEGORIES) -> dict[str, TableChecks]:
    return {
        "stg_suppliers": TableChecks(
            unique=["supplier_id"],
            not_null=["supplier_id", "supplier_name", "nominal_lead_time_days",
                      "reliability_score", "valid_from"],
            ranges={"nominal_lead_time_days": (1, 60), "reliability_score": SHARE},
        ),
        "stg_products": TableChecks(
            unique=["product_id"],
            not_null=["product_id", "category", "supplier_id", "unit_cost_eur",
                      "unit_price_eur"],
            accepted={"category": categories},
            ranges={"unit_cost_eur": AT_LEAST_0, "unit_price_eur": AT_LEAST_0},
            references={"supplier_id": ("stg_suppliers", "supplier_id")},
            expressions=["unit_price_eur >= unit_cost_eur"],
        ),
        "stg_stores": TableChecks(
            unique=["store_id"], not_null=["store_id", "store_name", "region"],
        ),
        "stg_sales": TableChecks(
            unique=["sale_id"],
            not_null=["sale_id", "sale_date", "store_id", "product_id", "quantity",
                      "discount_pct", "amount_eur"],
            ranges={"quantity": AT_LEAST_1, "discount_pct": SHARE, "amount_eur": AT_LEAST_0},
            references={"store_id": ("stg_stores", "store_id"),
                        "product_id": ("stg_products", "product_id")},
        ),
        "stg_inventory_snapshots": TableChecks(
            unique_combination=[("snapshot_date", "store_id", "product_id")],
            not_null=["snapshot_date", "store_id", "product_id", "on_hand_qty",
                      "reorder_point", "in_transit_qty"],
            ranges={"on_hand_qty": AT_LEAST_0, "reorder_point": AT_LEAST_0,
                    "in_transit_qty": AT_LEAST_0},
            references={"store_id": ("stg_stores", "store_id"),
                        "product_id": ("stg_products", "product_id")},
        ),
        "stg_purchase_orders": TableChecks(
            unique=["po_id"],
            not_null=["po_id", "order_date", "supplier_id", "product_id", "store_id",
                      "ordered_qty", "promised_date"],
            ranges={"ordered_qty": AT_LEAST_1, "received_qty": AT_LEAST_0},
            references={"supplier_id": ("stg_suppliers", "supplier_id"),
                        "product_id": ("stg_products", "product_id"),
                        "store_id": ("stg_stores", "store_id")},
            expressions=["promised_date >= order_date"],
        ),
    }


def marts_contract() -> dict[str, TableChecks]:
    return {
        "dim_suppliers": TableChecks(
            unique=["supplier_id"],
            not_null=["supplier_id", "reliability_tier", "reliability_score"],
            accepted={"reliability_tier": TIERS},
            ranges={"reliability_score": SHARE},
        ),
        "dim_products": TableChecks(
            unique=["product_id"],
            not_null=["product_id", "supplier_id", "margin_pct"],
            ranges={"margin_pct": SHARE},
            references={"supplier_id": ("dim_suppliers", "supplier_id")},
        ),
        "dim_stores": TableChecks(unique=["store_id"], not_null=["store_id", "region"]),
        "dim_date": TableChecks(
            unique=["date_day"],
            not_null=["date_day", "iso_day_of_week"],
            ranges={"iso_day_of_week": (1, 7)},
        ),
        "fct_sales": TableChecks(
            unique=["sale_id"],
            not_null=["sale_id", "sale_date", "store_id", "product_id", "quantity",
                      "amount_eur"],
            ranges={"quantity": AT_LEAST_1, "amount_eur": AT_LEAST_0},
            references={"sale_date": ("dim_date", "date_day"),
                        "store_id": ("dim_stores", "store_id"),
                        "product_id": ("dim_products", "product_id")},
            failing_when={"revenue_reconciles": revenue_drifts},
        ),
        "fct_inventory": TableChecks(
            unique_combination=[("snapshot_date", "store_id", "product_id")],
            not_null=["snapshot_date", "store_id", "product_id", "on_hand_qty",
                      "is_stockout"],
            ranges={"on_hand_qty": AT_LEAST_0, "days_of_cover": AT_LEAST_0},
            references={"snapshot_date": ("dim_date", "date_day"),
                        "store_id": ("dim_stores", "store_id"),
                        "product_id": ("dim_products", "product_id")},
        ),
        "fct_purchase_orders": TableChecks(
            unique=["po_id"],
            not_null=["po_id", "order_date", "supplier_id", "product_id", "store_id",
                      "ordered_qty", "is_open"],
            ranges={"ordered_qty": AT_LEAST_1},
            references={"supplier_id": ("dim_suppliers", "supplier_id"),
                        "product_id": ("dim_products", "product_id"),
                        "store_id": ("dim_stores", "store_id")},
            failing_when={"delivery_fields_agree": delivery_fields_disagree,
                          "is_late_matches_dates": lateness_disagrees},
        ),
    }


def full_contract(categories=CATEGORIES) -> dict[str, TableChecks]:
    return {**staging_contract(categories), **marts_contract()}
