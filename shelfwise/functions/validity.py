"""What makes a sale row usable, and why an unusable one is not."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# One (reason, defect) pair per rule, in the order in which they are reported.
# The defect is a SQL condition over the typed sale columns.
SALE_DEFECTS = (
    ("missing or unparseable sale_date", "sale_date IS NULL"),
    ("missing store_id", "store_id IS NULL"),
    ("missing product_id", "product_id IS NULL"),
    ("missing or unparseable quantity", "quantity IS NULL"),
    ("non-positive quantity", "quantity <= 0"),
    ("missing or unparseable amount_eur", "amount_eur IS NULL"),
    ("negative amount_eur", "amount_eur < 0"),
    ("missing or unparseable discount_pct", "discount_pct IS NULL"),
    ("discount_pct outside 0-1", "NOT discount_pct BETWEEN 0 AND 1"),
)


# What a usable row satisfies.
SALE_RULES = (
    "sale_date IS NOT NULL",
    "store_id IS NOT NULL",
    "product_id IS NOT NULL",
    "quantity > 0",
    "amount_eur >= 0",
    "discount_pct BETWEEN 0 AND 1",
)


def sales_row_is_valid() -> Column:
    """True when every rule holds, false otherwise, never NULL.

    A rule over a NULL counts as broken. So the rows that pass and the rows that fail always
    add up to all rows.
    """
    return reduce(and_, (F.coalesce(F.expr(rule), F.lit(False)) for rule in SALE_RULES))


def quarantine_reason() -> Column:
    """The first defect that applies; the last one is the fallback."""
    *listed, (fallback, _) = SALE_DEFECTS
    (reason, defect), *rest = listed
    chain = F.when(F.expr(defect), reason)
    for reason, defect in rest:
        chain = chain.when(F.expr(defect), reason)
    return chain.otherwise(fallback)
