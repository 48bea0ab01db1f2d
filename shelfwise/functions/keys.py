"""Business keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefix and zero-padded width of each key.
KEY_FORMATS = {
    "supplier": ("SUP", 4),
    "product": ("SKU", 5),
    "store": ("STO", 3),
    "sale": ("SAL", 7),
    "purchase_order": ("PO", 6),
}


def business_key(kind: str, number: Column | str) -> Column:
    """``SUP-0007`` style key. A number wider than the pad keeps all its digits."""
    prefix, width = KEY_FORMATS[kind]
    digits = (F.col(number) if isinstance(number, str) else number).cast("string")
    return F.concat(
        F.lit(prefix + "-"), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))
    )
