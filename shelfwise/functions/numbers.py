"""Rounding and unit arithmetic on doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: list price of one credit in EUR.
EUR_PER_CREDIT = 2.75


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_to(value: Column | str, digits: int) -> Column:
    """Scale, round half away from zero, scale back: the same on every engine.

    Spark's own ``round(x, n)`` rounds the decimal spelling of a double, other engines its
    binary value, so 0.285 comes out as 0.29 or 0.28. Scaling first leaves one definition.
    """
    value = _column(value).cast("double")
    if digits == 0:
        return F.round(value)
    scale = float(10**digits)
    return F.round(value * scale) / scale


def line_amount(quantity: Column | str, price: Column | str, discount: Column | str) -> Column:
    """Value of a sale line after discount, in cents precision."""
    return round_to(_column(quantity) * _column(price) * (1.0 - _column(discount)), 2)


def bytes_to_gib(value: Column | str) -> Column:
    return _column(value) / F.pow(F.lit(1024.0), F.lit(3.0))


def credits_to_money(value: Column | str, rate: float = EUR_PER_CREDIT) -> Column:
    return _column(value) * F.lit(float(rate))
