"""Rejected sale rows, kept with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import quarantine_reason, sales_row_is_valid


def quarantine_sales(typed_rows: DataFrame, at: Column | None = None) -> DataFrame:
    return typed_rows.filter(~sales_row_is_valid()).select(
        "*",
        quarantine_reason().alias("quarantine_reason"),
        (F.current_timestamp() if at is None else at).alias("quarantined_at"),
    )


def quarantine_count(quarantined: DataFrame) -> DataFrame:
    return quarantined.agg(F.count(F.lit(1)).alias("n"))


def quarantine_by_reason(quarantined: DataFrame) -> DataFrame:
    return quarantined.groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("n"))
