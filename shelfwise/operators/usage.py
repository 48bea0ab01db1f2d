"""Usage and cost rollups over a usage log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import bytes_to_gib, credits_to_money, round_to

TOTAL = "TOTAL"
STORAGE_DAYS = 7
BUSIEST = 5


def usage_by_group(log: DataFrame, group: str = "resource", amount: str = "amount") -> DataFrame:
    """Credits and metering periods per group, the largest first, and their grand total.

    The log is grouped once; the total rolls up the few group rows.
    """
    groups = log.groupBy(group).agg(
        F.sum(amount).alias("credits"), F.count(F.lit(1)).alias("periods")
    )
    credits = F.coalesce(F.sum("credits"), F.lit(0.0))
    return (
        groups.rollup(group)
        .agg(
            F.grouping(group).alias("is_total"),
            round_to(credits, 4).alias("credits"),
            round_to(credits_to_money(credits), 2).alias("cost_eur"),
            F.sum("periods").alias("metering_periods"),
        )
        .select(
            F.when(F.col("is_total") == 1, TOTAL).otherwise(F.col(group)).alias(group),
            "credits", "cost_eur", F.coalesce("metering_periods", F.lit(0)).alias("metering_periods"),
            F.col("is_total").cast("int").alias("is_total"),
        )
        .orderBy("is_total", F.desc_nulls_last("credits"), F.asc_nulls_last(group))
    )


def usage_total(log: DataFrame, name: str, group: str = "resource",
                amount: str = "amount") -> DataFrame:
    """Credits and cost of one group; zero when it has no rows."""
    credits = F.coalesce(F.sum(amount), F.lit(0.0))
    return log.filter(F.col(group) == name).agg(
        round_to(credits, 4).alias("credits"),
        round_to(credits_to_money(credits), 2).alias("cost_eur"),
    )


def storage_average(log: DataFrame, today: Column | None = None,
                    days: int = STORAGE_DAYS) -> DataFrame:
    """Mean table and stage storage in GiB over the last days."""
    today = F.current_date() if today is None else today
    return log.filter(F.col("usage_date") >= F.date_sub(today, days)).agg(
        round_to(bytes_to_gib(F.avg("storage_bytes")), 4).alias("table_gib"),
        round_to(F.coalesce(bytes_to_gib(F.avg("stage_bytes")), F.lit(0.0)), 4)
        .alias("stage_gib"),
    )


def busiest_types(log: DataFrame, group: str = "resource", elapsed_ms: str = "amount",
                  rows: int = BUSIEST, only: Sequence[str] | None = None,
                  where: Mapping[str, object] | None = None) -> DataFrame:
    """Groups with the most elapsed time, of those in ``only`` if given; groups without any time
    come last. ``where`` names columns and the value that a row must have there, the warehouse of
    a query, say."""
    for column, value in (where or {}).items():
        log = log.filter(F.col(column) == value)
    if only is not None:
        log = log.filter(F.col(group).isin(list(only)))
    return (
        log.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("n"),
            round_to(F.sum(elapsed_ms) / 1000.0, 1).alias("seconds"),
        )
        .orderBy(F.desc_nulls_last("seconds"), F.asc_nulls_last(group))
        .limit(rows)
    )
