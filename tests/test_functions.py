from __future__ import annotations

import datetime
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfwise.functions import (
    business_key, calendar_columns, clean_cast, credits_to_money, bytes_to_gib, line_amount,
    quarantine_reason, round_to, sales_row_is_valid,
)
from shelfwise.functions import cleaning
from shelfwise.functions.validity import SALE_DEFECTS
from shelfwise.plans import quarantine, staging
from __spark_entry__ import BAD_SALES
from shelfwise.sources.tables import literal_rows

# Text on which a safe cast must give the same value as the warehouse's own.
TEXTS = [
    "2.7", "2.5", "-2.5", "1e2", "1_000", "10d", "1.5f", "1.5D", "0x1p3", "abc",
    "99999999999", "+3", " 5 ", "", "   ", "\t5", "5\t", "5.", ".5", ".", "1e", "1e400",
    "nan", "NaN", "inf", "Infinity", "-inf", "1,000", "2147483647.4", "2147483647.5",
    "2147483648", "1e9", "1e10", "--5", "5-", "1e-1", "0.49", "-0.5", "1__0", "_1", "1_",
    "2026", "2026-07", "2026-7-1", "2026-07-18", " 2026-07-18 ", "2026-07-18 10:00:00",
    "2026-07-18T10:00:00", "2026-02-30", "20260718", "2026/07/18", "2026-07-18abc",
    "2026-07-18 abc", "2026-07-18 BC", "+2026-07-18", "12026-07-18x", "true", "00012",
]


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a):
        return math.isnan(b)
    return a == b


@pytest.mark.parametrize("kind,sql", [("int", "integer"), ("double", "double"), ("date", "date")])
def test_clean_cast_matches_the_warehouse(spark, kind, sql):
    df = spark.createDataFrame([(t,) for t in TEXTS] + [(None,)], "t string")
    got = {r.t: r.v for r in df.select("t", clean_cast("t", kind).alias("v")).collect()}
    con = duckdb.connect()
    want = {
        t: con.execute(f"select try_cast(nullif(trim(?), '') as {sql})", [t]).fetchone()[0]
        for t in TEXTS
    }
    if kind == "date":  # Spark has no infinite dates: NULL, and so quarantined
        want |= {t: None for t in ("inf", "Infinity", "-inf")}
    assert {t: (got[t], want[t]) for t in TEXTS if not same(got[t], want[t])} == {}
    assert got[None] is None


def test_ordinary_numbers_need_no_pattern(spark):
    texts = ["12.50", "7", "1e5", "1_000.5", "0x1p3", "0X10", "1d", "1f2", "1.2.3", "", " 5 ", "-3.0",
             "5.", ".5", "1e400", "1 2", "nan", "٣", "1,5", "12_", "5\n", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    by_pattern = cleaning._double("t", cleaning.DOUBLE)
    both = rows.select("t", cleaning.clean_cast("t", "double").alias("x"), by_pattern.alias("y"))
    assert not [tuple(r) for r in both.filter(~F.col("x").eqNullSafe(F.col("y"))).collect()]
    plan = rows.select(cleaning.clean_cast("t", "double").alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CASE WHEN") < plan.index("regexp_extract")


def test_round_is_half_away_after_scaling(spark):
    values = [0.285, 1.005, 2.5, -2.5, 0.125, None, float("nan"), 1e18]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r.y for r in df.orderBy("i").select(round_to("x", 2).alias("y")).collect()]
    assert got[0] == 0.28 and got[1] == 1.0 and got[4] == 0.13 and got[5] is None
    assert math.isnan(got[6])
    whole = [r.y for r in df.orderBy("i").select(round_to("x", 0).alias("y")).collect()]
    assert whole[2:4] == [3.0, -3.0]


def test_units_and_amounts(spark):
    row = spark.range(1).select(
        line_amount(F.lit(3), F.lit(9.99), F.lit(0.1)).alias("amount"),
        credits_to_money(F.lit(2.0)).alias("eur"),
        bytes_to_gib(F.lit(1073741824.0)).alias("gib"),
    ).first()
    assert (row.amount, row.eur, row.gib) == (26.97, 5.5, 1.0)


def test_business_keys_pad_but_never_truncate(spark):
    df = spark.createDataFrame([(7,), (123456789,)], "n bigint")
    got = [r.k for r in df.orderBy("n").select(business_key("product", "n").alias("k")).collect()]
    assert got == ["SKU-00007", "SKU-123456789"]


def test_calendar(spark):
    days = ["2026-07-20", "2026-07-26", "2027-01-01", None]
    df = spark.createDataFrame([(d,) for d in days], "t string").select(
        F.col("t").cast("date").alias("d"))
    rows = {str(r.d): r for r in df.select(*calendar_columns("d")).collect()}
    assert rows["2026-07-20"].iso_day_of_week == 1 and not rows["2026-07-20"].is_weekend
    assert rows["2026-07-26"].weekday_name == "Sunday" and rows["2026-07-26"].is_weekend
    assert (rows["2027-01-01"].iso_week, rows["2027-01-01"].year) == (53, 2027)
    assert rows["None"].weekday_name == "Sunday" and rows["None"].is_weekend is None


def sale(**changes):
    row = {"sale_id": "S", "sale_date": "2026-07-18", "store_id": "STO-001",
           "product_id": "SKU-00001", "quantity": "2", "unit_price_eur": "10.00",
           "discount_pct": "0.0", "amount_eur": "20.00"} | changes
    return tuple(row.values())


def typed(spark, *rows):
    columns = ", ".join(f"{c} string" for c in (
        "sale_id", "sale_date", "store_id", "product_id", "quantity", "unit_price_eur",
        "discount_pct", "amount_eur"))
    return staging.typed_sales(spark.createDataFrame(list(rows), columns))


def test_every_row_is_either_valid_or_quarantined(spark):
    odd = [None, "", " ", "x", "0", "-1", "1", "nan", "inf", "1.5", "2026-07-18"]
    rows = [
        sale(sale_id=f"{column}-{i}", **{column: value})
        for column in ("sale_date", "store_id", "product_id", "quantity", "unit_price_eur",
                       "discount_pct", "amount_eur")
        for i, value in enumerate(odd)
    ]
    all_rows = typed(spark, *rows)
    valid = {r.sale_id for r in staging.stg_sales(all_rows).collect()}
    rejected = {r.sale_id for r in quarantine.quarantine_sales(all_rows).collect()}
    assert valid & rejected == set()
    assert valid | rejected == {r[0] for r in rows}
    # Kept on purpose: a NaN amount passes, an unchecked price passes, a blank key passes.
    assert {"amount_eur-7", "unit_price_eur-3", "store_id-1"} <= valid
    assert {"discount_pct-7", "store_id-0", "quantity-4"} <= rejected


def test_rules_and_reasons_agree(spark):
    rows = typed(spark, *(sale(quantity=q, discount_pct=d, amount_eur=a, sale_date=s)
                          for q in ("1", "0", "", "x") for d in ("0", "1", "1.1", "-0.1", "")
                          for a in ("0", "-1", "", "nan") for s in ("2026-07-18", "")))
    any_defect = F.lit(False)
    for _, defect in SALE_DEFECTS:
        any_defect = any_defect | F.coalesce(F.expr(defect), F.lit(False))
    assert rows.filter(any_defect == sales_row_is_valid()).count() == 0


def test_planted_bad_rows_get_their_reasons(spark):
    raw = literal_rows(spark, BAD_SALES, "sales", "simulated-bad-data")
    assert {r._source_file for r in raw.collect()} == {"simulated-bad-data"}
    got = quarantine.quarantine_sales(staging.typed_sales(raw)).orderBy("sale_id").collect()
    assert [r.quarantine_reason for r in got] == [
        "non-positive quantity", "non-positive quantity", "missing or unparseable amount_eur",
        "discount_pct outside 0-1", "missing or unparseable sale_date",
    ]
    assert all(isinstance(r.quarantined_at, datetime.datetime) for r in got)


def test_first_reason_wins(spark):
    rows = typed(spark, sale(sale_date="", quantity="0", amount_eur="x"))
    assert rows.select(quarantine_reason().alias("r")).first().r == (
        "missing or unparseable sale_date")
