from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import observability, quality
from shelfwise.operators.quality import TableChecks
from shelfwise.sources.tables import Step, Warehouse
from shelfwise.sources.versions import VersionedTable
from shelfwise.plans.contract import full_contract, marts_contract, staging_contract

DAY = date.fromisoformat


def test_contract_size():
    assert quality.contract_size(staging_contract()) == 62
    assert quality.contract_size(marts_contract()) == 54 + 3
    kinds = {k: sum(len(getattr(c, k)) for c in full_contract().values())
             for k in ("not_null", "unique", "ranges", "references", "accepted",
                       "unique_combination", "expressions", "failing_when")}
    assert kinds == {"not_null": 61, "unique": 11, "ranges": 20, "references": 18,
                     "accepted": 2, "unique_combination": 2, "expressions": 2,
                     "failing_when": 3}


@pytest.fixture
def child(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0), (1, "a", -1.0), (2, None, None), (3, "zz", 11.0), (None, "zz", 3.0),
         (None, "q", 3.0)], "id int, ref string, x double")


def test_each_check_finds_its_rows_and_null_passes(spark, child):
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    assert [tuple(r) for r in quality.unique(child, "id").collect()] == [(1, 2)]
    assert quality.not_null(child, "ref").count() == 1
    assert quality.accepted_range(child, "x", 0, 10).count() == 2
    assert quality.accepted_range(child, "x", low=0).count() == 1
    assert sorted(map(tuple, quality.accepted_values(child, "ref", ["a"]).collect())) == [
        ("q", 1), ("zz", 2)]
    assert sorted(map(tuple, quality.relationships(child, "ref", parent, "k").collect())) == [
        ("q", 1), ("zz", 2)]
    assert quality.expression_is_true(child, "x > id").count() == 1
    combos = quality.unique_combination(child, ["id", "ref"])
    assert [tuple(r) for r in combos.collect()] == [(1, "a", 2)]


def test_suite_counts_what_the_single_checks_find(spark, child):
    parent = spark.createDataFrame([("a",)], "k string")
    contract = {
        "child": TableChecks(
            not_null=["ref"], unique=["id"], unique_combination=[("id", "ref")],
            ranges={"x": (0, 10)}, accepted={"ref": ["a"], "id": ["1", "2", "3"]},
            references={"ref": ("parent", "k")}, expressions=["x > id"],
            failing_when={"x_is_eleven": lambda: F.col("x") == 11}),
        "parent": TableChecks(unique=["k"]),
    }
    results = quality.run_checks({"child": child, "parent": parent}, contract)
    got = {(r.check_name, r.column_name): r.failures for r in results.collect()}
    assert got == {
        ("not_null", "ref"): 1, ("unique", "id"): 1, ("unique_combination", "id, ref"): 1,
        ("accepted_range", "x"): 2, ("accepted_values", "ref"): 2, ("accepted_values", "id"): 0,
        ("relationships", "ref"): 3, ("expression_is_true", "x > id"): 1,
        ("x_is_eleven", ""): 1, ("unique", "k"): 0,
    }
    assert quality.failing(results).count() == 8
    assert results.filter(F.col("passed") != (F.col("failures") == 0)).count() == 0


def test_a_clean_table_passes_even_when_empty(spark, child):
    contract = {"child": TableChecks(
        not_null=["id"], unique=["id"], ranges={"x": (0, 1)}, accepted={"ref": ["a"]},
        references={"ref": ("child", "ref")})}
    results = quality.run_checks({"child": child.limit(0)}, contract)
    assert [r.failures for r in results.collect()] == [0] * 5


def test_business_rules(spark):
    df = spark.createDataFrame(
        [("ok", DAY("2026-07-02"), 1, DAY("2026-07-01"), True),
         ("lost", DAY("2026-07-02"), None, DAY("2026-07-01"), True),
         ("ghost", None, 4, DAY("2026-07-01"), None),
         ("wrong", DAY("2026-07-01"), 1, DAY("2026-07-01"), True),
         ("open", None, None, DAY("2026-07-01"), None)],
        "id string, actual_delivery_date date, received_qty int, promised_date date, "
        "is_late boolean")
    disagree = df.filter(quality.delivery_fields_disagree())
    assert sorted(r.id for r in disagree.collect()) == ["ghost", "lost"]
    assert [r.id for r in df.filter(quality.lateness_disagrees()).collect()] == ["wrong"]
    sales = spark.createDataFrame(
        [(2, 10.0, 0.1, 18.0), (2, 10.0, 0.1, 18.009), (2, 10.0, 0.1, 18.02), (2, None, .1, 1.0)],
        "quantity int, unit_price_eur double, discount_pct double, amount_eur double")
    assert [r.amount_eur for r in sales.filter(quality.revenue_drifts()).collect()] == [18.02]


def test_run_history(spark, folder, child):
    at = F.to_timestamp(F.lit("2026-07-18 00:00:00"))
    contract = {"t": TableChecks(not_null=["ref", "x"])}
    recorded = VersionedTable(spark, f"{folder}/h")
    for run, df in (("one", child), ("two", child.filter("ref is not null"))):
        results = quality.run_checks_measured({"t": df}, contract)
        recorded.append(observability.stamped(results, run, at))
    history = recorded.read()
    assert history.count() == 4 and all(r.seconds > 0 for r in history.collect())
    changed = observability.regressions(history, "one", "two").collect()
    assert sorted((r.column_name, r.failures_before, r.failures_after) for r in changed) == [
        ("ref", 1, 0), ("x", 1, 0)]


def test_schema_changes(spark):
    before = observability.capture_schema(
        spark, {"t": spark.range(1).withColumn("a", F.lit(1)).withColumn("gone", F.lit(1))})
    after = observability.capture_schema(
        spark, {"t": spark.range(1).withColumn("a", F.lit("x")).withColumn("new", F.lit(1.0))})
    got = {(r.column_name, r.change): (r.old_type, r.new_type)
           for r in observability.schema_changes(before, after).collect()}
    assert got == {("a", "type_changed"): ("int", "string"), ("gone", "removed"): ("int", None),
                   ("new", "added"): (None, "double")}


def test_compare_builds(spark):
    left = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "metric string, value double")
    right = spark.createDataFrame([("a", 1.0), ("c", 2.0)], "metric string, value double")
    got = {r.metric: r.agrees for r in observability.compare_builds(left, right).collect()}
    assert got == {"a": True, "b": False, "c": False}


ROWS_OF_A_TABLE = [(1, "a", 1.0), (1, "a", 1.0), (2, None, 2.0), (3, "c", None), (4, "d", 4.0)]


@pytest.mark.parametrize("buckets", [1, 3, 1024])
@pytest.mark.parametrize("change", ["none", "value", "lost", "repeated", "null moved", "swapped"])
def test_differing_rows_are_named(spark, buckets, change):
    schema = "id int, ref string, x double"
    other = {
        "none": ROWS_OF_A_TABLE[::-1], "value": [*ROWS_OF_A_TABLE[:4], (4, "d", 5.0)],
        "lost": ROWS_OF_A_TABLE[1:], "repeated": [*ROWS_OF_A_TABLE, (4, "d", 4.0)],
        "null moved": [*ROWS_OF_A_TABLE[:2], (2, "2.0", None), *ROWS_OF_A_TABLE[3:]],
        "swapped": [*ROWS_OF_A_TABLE[:3], (3, "d", None), (4, "c", 4.0)],
    }[change]
    left, right = (spark.createDataFrame(r, schema) for r in (ROWS_OF_A_TABLE, other))
    got = {tuple(r) for r in observability.differing_rows(left, right, ["id"], buckets).collect()}
    expected = {
        (*row, ROWS_OF_A_TABLE.count(row), other.count(row)) for row in {*ROWS_OF_A_TABLE, *other}
        if ROWS_OF_A_TABLE.count(row) != other.count(row)}
    assert got == expected
    assert bool(observability.differing_buckets(left, right, ["id"], buckets)) == bool(expected)


def test_versions_are_compared_by_their_changed_parts(spark, folder):
    table = VersionedTable(spark, f"{folder}/t")
    df = spark.createDataFrame([(k, k % 3) for k in range(9)], "id int, day int")
    table.replace(df, "day")
    table.replace_parts(df.filter("day = 1 and id > 1").withColumn("day", F.lit(1)), "day", ["1"])
    diff = observability.differing_versions(table, 1, 2, ["id"])
    assert [tuple(r) for r in diff.collect()] == [(1, 1, 1, 0)]
    files = {f.split("/day=")[1].split("/")[0] for f in table.read_area(
        "rows", table.version(1).areas["rows"], ["1"]).inputFiles()}
    assert files == {"1"}


def test_uniqueness_on_hashes_counts_what_whole_keys_count(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (1, "a", None), (2, None, "a"), (2, None, "a"), (2, "a", None), (None, "b", "c"),
         (None, "b", "c"), (4, None, None), (5, None, None)], "id int, p string, q string")
    contract = {"t": TableChecks(unique=["id", "p"], unique_combination=[("p", "q"), ("id", "p", "q")]),
                "u": TableChecks(unique=["id"])}
    tables = {"t": df, "u": df.select("id").distinct()}
    got = {(r.table_name, r.column_name): r.failures for r in quality.run_checks(tables, contract).collect()}
    assert got == {
        ("t", "id"): quality.unique(df, "id").count(), ("t", "p"): quality.unique(df, "p").count(),
        ("t", "p, q"): quality.unique_combination(df, ["p", "q"]).count(),
        ("t", "id, p, q"): quality.unique_combination(df, ["id", "p", "q"]).count(), ("u", "id"): 0}
    hashes = quality.repeated_hashes(tables, [("t", ["p"], True)])
    plan = hashes._jdf.queryExecution().executedPlan().toString()
    shuffled = next(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)
    assert "hash#" in shuffled and "p#" not in shuffled
    below = plan[plan.index(shuffled) + len(shuffled):].splitlines()
    assert "xxhash64" in " ".join(below)  # whole keys stay on their side of the shuffle


def test_uniqueness_shuffles_blocks_of_hashes_that_hold_a_hot_key_twice_at_most(spark):
    n = quality.TOGETHER + 10
    t = spark.range(0, n, 1, 1).select(F.when(F.col("id") < 1000, F.col("id")).alias("k"), (F.col("id") % 7).alias("g"))
    rules = [("t", ["k"], True), ("t", ["k"], False), ("t", ["g", "k"], False)]
    found = quality.repeated_hashes({"t": t}, rules)
    null = t.select(F.xxhash64(F.lit(None).cast("long"))).first()[0]
    nulls = {r[0] for r in t.select(F.xxhash64("g", F.lit(None).cast("long"))).distinct().collect()}
    assert {tuple(r) for r in found.collect()} == {(1, null), *((2, h) for h in nulls)}
    assert found.count() == 8
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "MapInArrow" in plan


def test_keys_are_counted_column_by_column(spark):
    t = spark.createDataFrame(
        [("a", DAY("2024-01-01"), -0.0), ("a", None, 0.0), (None, DAY("2024-01-01"), None)],
        "s string, d date, x double")
    counted = quality._counts_by_column(t, ["s", "d", "x"])
    assert sorted(map(tuple, counted.collect())) == [
        ("d", "2024-01-01", 2), ("s", "a", 2), ("x", "-0.0", 1), ("x", "0.0", 1)]
    assert "Generate" not in counted._jdf.queryExecution().executedPlan().toString()


def test_steps_of_runs(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/w")
    warehouse.replace("marts", "t", spark.range(5))
    warehouse.append("marts", "t", spark.range(2))
    assert [(s.layer, s.table, s.version, s.rows, s.seconds > 0) for s in warehouse.steps] == [
        ("marts", "t", 1, 5, True), ("marts", "t", 2, 2, True)]
    at = F.to_timestamp(F.lit("2026-07-18 00:00:00"))
    runs = [observability.stamped(observability.steps_table(spark, steps), run, at) for run, steps in (
        ("one", [Step("m", "a", 1, 1, 1.0), Step("m", "b", 1, 1, 1.0), Step("m", "old", 1, 1, 1.0)]),
        ("two", [Step("m", "a", 2, 1, 1.9), Step("m", "b", 2, 1, 2.1), Step("m", "new", 1, 1, 1.0)]))]
    slow = observability.slower_steps(runs[0].unionByName(runs[1]), "one", "two")
    assert {r.table_name for r in slow.collect()} == {"b", "old", "new"}
