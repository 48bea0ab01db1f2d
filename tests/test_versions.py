"""Versioned tables: commits, parts, and loads that die."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from shelfwise.sources.versions import ROWS, VersionedTable, part_name

DAY = date.fromisoformat


def rows(spark, *given):
    return spark.createDataFrame(
        [(k, d and DAY(d), q) for k, d, q in given], "k string, d date, q int")


def content(df):
    return sorted(((r.k, r.d and str(r.d), r.q) for r in df.collect()), key=str)


FIRST = (("a", "2026-07-01", 1), ("b", "2026-07-02", 1), ("n", None, 1))


@pytest.fixture
def table(spark, folder):
    return VersionedTable(spark, f"{folder}/t")


def failing(df):
    """The same rows, but a task dies after it has written some."""
    return df.withColumn("q", F.when(F.col("k") == "z", F.raise_error(F.lit("task lost")))
                         .otherwise(F.col("q")).cast("int"))


def test_before_the_first_commit(spark, table):
    assert table.version() is None and table.history().count() == 0 and table.expire() == []
    with pytest.raises(ValueError):
        table.read()


def test_replace_keeps_old_versions_readable(spark, table):
    assert table.replace(rows(spark, *FIRST), "d", label="one") == 3
    old = table.read()
    assert table.replace(rows(spark, ("x", "2026-07-09", 2))) == 1
    assert content(old) == sorted(FIRST, key=str)  # a plan made before the second load
    assert content(table.read()) == [("x", "2026-07-09", 2)]
    assert content(table.read(version=1)) == sorted(FIRST, key=str)
    assert {tuple(r)[:3] for r in table.history().collect()} == {(1, "one", 3), (2, None, 1)}
    assert table.has("one") and not table.has("two")


def test_a_load_that_dies_changes_nothing(spark, table):
    table.replace(rows(spark, *FIRST), "d")
    broken = failing(rows(spark, *FIRST, ("z", "2026-07-03", 1)).repartition(4))
    for attempt in (lambda: table.replace(broken, "d"),
                    lambda: table.replace_parts(broken, "d", ["2026-07-02"])):
        with pytest.raises(Exception, match="task lost"):
            attempt()
        assert content(table.read()) == sorted(FIRST, key=str)
        assert table.version().number == 1
    assert table.replace(rows(spark, *FIRST), "d") == 3  # and the next attempt works
    assert content(table.read()) == sorted(FIRST, key=str)


def test_a_load_that_dies_before_its_commit(spark, table, monkeypatch):
    table.replace(rows(spark, *FIRST), "d")
    monkeypatch.setattr(table, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(OSError):
        table.replace(rows(spark, ("x", "2026-07-09", 2)), "d")
    monkeypatch.undo()
    assert content(table.read()) == sorted(FIRST, key=str)
    assert len([x for x in table.expire(1) if x.startswith(f"{ROWS}/")]) == 1  # the orphan
    assert content(table.read()) == sorted(FIRST, key=str)


def test_parts(spark, table):
    table.replace(rows(spark, *FIRST), "d")
    new = rows(spark, ("b", "2026-07-02", 9), ("c", "2026-07-03", 9))
    table.replace_parts(new, "d", ["2026-07-02", part_name(None)])
    assert content(table.read()) == [("a", "2026-07-01", 1), ("b", "2026-07-02", 9),
                                     ("c", "2026-07-03", 9)]
    assert content(table.read(parts=["2026-07-03"])) == [("c", "2026-07-03", 9)]
    assert content(table.read(parts=[])) == []
    assert table.version().areas[ROWS].days() == ["2026-07-01", "2026-07-02", "2026-07-03"]
    with pytest.raises(ValueError, match="not replaced"):
        table.replace_parts(rows(spark, ("a", "2026-07-01", 5)), "d", [])
    table.replace_parts(new.limit(0), "d", ["2026-07-01"])  # a part may go
    assert content(table.read()) == [("b", "2026-07-02", 9), ("c", "2026-07-03", 9)]


def test_empty_tables_keep_their_columns(spark, table):
    assert table.replace(rows(spark).limit(0), "d") == 0
    assert table.read().columns == ["k", "d", "q"] and table.read().count() == 0


def test_parts_prune_folders(spark, table):
    table.replace(rows(spark, *FIRST), "d")
    plan = table.read().filter("d = '2026-07-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan


def test_expire_keeps_what_the_last_versions_need(spark, table):
    table.replace(rows(spark, *FIRST), "d")
    for q in range(2, 5):
        table.replace_parts(rows(spark, ("b", "2026-07-02", q)), "d", ["2026-07-02"])
    deleted = table.expire(2)
    assert "commits/v=1" in deleted and "commits/v=2" in deleted
    assert len([x for x in deleted if x.startswith(f"{ROWS}/")]) == 1
    assert content(table.read(version=3))[1] == ("b", "2026-07-02", 3)
    assert content(table.read())[0] == ("a", "2026-07-01", 1)  # still in the first load
    with pytest.raises(ValueError):
        table.read(version=1)
    assert table.replace_parts(rows(spark, ("b", "2026-07-02", 9)), "d", ["2026-07-02"]) == 1


def test_a_commit_that_dies_takes_a_number_and_nothing_else(spark, table, monkeypatch):
    table.replace(rows(spark, *FIRST), "d")
    spark.createDataFrame([], "area string").write.parquet(f"{table.path}/commits/v=2/_temporary/0")
    assert table.version().number == 1 and not table.knows(2) and table.knows(1)
    table.replace(rows(spark, ("x", "2026-07-09", 2)))
    assert table.version().number == 3 and content(table.read()) == [("x", "2026-07-09", 2)]
    other = VersionedTable(spark, table.path)
    assert other.version().number == 3 and content(other.read(version=1)) == sorted(FIRST, key=str)
