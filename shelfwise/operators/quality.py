"""Data-quality checks: each names the rows that break a rule, and a suite counts them.

A check never changes data and NULL passes every check but ``not_null``, so that a missing
value is reported once. The suite reads a table once for all its row checks; each column with a
reference or accepted values, and each key that must be unique, is read again by itself. So what
is checked should be stored, by columns.
Uniqueness is decided on 64-bit hashes, which are shuffled in blocks and looked through share by
share; whole keys are compared for the hashes that occur twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.session import stored as written

#: Shares of the hash space, as a power of two; a task looks through one at a time.
SHARE_BITS = 10
#: Hashes that a task sorts and deals out at once.
TOGETHER = 1 << 18

# --- rows that fail -------------------------------------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_range(df: DataFrame, column: str, low: float | None = None,
                   high: float | None = None) -> DataFrame:
    return df.filter(~in_range(column, low, high))


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    return df.filter(~(F.expr(expression) if isinstance(expression, str) else expression))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, NULL aside."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; here NULL is a value like any other."""
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """The values that are not accepted, and how often each occurs."""
    return (
        df.filter(~F.col(column).isin(list(values)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str
                  ) -> DataFrame:
    """Child keys without a parent, and how many child rows each has.

    The child is grouped by key first: a key shared by a third of all rows crosses the
    network as one partial count per task, and the anti join sees it once.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    known = parent.select(F.col(parent_column).alias(column))
    return keys.join(known, column, "left_anti")


def delivery_fields_disagree() -> Column:
    """A delivery date without a received quantity, or the reverse."""
    return F.col("actual_delivery_date").isNull() != F.col("received_qty").isNull()


def lateness_disagrees() -> Column:
    """The stored flag against the two dates it is derived from."""
    return F.col("is_late") != (F.col("actual_delivery_date") > F.col("promised_date"))


def revenue_drifts(tolerance: float = 0.01) -> Column:
    """The stored amount against quantity, price and discount."""
    computed = F.col("quantity") * F.col("unit_price_eur") * (1 - F.col("discount_pct"))
    return F.abs(F.col("amount_eur") - computed) > tolerance


def in_range(column: str, low: float | None, high: float | None) -> Column:
    bounds = []
    if low is not None:
        bounds.append(F.col(column) >= low)
    if high is not None:
        bounds.append(F.col(column) <= high)
    return reduce(lambda a, b: a & b, bounds)


# --- the suite ------------------------------------------------------------------------


@dataclass(frozen=True)
class TableChecks:
    """The rules one table must keep."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    unique_combination: Sequence[Sequence[str]] = ()
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)
    accepted: Mapping[str, Sequence] = field(default_factory=dict)
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    expressions: Sequence[str] = ()
    # name of the rule -> function giving the condition under which a row fails
    failing_when: Mapping[str, Callable[[], Column]] = field(default_factory=dict)

    def count(self) -> int:
        parts = (self.not_null, self.unique, self.unique_combination, self.ranges,
                 self.accepted, self.references, self.expressions, self.failing_when)
        return sum(len(part) for part in parts)


def _row_checks(table: str, df: DataFrame, checks: TableChecks) -> DataFrame | None:
    """All row checks of a table from one pass: one conditional count each."""
    conditions = [("not_null", c, F.col(c).isNull()) for c in checks.not_null]
    conditions += [
        ("accepted_range", c, ~in_range(c, *bounds)) for c, bounds in checks.ranges.items()
    ]
    conditions += [("expression_is_true", e, ~F.expr(e)) for e in checks.expressions]
    conditions += [(name, "", failing()) for name, failing in checks.failing_when.items()]
    if not conditions:
        return None
    counts = df.agg(*(F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(conditions)))
    rows = F.array(*(
        F.struct(
            F.lit(kind).alias("check_name"), F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"), F.col(f"c{i}").alias("failures"),
        )
        for i, (kind, column, _) in enumerate(conditions)
    ))
    return counts.select(F.inline(rows))


def _labelled(counted: DataFrame, kind: str, table: str, column: str) -> DataFrame:
    return counted.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(kind).alias("check_name"), F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"), "failures",
    )


def _key_checks(table: str, df: DataFrame, checks: TableChecks, parents: Mapping[str, DataFrame]
                ) -> DataFrame | None:
    """All reference and accepted-value checks of a table.

    Each checked column is read and counted by itself, before the shuffle, and only a counted key
    becomes text. Reference counts add up child rows, accepted-value counts the distinct values.
    """
    columns = list(dict.fromkeys([*checks.references, *checks.accepted]))
    if not columns:
        return None
    counted = _counts_by_column(df, columns)
    results = []
    if checks.references:
        known = reduce(DataFrame.unionByName, (
            parents[parent].select(
                F.lit(c).alias("column_name"), F.col(field_).cast("string").alias("key")
            )
            for c, (parent, field_) in checks.references.items()
        ))
        orphans = counted.filter(F.col("column_name").isin(list(checks.references))).join(
            known, ["column_name", "key"], "left_anti"
        )
        results.append(("relationships", list(checks.references), orphans, F.sum("n")))
    for column, values in checks.accepted.items():
        bad = counted.filter((F.col("column_name") == column) & ~F.col("key").isin(list(values)))
        results.append(("accepted_values", [column], bad, F.count(F.lit(1))))

    def with_zeroes(kind: str, names: list[str], bad: DataFrame, failures: Column) -> DataFrame:
        totals = bad.groupBy("column_name").agg(failures.cast("bigint").alias("n"))
        as_map = totals.agg(  # at most one entry per rule
            F.map_from_entries(F.collect_list(F.struct("column_name", "n"))).alias("m")
        )
        rows = F.array(*(
            F.struct(
                F.lit(kind).alias("check_name"), F.lit(table).alias("table_name"),
                F.lit(name).alias("column_name"),
                F.coalesce(F.col("m")[name], F.lit(0).cast("bigint")).alias("failures"),
            )
            for name in names
        ))
        return as_map.select(F.inline(rows))

    return reduce(DataFrame.unionByName, (with_zeroes(*r) for r in results))


def _counts_by_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, key, n): how often each value of each column occurs, as text; NULL aside."""
    kinds = dict(df.dtypes)
    counts = []
    for c in columns:
        # The two zeroes are different texts, but one key of a grouping.
        key = F.col(c).cast("string") if kinds[c] in ("float", "double") else F.col(c)
        counts.append(
            df.select(key.alias("key")).filter(F.col("key").isNotNull())
            .groupBy("key").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(c).alias("column_name"), F.col("key").cast("string").alias("key"), "n"))
    return reduce(DataFrame.unionByName, counts)


def _hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*(F.col(c) for c in columns))


def repeated_hashes(tables: Mapping[str, DataFrame], rules: Sequence[tuple[str, Sequence[str], bool]]
                    ) -> DataFrame:
    """(rule, hash) of keys that may occur twice; a rule is (table, columns, whether NULL is aside).

    Eight bytes a row are shuffled instead of its keys, in sorted blocks that hold a hash twice at
    most. A share of the hash space is some thousandth of a rule's rows, however often keys repeat.
    """
    def blocks(rule: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def dealt(held: list[np.ndarray]) -> pa.RecordBatch:
            hashes = np.sort(np.concatenate(held).view(np.uint64))
            hashes = hashes[np.append([True, True], hashes[2:] != hashes[:-2])[: len(hashes)]]
            share = (hashes >> np.uint64(64 - SHARE_BITS)).astype(np.int32)
            starts = np.flatnonzero(np.append(True, share[1:] != share[:-1]))
            ends = np.append(starts[1:], len(hashes))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(starts), rule, np.int32)), pa.array(share[starts]),
                 pa.array([hashes[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())],
                ["rule", "share_of_hash", "hashes"])

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = [], 0
            for batch in batches:
                if batch.num_rows:
                    held.append(batch.column(0).to_numpy(zero_copy_only=False))
                    n += batch.num_rows
                if n >= TOGETHER:
                    yield dealt(held)
                    held, n = [], 0
            if held:
                yield dealt(held)

        return deal

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def twice(rule: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            hashes = np.sort(np.concatenate(held))
            found = np.unique(hashes[1:][hashes[1:] == hashes[:-1]]).view(np.int64)
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), rule, np.int32)), pa.array(found)],
                    ["rule", "hash"])

        of, held = (0, -1), []
        for batch in batches:
            for rule, share, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (rule, share) != of:
                    if held:
                        yield from twice(of[0], held)
                    of, held = (rule, share), []
                held.append(np.frombuffer(block, np.uint64))
        if held:
            yield from twice(of[0], held)

    parts = []
    for number, (table, columns, nulls_aside) in enumerate(rules):
        df = tables[table]
        if nulls_aside:
            df = df.filter(F.col(columns[0]).isNotNull())
        parts.append(df.select(_hash(columns).alias("hash")).mapInArrow(
            blocks(number), "rule int, share_of_hash int, hashes binary"))
    shares = reduce(DataFrame.unionByName, parts).repartition("rule", "share_of_hash")
    return shares.sortWithinPartitions("rule", "share_of_hash").mapInArrow(repeated, "rule int, hash long")


def _uniqueness_checks(tables: Mapping[str, DataFrame], contract: Mapping[str, TableChecks]
                       ) -> list[DataFrame]:
    rules = [
        *((name, [c], True) for name, checks in contract.items() for c in checks.unique),
        *((name, list(cs), False) for name, checks in contract.items()
          for cs in checks.unique_combination),
    ]
    if not rules:
        return []
    suspects = written(repeated_hashes(tables, rules), "repeated_hashes")
    suspected = {r[0] for r in suspects.select("rule").distinct().collect()}
    results = []
    for number, (table, columns, nulls_aside) in enumerate(rules):
        kind = "unique" if nulls_aside else "unique_combination"
        if number in suspected:
            own = suspects.filter(F.col("rule") == number).select("hash")
            rows = tables[table].select(*columns, _hash(columns).alias("hash"))
            met = rows.join(own, "hash", "left_semi")
            groups = unique(met, columns[0]) if nulls_aside else unique_combination(met, columns)
        else:
            groups = suspects.limit(0)
        results.append(_labelled(groups, kind, table, ", ".join(columns)))
    return results


def run_checks(tables: Mapping[str, DataFrame], contract: Mapping[str, TableChecks]) -> DataFrame:
    """One result row per check: (check_name, table_name, column_name, failures, passed)."""
    results: list[DataFrame] = []
    for name, checks in contract.items():
        df = tables[name]
        results += [
            part
            for part in (_row_checks(name, df, checks), _key_checks(name, df, checks, tables))
            if part is not None
        ]
    results += _uniqueness_checks(tables, contract)
    return reduce(DataFrame.unionByName, results).withColumn("passed", F.col("failures") == 0)


def run_checks_measured(tables: Mapping[str, DataFrame], contract: Mapping[str, TableChecks]
                        ) -> DataFrame:
    """The same with ``seconds``: how long the checks of the row's table took. Tables are checked
    one after the other, and each one's results are stored."""
    parts = []
    for name, checks in contract.items():
        if checks.count() == 0:
            continue
        start = time.perf_counter()
        results = written(run_checks(tables, {name: checks}), "check_results")
        parts.append(results.withColumn("seconds", F.lit(time.perf_counter() - start)))
    return reduce(DataFrame.unionByName, parts)


def summarize(results: DataFrame) -> DataFrame:
    """Checks run, passed and failed per kind of check."""
    return results.groupBy("check_name").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.sum("failures").alias("failures"),
    )


def failing(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("passed"))


def contract_size(contract: Mapping[str, TableChecks] | Iterable[TableChecks]) -> int:
    checks = contract.values() if isinstance(contract, Mapping) else contract
    return sum(c.count() for c in checks)
