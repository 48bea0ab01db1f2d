"""Compare registered queries with their SQL on one data folder: ``python -m tests.compare``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def normal(value) -> str:
    if value is None or value is pd.NaT:
        return "NULL"
    if isinstance(value, float):
        return "NULL" if value != value else repr(value)
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10]
    return str(value)


# Spark type -> type of the same name in SQL
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "boolean": "BOOLEAN"}


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(con, spark_df, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} <> {sorted(columns)}"
    expected = rows_of(columns, cursor.fetchall())
    types = {row[0]: row[1] for row in con.execute(f"describe {sql}").fetchall()}
    other = {c: (t, types[c]) for c, t in spark_df.dtypes if TYPES.get(t) != types[c]}
    if other:
        return f"types {other}"
    actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if expected == actual:
        return None
    missing = [r for r in expected if r not in set(actual)][:2]
    surplus = [r for r in actual if r not in set(expected)][:2]
    return f"{len(actual)} rows <> {len(expected)}; only SQL {missing}; only Spark {surplus}"


def main(folder: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from shelfwise.session import local_session

    spark, con, failed = local_session(8), database(folder), 0
    oracles = oracle_sql()
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in oracles:
                problem = compare(con, df, oracles[name])
                what = "ok" if problem is None else "DIFF " + problem
            else:
                what = f"no SQL, {df.count()} rows"
        except Exception as error:  # report and go on
            what = f"ERROR {type(error).__name__} {' '.join(str(error)[:400].split())}"
        failed += what.startswith(("DIFF", "ERROR"))
        print(f"{name:34s} {time.time() - start:6.1f}s {what}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
