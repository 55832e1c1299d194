"""Compares a registered query with its SQL twin run by DuckDB on the same files."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402

SMALLEST = "/root/testdata/sf0.001"
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, [tuple(_cell(r[c]) for c in names) for r in df.collect()]


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], [
        tuple(_cell(row[i]) for i in order) for row in cursor.fetchall()
    ]


def kinds(rows: list[tuple]) -> list[str]:
    found = []
    for column in zip(*rows, strict=True):
        names = {type(v).__name__ for v in column if v is not None}
        found.append("/".join(sorted(names)))
    return found


def difference(spark, con, name: str, folder: str) -> str | None:
    """None when equal, else what differs."""
    df = entry.queries()[name](spark, folder)
    plan = df._jdf.queryExecution().toString()
    if "CartesianProduct" in plan or "NestedLoopJoin" in plan:
        return "a cross join in the plan"
    names, got = spark_rows(df)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    want_names, want = sql_rows(con, sql)
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if not got:
        return "no rows on either side"
    got, want = sorted(got, key=repr), sorted(want, key=repr)
    if kinds(got) != kinds(want):
        return f"types {kinds(got)} != {kinds(want)} for {names}"
    bad = [(a, b) for a, b in zip(got, want, strict=True) if repr(a) != repr(b)]
    if bad:
        return f"{len(bad)} of {len(got)} rows, first\n  {bad[0][0]}\n  {bad[0][1]}\n  {names}"
    return None


if __name__ == "__main__":
    from liftwise.session import local_session

    where = sys.argv[1]
    picked = sys.argv[2:]
    session = local_session(cores="8")
    if os.environ.get("MANY_SLICES"):
        session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    base = database(where)
    failed = 0
    for query in entry.queries():
        if picked and not any(query.startswith(p) for p in picked):
            continue
        start = time.time()
        try:
            problem = difference(session, base, query, where)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        kind = "sql" if query in entry.oracle_sql() else "rows"
        failed += problem is not None
        print(f"@@ {query} {kind} {time.time() - start:.1f}s {problem or 'ok'}", flush=True)
    print("@@ failed", failed)
