"""Compares registered queries with their SQL; also a script over all of them."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'"
        )
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by value, times at one resolution, one null."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[name]):
            frame[name] = frame[name].astype("datetime64[us]")
    frame = frame.sort_values(list(frame.columns), kind="stable").reset_index(drop=True)
    return frame.astype(object).where(frame.notna(), None)


def differences(spark, connection, sf_dir: str, run, sql: str) -> list[str]:
    got = canonical(run(spark, sf_dir).toPandas())
    want = canonical(connection.execute(sql).df())
    if list(got.columns) != list(want.columns):
        return [f"columns {list(got.columns)} != {list(want.columns)}"]
    if len(got) != len(want):
        return [f"rows {len(got)} != {len(want)}"]
    found = []
    for name in got.columns:
        unequal = [
            (g, w) for g, w in zip(got[name], want[name]) if g != w
        ]
        if unequal:
            found.append(f"{name}: {len(unequal)} differ, such as {unequal[0]}")
    return found


def main(sf_dir: str, names: list[str]) -> int:
    from conftest import make_session

    import __spark_entry__ as entry

    spark = make_session()
    connection = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    print("without SQL:", sorted(set(queries) - set(oracles)))
    print("without query:", sorted(set(oracles) - set(queries)))
    failed = 0
    for name in names or sorted(queries):
        if name not in oracles:
            continue
        started = time.time()
        try:
            found = differences(spark, connection, sf_dir, queries[name], oracles[name])
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{name:28s} {time.time() - started:6.1f}s {found or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.path[:0] = ["/root/repo", "/root/repo/tests"]
    sys.exit(main(sys.argv[1], sys.argv[2:]))
