"""Runs queries on Spark and on DuckDB over the same tables and compares rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402


def duck(folder: str):
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def differences(spark, connection, name: str, folder: str) -> str | None:
    """None when both sides agree, else a short account of the difference."""
    got = entry.queries()[name](spark, folder)
    got_rows = normal([tuple(r) for r in got.collect()], got.columns)
    relation = connection.sql(entry.oracle_sql()[name])
    want_rows = normal(relation.fetchall(), relation.columns)
    if sorted(got.columns) != sorted(relation.columns):
        return f"columns {sorted(got.columns)} instead of {sorted(relation.columns)}"
    if got_rows != want_rows:
        extra = [r for r in got_rows if r not in set(want_rows)][:2]
        lacking = [r for r in want_rows if r not in set(got_rows)][:2]
        return f"{len(got_rows)} rows instead of {len(want_rows)}; extra {extra}; lacking {lacking}"
    return None if want_rows else "both sides are empty"


if __name__ == "__main__":
    from conftest import make_session

    folder = sys.argv[1]
    names = sys.argv[2:] or list(entry.oracle_sql())
    spark, connection = make_session(), duck(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = differences(spark, connection, name, folder)
        except Exception as failure:
            problem = f"{type(failure).__name__}: {str(failure)[:1500]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("wrong:", bad, "of", len(names))
