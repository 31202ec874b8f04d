"""Side-by-side run of registered queries and their SQL."""

from __future__ import annotations

import contextlib
import glob
import io
import os
import sys
import time

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plan_text(frame) -> str:
    """The physical plan as text."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    return text.getvalue()


def table_rows(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def difference(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides give the same columns and rows, else a short account."""
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    expected = table_rows(columns, result.fetchall())
    found = table_rows(frame.columns, [tuple(r) for r in frame.collect()])
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(columns)}"
    if found != expected:
        only = [r for r in found if r not in set(expected)][:2]
        missing = [r for r in expected if r not in set(found)][:2]
        return f"{len(found)} rows for {len(expected)}; extra {only}; missing {missing}"[:3000]
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from conftest import session

    spark = session()
    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(queries())
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            frame = queries()[name](spark, sf_dir)
            sql = oracle_sql().get(name)
            note = difference(frame, connection, sql) if sql else f"no SQL, {frame.count()} rows"
        except Exception as problem:
            note = f"{type(problem).__name__}: {str(problem)[:1500]}"
        failed += bool(note) and not str(note).startswith("no SQL")
        print(f"{name:40s} {time.time() - start:6.2f}s {'ok' if note is None else note}", flush=True)
    print(f"{len(names)} queries, {failed} different")
