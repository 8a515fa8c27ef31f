"""Run registered queries and their SQL on the same tables and compare all values."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value) -> str:
    return repr(round(value, 9)) if isinstance(value, float) else str(value)


def _rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def check(spark, con, sf_dir: str, name: str, query, sql: str | None) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    rows = df.collect()
    if sql is None:
        return None if rows else "no rows"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    mine, other = _rows(df.columns, rows), _rows(columns, result.fetchall())
    if len(mine) != len(other):
        return f"{len(mine)} rows against {len(other)}"
    for a, b in zip(mine, other):
        if a != b:
            return f"{sorted(columns)}\n   {a}\n   {b}"
    return None


if __name__ == "__main__":
    from tests.conftest import build_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    spark, con = build_session(), connect(sf_dir)
    names = sys.argv[2:] or list(queries())
    oracles = oracle_sql()
    print("without query:", set(oracles) - set(queries()), "without sql:", set(queries()) - set(oracles))
    for name in names:
        began = time.time()
        try:
            bad = check(spark, con, sf_dir, name, queries()[name], oracles.get(name))
        except Exception as error:
            bad = f"{type(error).__name__} {str(error)[:1500]}"
        print(f"{'ok  ' if bad is None else 'BAD '} {name} {time.time() - began:.2f}s {bad or ''}", flush=True)
