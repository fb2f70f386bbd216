"""Run registered queries against their SQL in DuckDB.

python tests/check_queries.py [--sf 0.01] [name prefix ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tidegauge.plans.registry import NAMES  # noqa: E402
from tidegauge.session import build_session  # noqa: E402

DATA = os.environ.get("TIDEGAUGE_DATA", "/root/testdata")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


SAME_TYPE = {"tinyint": "TINYINT", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
             "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN", "decimal(4,2)": "DECIMAL(4,2)",
             "array<string>": "VARCHAR[]"}


def normal(value):
    if isinstance(value, float) and value == 0:
        return 0.0
    return tuple(normal(v) for v in value) if isinstance(value, (list, tuple)) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, folder):
    """None when equal, otherwise a description of the first difference."""
    df = entry.queries()[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None, len(got), "rows only"
    rel = con.sql(sql)
    want = rel.fetchall()
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} against {sorted(rel.columns)}", len(got), ""
    a, b = rows_of(df.columns, got), rows_of(rel.columns, want)
    other = dict(zip(rel.columns, (str(x) for x in rel.types)))
    types = " ".join(f"{c}:{ty}/{other[c]}" for c, ty in sorted(df.dtypes) if SAME_TYPE.get(ty) != other[c])
    if a != b:
        if len(a) != len(b):
            return f"{len(a)} rows against {len(b)}; first {a[:2]} against {b[:2]}", len(got), types
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} of {len(a)} rows differ on {sorted(df.columns)}: {bad[:2]}", len(got), types
    return None, len(got), types


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"{DATA}/sf{args.sf}"
    spark, con = build_session("local[8]"), connect(folder)
    failed = 0
    for name in entry.queries():
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        start = time.time()
        try:
            problem, n, note = compare(spark, con, name, folder)
        except Exception as e:  # noqa: BLE001
            problem, n, note = f"{type(e).__name__}: {str(e)[:600]}", 0, ""
        failed += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:34s} {time.time() - start:6.2f}s {n:8d} rows {note} {problem or ''}",
              flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
