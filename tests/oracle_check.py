"""Run registered queries next to their DuckDB oracles and compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.sources.testdata import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, _dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _key(row):
    return tuple((0, "") if v is None else (1, str(v)) for v in row)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(rows, key=_key)


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    s_cols, s_rows = rows_of(sdf.columns, s_rows)
    res = con.execute(sql)
    d_cols_raw = [d[0] for d in res.description]
    d_cols, d_rows = rows_of(d_cols_raw, res.fetchall())
    ok = s_cols == d_cols and s_rows == d_rows
    detail = ""
    if s_cols != d_cols:
        detail = f"columns differ: {s_cols} vs {d_cols}"
    elif len(s_rows) != len(d_rows):
        detail = f"rows {len(s_rows)} vs {len(d_rows)}"
    elif not ok:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        detail = f"values differ, e.g. {diff}"
    return ok, len(s_rows), t_spark, detail


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from tillroll.plans.oracle import ORACLE_SQL
    from tillroll.plans.registry import QUERIES
    from tillroll.session import local_session
    spark = local_session(8, 8)
    con = duck(sf_dir)
    bad = 0
    for name in names or list(QUERIES):
        if name not in ORACLE_SQL:
            print(f"{name:28s} (no oracle)")
            continue
        try:
            ok, n, t, detail = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], sf_dir)
        except Exception as e:  # report and go on
            ok, n, t, detail = False, -1, 0.0, f"{type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={n:<7d} {t:6.2f}s {detail}", flush=True)
    print(f"{bad} mismatches")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
