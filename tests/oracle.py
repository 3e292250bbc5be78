"""Run registered queries against DuckDB on the same tables."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v + 0.0) if v != int(v) or abs(v) > 1e15 else repr(int(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return repr(v)
    if isinstance(v, datetime.datetime) and v.time() == datetime.time():
        return str(v.date())
    return None if v is None else str(v)


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(norm(r[i])) for i in order) for r in rows)


def compare(spark, name: str, folder: str):
    """(ok, message) for one query."""
    import __spark_entry__ as entry

    t0 = time.time()
    df = entry.queries()[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - t0
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return bool(rows), f"{len(rows)} rows, no SQL, {took:.1f}s"
    con = connect(folder)
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    if sorted(cols) != sorted(df.columns):
        return False, f"columns differ: spark-only {sorted(set(df.columns) - set(cols))} sql-only {sorted(set(cols) - set(df.columns))}"
    got, want = normal_rows(df.columns, rows), normal_rows(cols, want_rows)
    if got == want:
        return bool(rows), f"{len(rows)} rows equal, {took:.1f}s"
    only_got, only_want = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return False, (
        f"rows {len(got)} vs {len(want)}; differing {len(only_got)}/{len(only_want)}\n   cols {sorted(cols)}"
        f"\n   spark {only_got[:2]}\n   sql   {only_want[:2]}"
    )


if __name__ == "__main__":
    from parcelweave.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    import __spark_entry__ as entry

    spark = local_session(8)
    bad = 0
    for n in entry.queries():
        if names and not any(n == x or (x.endswith("*") and n.startswith(x[:-1])) for x in names):
            continue
        try:
            ok, msg = compare(spark, n, folder)
        except Exception as e:  # report and go on
            ok, msg = False, f"{type(e).__name__}: {str(e)[:700]}"
        bad += not ok
        print("ok  " if ok else "FAIL", n, msg, flush=True)
    print("failed:", bad)
