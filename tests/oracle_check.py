"""Compare registered Spark queries with their DuckDB oracle SQL.

Rows are compared as multisets after normalising values (dates and
timestamps to ISO text, floats to 6 decimals, NaN/None to null), with columns
sorted by name, which is how the correctness gate compares them.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
from collections import Counter

import duckdb  # noqa: I001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(norm(r[c]) for c in cols) for r in df.collect()]


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(norm(r[i]) for i in idx) for r in rel.fetchall()]


def compare(spark, con, name, fn, sql, sf_dir):
    scols, srows = rows_of_spark(fn(spark, sf_dir))
    dcols, drows = rows_of_duck(con, sql)
    if scols != dcols:
        return False, f"columns differ: spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} duck={len(drows)}"
    cs, cd = Counter(srows), Counter(drows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        return False, f"values differ; spark-only={only_s} duck-only={only_d}"
    return True, f"{len(srows)} rows"


if __name__ == "__main__":
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from ordersmith.session import build_session
    import __spark_entry__ as E
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session()
    con = duck(sf)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in os_:
            n = fn(spark, sf).count()
            print(f"ROWS  {name}: {n} rows (no oracle)")
            continue
        try:
            ok, msg = compare(spark, con, name, fn, os_[name], sf)
        except Exception as e:  # report and go on
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(("OK    " if ok else "FAIL  ") + f"{name}: {msg}", flush=True)
    print(f"{len(qs)} queries, {len(os_)} oracles, {bad} failing")
