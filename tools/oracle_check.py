"""Run registered queries in Spark and their SQL in DuckDB, and compare.

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [name ...]

Columns are compared by name (sorted), rows as an order-insensitive multiset
of exact values, the same way the driver's correctness gate compares them.
"""

from __future__ import annotations

import argparse
import collections
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import numpy as np  # noqa: E402

from tessera.plans import catalog  # noqa: E402
from tessera.session import get_session  # noqa: E402
from tessera.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, (np.floating,)):
        return norm(float(v))
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    if isinstance(v, float) and v == int(v) and abs(v) < 2**53:
        return float(v)
    return v


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
                 "timestamp": "TIMESTAMP", "date": "DATE"}


def duck_type(t: str) -> str:
    if t.startswith("array<") and t.endswith(">"):
        return duck_type(t[6:-1]) + "[]"
    return SPARK_TO_DUCK.get(t, t.upper())


def rows_of(records, cols):
    return collections.Counter(tuple(norm(r[c]) for c in cols) for r in records)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--plain", action="store_true", help="a default session, as a driver might use")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    if args.plain:
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = get_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    qs, sql = catalog.queries(), catalog.oracle_sql()
    names = args.names or sorted(qs)
    ok_all = True
    for name in names:
        t0 = time.time()
        try:
            sdf = qs[name](spark, args.sf)
            srows = [r.asDict(recursive=True) for r in sdf.collect()]
            scols = sorted(sdf.columns)
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK-ERROR {type(e).__name__}: {str(e)[:400]}")
            ok_all = False
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"{name:32s} rows-only  spark={len(srows)} rows {ts:.1f}s")
            continue
        try:
            cur = con.execute(sql[name])
            dcols_raw = [d[0] for d in cur.description]
            drecs = [dict(zip(dcols_raw, r)) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} DUCKDB-ERROR {type(e).__name__}: {str(e)[:400]}")
            ok_all = False
            continue
        dcols = sorted(dcols_raw)
        try:
            dtypes = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql[name]).fetchall()}
            stypes = {f.name: duck_type(f.dataType.simpleString()) for f in sdf.schema.fields}
            bad = {c: (stypes.get(c), dtypes.get(c)) for c in dtypes if stypes.get(c) != dtypes.get(c)}
            if bad:
                print(f"{name:32s} TYPES {bad}")
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} TYPES? {str(e)[:200]}")
        if scols != dcols:
            print(f"{name:32s} COLUMNS spark={scols} duck={dcols}")
            ok_all = False
            continue
        a, b = rows_of(srows, scols), rows_of(drecs, dcols)
        same = a == b
        ok_all &= same
        print(f"{name:32s} {'OK  ' if same else 'DIFF'} spark={len(srows)} duck={len(drecs)} {ts:.1f}s")
        if not same:
            only_s = list((a - b).items())[:3]
            only_d = list((b - a).items())[:3]
            print("   spark-only:", str(only_s)[:600])
            print("   duck-only: ", str(only_d)[:600])
    spark.stop()
    sys.exit(0 if ok_all else 1)


if __name__ == "__main__":
    main()
