"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Comparison: same column names, same row count, same multiset of rows with
exact values (floats bit-equal); float mismatches within 1e-9 relative are
reported separately as ``approx``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def canon(v, exact=True):
    from pyspark.sql import Row
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v) if exact else f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return canon(float(v), exact)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, Row):
        return tuple(sorted((k, canon(x, exact)) for k, x in v.asDict().items()))
    if isinstance(v, dict):
        return tuple(sorted((str(k), canon(x, exact)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(canon(x, exact) for x in v)
    return str(v)


def rows_of(cols, rows, exact):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(canon(r[i], exact) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    out = {"name": name, "spark_rows": len(srows), "duck_rows": len(drows),
           "spark_s": round(t1 - t0, 2), "cols_match": sorted(scols) == sorted(dcols)}
    if not out["cols_match"]:
        out["spark_cols"], out["duck_cols"] = sorted(scols), sorted(dcols)
    a, b = rows_of(scols, srows, True), rows_of(dcols, drows, True)
    out["exact"] = a == b
    if not out["exact"]:
        a2, b2 = rows_of(scols, srows, False), rows_of(dcols, drows, False)
        out["approx"] = a2 == b2
        diff = [x for x in a if x not in set(b)][:3]
        diff2 = [x for x in b if x not in set(a)][:3]
        out["spark_only"], out["duck_only"] = diff, diff2
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from tillpanel.oracles import ORACLES
    from tillpanel.queries import QUERIES
    from tillpanel.session import get_spark
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        if name not in ORACLES:
            n = fn(spark, sf_dir).count()
            print(f"{name:36s} no-oracle rows={n}")
            continue
        try:
            r = compare(spark, con, name, fn, ORACLES[name], sf_dir)
        except Exception as exc:  # report and continue
            bad += 1
            print(f"{name:36s} ERROR {type(exc).__name__}: {str(exc)[:400]}")
            continue
        ok = r["exact"] and r["cols_match"]
        bad += not ok
        print(f"{name:36s} {'OK ' if ok else 'BAD'} rows={r['spark_rows']}/{r['duck_rows']} "
              f"{r['spark_s']}s" + ("" if ok else f" {r}"))
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
