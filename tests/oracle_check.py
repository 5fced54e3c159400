"""Local stand-in for the driver's correctness check: run a registered query
in Spark and its SQL in DuckDB over the same parquet tables, then compare row
count, column names and the multiset of normalised rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, name, q, sql, sf_dir, con=None, show=5):
    con = con or duck(sf_dir)
    sdf = q(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(norm(r[c]) for c in sorted(scols)) for r in sdf.collect()]
    rel = con.sql(sql)
    dcols = rel.columns
    drows_raw = rel.fetchall()
    idx = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = [tuple(norm(r[i]) for i in idx) for r in drows_raw]
    ok_cols = sorted(scols) == sorted(dcols)
    cs, cd = Counter(srows), Counter(drows)
    ok = ok_cols and cs == cd
    msg = f"{name}: spark={len(srows)} duck={len(drows)} cols_ok={ok_cols} values_ok={cs == cd}"
    if not ok:
        if not ok_cols:
            msg += f"\n  spark cols={sorted(scols)}\n  duck  cols={sorted(dcols)}"
        else:
            only_s = list((cs - cd).elements())[:show]
            only_d = list((cd - cs).elements())[:show]
            msg += f"\n  cols={sorted(scols)}\n  only spark: {only_s}\n  only duck: {only_d}"
    return ok, msg


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import time
    import __spark_entry__ as E
    from ledgerlake.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in sys.argv[1:] if not a.startswith("/")]
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf)
    bad = 0
    for n in names or list(qs):
        t = time.time()
        if n not in sqls:
            c = qs[n](spark, sf).count()
            print(f"{n}: rows-only {c} ({time.time() - t:.1f}s)", flush=True)
            continue
        try:
            ok, msg = compare(spark, n, qs[n], sqls[n], sf, con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:800]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg + f" ({time.time() - t:.1f}s)", flush=True)
    print("failures:", bad)
