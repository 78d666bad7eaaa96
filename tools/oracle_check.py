"""Run registered queries on Spark and their SQL oracle on DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
Compares column names, row counts and sorted row values (doubles exactly,
like a value hash would).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from widetab.plans.registry import load_all  # noqa: E402
from widetab.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(float(v)))
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, int):
        return (1, repr(float(v)) if abs(v) < 2**53 else str(v))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return (1, str([norm(x) for x in v]))
    return (1, str(v))


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    reg = load_all()
    names = args or sorted(reg)
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name in names:
        q = reg[name]
        t0 = time.time()
        try:
            sdf = q.build(spark, sf_dir)
            srows = sdf.collect()
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"rows {name}: {len(srows)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            res = con.execute(q.sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns spark={sorted(scols)} duck={sorted(dcols)}")
            bad += 1
            continue
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        sv = sorted(tuple(norm(r[i]) for i in si) for r in srows)
        dv = sorted(tuple(norm(r[i]) for i in di) for r in drows)
        if len(sv) != len(dv):
            print(f"FAIL {name}: rows spark={len(sv)} duck={len(dv)}")
            bad += 1
            continue
        diff = [(a, b) for a, b in zip(sv, dv) if a != b]
        if diff:
            print(f"FAIL {name}: {len(diff)} differing rows; first: {order}\n  spark={diff[0][0]}\n  duck ={diff[0][1]}")
            bad += 1
            continue
        print(f"ok   {name}: {len(sv)} rows ({ts:.1f}s)")
    print(f"{bad} failing of {len(names)}")


if __name__ == "__main__":
    main()
