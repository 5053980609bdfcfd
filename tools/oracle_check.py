"""Run every registered query in Spark and its oracle SQL in DuckDB, compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH with row counts and the first diff.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from passante.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(canon(r[i]) for i in order) for r in records)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    import importlib.util
    spec = importlib.util.spec_from_file_location(
        "entry", os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:34s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:34s} rows-only spark={len(srows)} ({ts:.1f}s)")
            continue
        try:
            res = con.sql(sqls[name])
            dcols = res.columns
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:34s} DUCK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        ok = sorted(scols) == sorted(dcols) and a == b
        h = hashlib.md5("\n".join(a).encode()).hexdigest()[:8]
        if ok:
            print(f"{name:34s} OK rows={len(a)} hash={h} ({ts:.1f}s)")
        else:
            bad += 1
            print(f"{name:34s} MISMATCH spark={len(a)} duck={len(b)} cols={sorted(scols)} vs {sorted(dcols)}")
            da, db = set(a) - set(b), set(b) - set(a)
            for x in list(da)[:2]:
                print("   spark-only:", x[:300])
            for x in list(db)[:2]:
                print("   duck-only: ", x[:300])
    print("FAILED" if bad else "ALL OK", bad)
    spark.stop()


if __name__ == "__main__":
    main()
