"""Run registered queries against their DuckDB oracle, the way the driver does.

    python tests/oracle_check.py [sf_dir] [name ...]

Prints one line per query: rows, schema and order-insensitive value hash.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from wattlake.session import build_session  # noqa: E402
from wattlake.sources.adapters import TABLES  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if os.environ.get("EXACT") else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()[:12]


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:32s} rows={len(rows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            ocols = [c[0] for c in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} DUCK-ERROR {str(e)[:400]}")
            bad += 1
            continue
        ok_cols = sorted(c.lower() for c in cols) == sorted(c.lower() for c in ocols)
        h1, h2 = digest(cols, rows), digest(ocols, orows) if ok_cols else "-"
        ok = ok_cols and len(rows) == len(orows) and h1 == h2
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} rows={len(rows)}/{len(orows)} cols={'ok' if ok_cols else (cols, ocols)} "
              f"hash={h1}/{h2} {ts:.1f}s")
        if not ok and ok_cols and os.environ.get("SHOW_DIFF"):
            order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
            oorder = sorted(range(len(ocols)), key=lambda i: ocols[i].lower())
            a = {"|".join(norm(r[i]) for i in order) for r in rows}
            b = {"|".join(norm(r[i]) for i in oorder) for r in orows}
            print("  spark-only:", sorted(a - b)[:3])
            print("  duck-only: ", sorted(b - a)[:3])
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
