"""Run the Spark queries and their SQL twins side by side.

    python -m checks.compare [--sf 0.01] [--freeze] [name ...]

``--freeze`` records the column types each query publishes in types.json.
"""

from __future__ import annotations

import argparse
import json
import math
import threading
import time

import duckdb

from coinloft.session import build

from . import all_checks
from .core import SPARK, SQL, TYPES_FILE, runner, typed

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--freeze", action="store_true")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    all_checks()
    folder = f"/root/testdata/sf{args.sf}"
    spark = build(master="local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    names = [n for n in SPARK if not args.names or any(n == a or n.startswith(a + "*") or (a.endswith("*") and n.startswith(a[:-1])) for a in args.names)]
    known = json.loads(TYPES_FILE.read_text()) if TYPES_FILE.exists() else {}
    bad = 0
    for name in names:
        t0 = time.time()
        watch = threading.Timer(120, spark.sparkContext.cancelAllJobs)
        watch.start()
        try:
            df = runner(name)(spark, folder)
            types = dict(df.dtypes)
            if args.freeze:
                known[name] = types
                TYPES_FILE.write_text(json.dumps(known, indent=0, sort_keys=True))
            elif known.get(name) != types:
                print(f"TYPES  {name} not frozen")
            mine = [tuple(r) for r in df.collect()]
            t1 = time.time()
            if name not in SQL:
                print(f"rows   {name} {len(mine)} rows {t1 - t0:.1f}s", flush=True)
                continue
            cur = con.execute(typed(name))
            cols = [d[0] for d in cur.description]
            theirs = cur.fetchall()
            t2 = time.time()
            a, b = _rows(df.columns, mine), _rows(cols, theirs)
            if sorted(cols) != sorted(df.columns):
                bad += 1
                print(f"COLS   {name} {sorted(set(cols) ^ set(df.columns))}")
            elif a == b:
                print(f"ok     {name} {len(a)} rows spark {t1 - t0:.1f}s sql {t2 - t1:.1f}s", flush=True)
            else:
                bad += 1
                print(f"DIFF   {name} spark {len(a)} sql {len(b)}")
                only = [r for r in a if r not in set(b)][:3] if len(a) < 100000 else a[:2]
                other = [r for r in b if r not in set(a)][:3] if len(a) < 100000 else b[:2]
                print("   cols ", sorted(cols))
                for r, s in zip(only, other):
                    print("   spark", r)
                    print("   sql  ", s)
                    print("   at   ", [(c, x, y) for c, x, y in zip(sorted(cols), r, s) if x != y][:6])
        except Exception as e:  # report and go on
            bad += 1
            print(f"FAIL   {time.time() - t0:.0f}s {name} {type(e).__name__} {str(e)[:600]}", flush=True)
        finally:
            watch.cancel()
    print(f"{len(names)} queries, {bad} bad")
    spark.stop()


if __name__ == "__main__":
    main()
