"""Runs a query beside its SQL and compares the rows; also usable as ``python tests/compare.py NAME... [--dir D]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
DATA = "/root/testdata"


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{folder}/*.parquet"):
        src = f"{p}/*.parquet" if os.path.isdir(p) else p
        con.execute(f"CREATE VIEW {Path(p).stem} AS SELECT * FROM '{src}'")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, list):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, name: str, folder: str):
    import __spark_entry__ as e

    t = time.time()
    df = e.queries()[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - t
    sql = e.oracle_sql().get(name)
    if sql is None:
        return {"rows": len(got), "s": took, "ok": None, "cols": df.columns}
    cur = duck(folder).execute(sql)
    cols = [c[0] for c in cur.description]
    want = rows_of(cols, cur.fetchall())
    ok = sorted(cols) == sorted(df.columns) and got == want
    out = {"rows": len(got), "want": len(want), "s": took, "ok": ok}
    if not ok:
        out |= {"cols": (sorted(df.columns), sorted(cols)), "only_spark": [r for r in got if r not in set(want)][:3], "only_sql": [r for r in want if r not in set(got)][:3]}
    return out


if __name__ == "__main__":
    from sigmill.session import build_session

    args = sys.argv[1:]
    folder = f"{DATA}/sf0.01"
    if "--dir" in args:
        i = args.index("--dir")
        folder = args[i + 1]
        del args[i : i + 2]
    import __spark_entry__ as e

    spark = build_session("local[8]", spark__driver__memory="12g")
    bad = 0
    for n in args or list(e.queries()):
        try:
            r = compare(spark, n, folder)
        except Exception as x:  # noqa: BLE001
            r = {"ok": False, "error": f"{type(x).__name__}: {str(x)[:600]}"}
        bad += r["ok"] is False
        print(n, r, flush=True)
    print("bad", bad)
