"""Run registered Spark queries and their DuckDB oracle side by side.

    python tests/oracle_compare.py [sf_dir] [name ...]

Prints one line per query: rows, column-set match and order-insensitive value
hash match, in the spirit of the driver's correctness gate.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def digest(columns, rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        s_rows = [tuple(r) for r in df.collect()]
        s_cols = df.columns
        t1 = time.time()
        if name not in sqls:
            results[name] = dict(rows=len(s_rows), oracle=None)
            if verbose:
                print(f"{name:38s} spark={len(s_rows):>8d}  (no oracle)  {t1 - t0:6.1f}s", flush=True)
            continue
        cur = con.execute(sqls[name])
        d_cols = [c[0] for c in cur.description]
        d_rows = cur.fetchall()
        ok_cols = sorted(s_cols) == sorted(d_cols)
        ok_rows = len(s_rows) == len(d_rows)
        ok_hash = ok_cols and digest(s_cols, s_rows) == digest(d_cols, d_rows)
        results[name] = dict(rows=len(s_rows), oracle_rows=len(d_rows), cols=ok_cols, hash=ok_hash)
        if verbose:
            flag = "OK " if (ok_cols and ok_rows and ok_hash) else "BAD"
            print(f"{flag} {name:34s} spark={len(s_rows):>8d} duck={len(d_rows):>8d} "
                  f"cols={ok_cols} hash={ok_hash}  {t1 - t0:6.1f}s", flush=True)
            if not ok_cols:
                print("   spark:", sorted(s_cols), "\n   duck: ", sorted(d_cols))
    return results


if __name__ == "__main__":
    from shelfline.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    run = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(checkpoint_dir=os.path.join(run, "ckpt"))
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v.get("oracle", 1) is not None and not (v.get("hash") and v["rows"] == v.get("oracle_rows"))]
    print("MISMATCH:", bad)
