"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of the
values (floats normalised to 9 significant digits)."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return f"{v:.9g}"
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (dt.datetime,)):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_of(records, cols):
    return sorted("|".join(_norm(r[c]) for c in cols) for r in records)


def digest(lines):
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from relist.session import get_spark
    spark = get_spark()
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    ok = bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [r.asDict(recursive=True) for r in sdf.collect()]
            scols = sorted(sdf.columns)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sql:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sql[name])
            dcols = [d[0] for d in cur.description]
            drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(dcols) != scols:
            print(f"FAIL {name}: columns spark={scols} duck={sorted(dcols)}")
            bad += 1
            continue
        a, b = rows_of(srows, scols), rows_of(drows, scols)
        if len(a) != len(b) or digest(a) != digest(b):
            print(f"FAIL {name}: rows spark={len(a)} duck={len(b)}")
            sa, sb = set(a), set(b)
            for x in sorted(sa - sb)[:3]:
                print("   spark only:", x[:300])
            for x in sorted(sb - sa)[:3]:
                print("   duck  only:", x[:300])
            bad += 1
        else:
            print(f"OK   {name}: {len(a)} rows {ts:.1f}s")
            ok += 1
    print(f"== {ok} ok, {bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
