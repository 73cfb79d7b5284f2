"""Run catalogue queries in Spark and their SQL oracle in DuckDB, compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names (sorted) and an order-insensitive hash of
the values, as the round driver does; prints one line per query.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def run(sf_dir, names=None, verbose=True):
    from __spark_entry__ import oracle_sql, queries
    from waymark.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, os_ = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK_ERROR", str(e)[:300])
            print(f"{name:32s} SPARK_ERROR {str(e)[:300]}")
            continue
        ts = time.time() - t0
        if name not in os_:
            results[name] = ("ROWS_ONLY", len(rows))
            print(f"{name:32s} rows-only  spark_rows={len(rows)}  {ts:.1f}s")
            continue
        try:
            rel = con.sql(os_[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SQL_ERROR", str(e)[:300])
            print(f"{name:32s} SQL_ERROR {str(e)[:300]}")
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(dcols, drows)
        ok = sorted(cols) == sorted(dcols) and len(rows) == len(drows) and h1 == h2
        results[name] = ("MATCH" if ok else "MISMATCH", len(rows), len(drows))
        print(f"{name:32s} {'MATCH' if ok else 'MISMATCH'} rows={len(rows)}/{len(drows)} "
              f"cols_equal={sorted(cols) == sorted(dcols)} {ts:.1f}s")
        if not ok and verbose:
            if sorted(cols) != sorted(dcols):
                print("   spark cols:", cols, "\n   duck cols: ", dcols)
            s1, s2 = set(l1), set(l2)
            for x in sorted(s1 - s2)[:3]:
                print("   spark only:", x[:300])
            for x in sorted(s2 - s1)[:3]:
                print("   duck only: ", x[:300])
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    run(sf, sys.argv[2:] or None)
