"""Run registered queries in Spark and their SQL twins in DuckDB and compare results.

Usage: python tests/compare.py [sf_dir] [name ...]
Compares row count, column names and the sorted multiset of rows (doubles rounded to 6 digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def duck_con(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_con(sf_dir)
    results = {}
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e)[:300])
            print(name, "SPARK-ERROR", str(e)[:600], flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("rows-only", len(srows))
            print(f"{name}: rows-only {len(srows)} rows spark {ts:.1f}s", flush=True)
            continue
        try:
            r = con.execute(sqls[name])
            dcols = [d[0] for d in r.description]
            drows = r.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SQL-ERROR", str(e)[:300])
            print(name, "SQL-ERROR", str(e)[:600], flush=True)
            continue
        ok_cols = sorted(cols) == sorted(dcols)
        a, b = _rows(cols, srows), _rows(dcols, drows)
        same = ok_cols and a == b
        results[name] = ("OK" if same else "MISMATCH", len(srows), len(drows))
        print(f"{name}: {'OK' if same else 'MISMATCH'} spark={len(srows)} duck={len(drows)} cols_ok={ok_cols} {ts:.1f}s", flush=True)
        if not same and verbose:
            if not ok_cols:
                print("   spark cols", cols, "\n   duck cols", dcols)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            for x, y in diff:
                print("   spark", x, "\n   duck ", y)
    return results


if __name__ == "__main__":
    from foldwise.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "rows-only")]
    print("FAILED:", bad if bad else "none")
