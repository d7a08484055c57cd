"""Run every registered query on Spark and its oracle on DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: status, rows, and the first difference found.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "is_finite"):  # Decimal
        return repr(round(float(v), 9))
    return repr(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as entry
    from ordertide.session import local_session

    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL  {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            continue
        dt = time.time() - t0
        if name not in oracles:
            print(f"ROWS  {name}: {len(rows)} rows ({dt:.1f}s) cols={cols}")
            continue
        res = con.sql(oracles[name])
        ocols = res.columns
        orows = res.fetchall()
        if sorted(cols) != sorted(ocols):
            bad += 1
            print(f"FAIL  {name}: columns {sorted(cols)} vs {sorted(ocols)}")
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        if h1 == h2:
            print(f"OK    {name}: {len(rows)} rows ({dt:.1f}s)")
        else:
            bad += 1
            s1, s2 = set(l1), set(l2)
            print(f"FAIL  {name}: {len(rows)} vs {len(orows)} rows; spark-only {sorted(s1 - s2)[:2]} oracle-only {sorted(s2 - s1)[:2]}")
    print("failures:", bad)


if __name__ == "__main__":
    main()
