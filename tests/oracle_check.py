"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
Mirrors the driver's check: row count, column names, and an
order-insensitive comparison of all values.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((norm(k), norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir, names=None):
    from __spark_entry__ import oracle_sql, queries
    q, o = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(q):
        t0 = time.time()
        df = q[name](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        t1 = time.time()
        if name not in o:
            results[name] = ("rows-only", len(srows), round(t1 - t0, 2))
            continue
        cur = con.execute(o[name])
        dcols = [d[0] for d in cur.description]
        drows = cur.fetchall()
        ok_cols = sorted(scols) == sorted(dcols)
        ok_n = len(srows) == len(drows)
        ok_v = ok_cols and rows_of(scols, srows) == rows_of(dcols, drows)
        status = "OK" if (ok_cols and ok_n and ok_v) else "MISMATCH"
        results[name] = (status, len(srows), len(drows), round(t1 - t0, 2))
        if status != "OK":
            print(name, "cols", sorted(scols), sorted(dcols)) if not ok_cols else None
            if ok_cols:
                a, b = rows_of(scols, srows), rows_of(dcols, drows)
                diff = [x for x in a if x not in set(b)][:3]
                diff2 = [x for x in b if x not in set(a)][:3]
                print(name, "spark-only", diff, "\n   duck-only", diff2)
    return results


if __name__ == "__main__":
    args = sys.argv[1:]
    plain = "--plain" in args  # a bare session, as the driver builds it
    args = [a for a in args if a != "--plain"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    if plain:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    else:
        from pricefold.session import session
        spark = session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    res = compare(spark, sf, args[1:] or None)
    for k, v in res.items():
        print(f"{k:28s} {v}")
    bad = [k for k, v in res.items() if v[0] == "MISMATCH"]
    print("MISMATCHES:", bad)
