"""Spark vs DuckDB comparison used by the tests and by hand.

Mirrors the driver's check: same columns (sorted by name), same row count,
same multiset of rows.  Decimals and timestamps are compared as Python
values; floats are rounded to 9 significant digits.
"""

from __future__ import annotations

import decimal
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return v  # strict: the scale must match too
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols, srows = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    t1 = time.time()
    res = con.execute(sql)
    dcols, drows = rows_of([d[0] for d in res.description], res.fetchall())
    ok = scols == dcols and srows == drows
    info = {"name": name, "ok": ok, "spark_rows": len(srows), "duck_rows": len(drows), "sec": round(t1 - t0, 2)}
    if not ok:
        info["spark_cols"], info["duck_cols"] = scols, dcols
        sset, dset = set(srows), set(drows)
        info["only_spark"] = [r for r in srows if r not in dset][:3]
        info["only_duck"] = [r for r in drows if r not in sset][:3]
    return info


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from dvspark.plans import catalog
    from dvspark.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(catalog.QUERIES)
    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        if n not in catalog.ORACLE:
            t0 = time.time()
            cnt = catalog.QUERIES[n](spark, sf_dir).count()
            print({"name": n, "ok": None, "spark_rows": cnt, "sec": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            info = compare(spark, con, n, catalog.QUERIES[n], catalog.ORACLE[n], sf_dir)
        except Exception as e:  # report and continue
            info = {"name": n, "ok": False, "error": repr(e)[:800]}
        bad += not info["ok"]
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
