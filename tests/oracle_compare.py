"""Compare a catalogue query with its DuckDB oracle the way the driver does:
row count, column names, and an order-insensitive hash of the values with
columns sorted by name."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    return v


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def compare(spark, name: str, sf_dir: str, con=None, verbose: bool = False) -> dict:
    from matchlake.plans.catalogue import ORACLE_SQL, QUERIES

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    sql = ORACLE_SQL.get(name)
    if sql is None:
        out["status"] = "rows-only"
        return out
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sn, sh = digest(scols, srows)
    dn, dh = digest(dcols, drows)
    out.update(duck_rows=dn, cols_match=sorted(scols) == sorted(dcols), hash_match=sh == dh)
    out["status"] = "ok" if (out["cols_match"] and sh == dh and sn == dn) else "MISMATCH"
    if verbose and out["status"] != "ok":
        out["spark_cols"], out["duck_cols"] = sorted(scols), sorted(dcols)
        order_s = sorted(range(len(scols)), key=lambda i: scols[i])
        order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
        ss = sorted(repr(tuple(_norm(r[i]) for i in order_s)) for r in srows)
        ds = sorted(repr(tuple(_norm(r[i]) for i in order_d)) for r in drows)
        out["only_spark"] = sorted(set(ss) - set(ds))[:3]
        out["only_duck"] = sorted(set(ds) - set(ss))[:3]
    return out


if __name__ == "__main__":
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from matchlake.plans.catalogue import QUERIES
    from matchlake.session import get_spark

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:] or sorted(QUERIES)
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con, verbose=True)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "status": "ERROR", "error": str(e)[:600]}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
