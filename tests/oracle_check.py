"""Run a registered query on Spark and its oracle SQL on DuckDB and compare the results the
way the driver does: column names sorted, row count, order-free hash of the values."""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.md5("\n".join(keyed).encode()).hexdigest(), keyed


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    t2 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols), "spark_s": round(t1 - t0, 2),
           "duck_s": round(t2 - t1, 2)}
    hs, ks = _digest(s_cols, s_rows)
    hd, kd = _digest(d_cols, d_rows)
    res["hash_match"] = hs == hd
    if not res["hash_match"]:
        only_s = sorted(set(ks) - set(kd))[:3]
        only_d = sorted(set(kd) - set(ks))[:3]
        res["example_spark_only"] = only_s
        res["example_oracle_only"] = only_d
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    return res


if __name__ == "__main__":
    import json

    from sqlweave.session import get_session
    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf)
    bad = 0
    for n in (names or sorted(qs)):
        if n not in os_:
            df = qs[n](spark, sf)
            print(json.dumps({"name": n, "rows_only": df.count()}))
            continue
        try:
            r = compare(spark, n, qs[n], os_[n], sf, con)
        except Exception as e:  # report and go on
            r = {"name": n, "error": repr(e)[:800]}
        ok = r.get("hash_match") and r.get("cols_match")
        bad += not ok
        print(("OK   " if ok else "FAIL ") + json.dumps(r, default=str)[:1500], flush=True)
    print("failures:", bad)
