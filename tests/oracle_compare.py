"""Run registered queries on Spark and their oracle SQL on DuckDB, compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb
import pandas as pd

import os

EXACT = os.environ.get("ROUND") != "1"  # exact float equality unless ROUND=1

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None  # pandas turns NULL into NaN; compare them alike
        return v if EXACT else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, datetime.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, datetime.date):
        return datetime.datetime(v.year, v.month, v.day).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    rows.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return cols, rows


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s = sdf.toPandas()
    ts = time.time() - t0
    if sql is None:
        return dict(name=name, ok=None, rows=len(s), spark_sec=round(ts, 2))
    d = con.sql(sql).df()
    sc, sr = canon(s)
    dc, dr = canon(d)
    ok = sc == dc and sr == dr
    info = dict(name=name, ok=ok, rows=len(s), oracle_rows=len(d), spark_sec=round(ts, 2))
    if not ok:
        info["cols"] = (sc, dc) if sc != dc else None
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
        info["first_diff"] = diff
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    sys.path.insert(0, ".")
    from tidecast.session import get_spark
    from tidecast.plans.registry import all_queries
    import os
    conf = {"spark.sql.shuffle.partitions": "8"}
    if os.environ.get("SPARK_TZ"):
        conf["spark.sql.session.timeZone"] = os.environ["SPARK_TZ"]
    spark = get_spark("oracle-check", conf, master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    reg = all_queries()
    bad = 0
    for name, (fn, sql) in reg.items():
        if names and name not in names:
            continue
        try:
            info = compare(spark, name, fn, sql, sf_dir, con)
        except Exception as e:  # report and go on
            info = dict(name=name, ok=False, error=f"{type(e).__name__}: {str(e)[:400]}")
        bad += info.get("ok") is False
        print(info, flush=True)
    print(f"{len(reg)} registered, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
