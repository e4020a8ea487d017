"""Compare a registered query with its DuckDB text on one table folder."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if glob.glob(path):
            con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if v is None:
        return "null"
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_cols = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    types = {d[0]: str(d[1]) for d in cur.description}
    a, b = _rows(got_cols, got), _rows(want_cols, want)
    if a == b:
        return None
    diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
    cols = sorted(got_cols)
    detail = []
    for x, y in diff:
        detail.append({c: (i, j) for c, i, j in zip(cols, x, y) if i != j})
    return f"rows {len(a)} vs {len(b)}; types {types}; {detail}"


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .appName("cartwake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CARTWAKE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    import sys
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:]
    spark, con = session(), connect(sf)
    sqls = E.oracle_sql()
    for name, fn in E.queries().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in sqls:
                bad = compare(df, con, sqls[name])
            else:
                bad = f"(no sql) rows {df.count()}"
            print(f"{'ok  ' if bad is None else 'DIFF'} {name} {time.time() - t:.2f}s {'' if bad is None else bad[:1500]}", flush=True)
        except Exception as e:
            print(f"FAIL {name} {type(e).__name__} {str(e)[:1200]}", flush=True)
