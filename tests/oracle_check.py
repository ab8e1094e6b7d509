"""Compare registered queries with their SQL: ``python tests/oracle_check.py SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf: str, name: str, fn, sql: str | None) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if got else "no rows"
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = table(df.columns, got), table(names, want)
    if a == b:
        return None
    only = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    return f"rows {len(a)} / {len(b)}; only spark {only[0]}; only sql {only[1]}"


def main() -> int:
    from pyspark.sql import SparkSession

    from linkloom.workload.oracle import all_sql
    from linkloom.workload.queries import all_queries

    sf, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf), all_sql(), 0
    for name, fn in all_queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            diff = compare(spark, con, sf, name, fn, sql.get(name))
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:700]}"
        kind = "exact" if name in sql else "rows"
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} [{kind}] {time.time() - t:.2f}s {diff or ''}", flush=True)
        bad += diff is not None
    return bad


if __name__ == "__main__":
    sys.exit(main())
