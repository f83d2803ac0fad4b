"""Run a registered query and its SQL on the same Parquet files and compare all rows."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _sorted(rows):
    return sorted((tuple(_norm(v) for v in row) for row in rows), key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t))


def compare(spark, con, name, query, sql, sf_dir):
    """Returns (problem or None, spark seconds, row count)."""
    start = time.time()
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    rows = [tuple(row) for row in df.select(*[f"`{c}`" for c in names]).collect()]
    spent = time.time() - start
    if sql is None:
        return (None if rows else "no rows"), spent, len(rows)
    result = con.execute(sql)
    got = [d[0] for d in result.description]
    raw = result.fetchall()
    if sorted(got) != names:
        return f"columns {names} != {sorted(got)}", spent, len(rows)
    order = [got.index(c) for c in names]
    want = [tuple(row[i] for i in order) for row in raw]
    if len(rows) != len(want):
        return f"rows {len(rows)} != {len(want)}", spent, len(rows)
    types = {c: ({type(a[i]) for a in rows if a[i] is not None}, {type(b[i]) for b in want if b[i] is not None}) for i, c in enumerate(names)}
    for c, (a, b) in types.items():
        if a != b:
            return f"types of {c}: {a} != {b}", spent, len(rows)
    a, b = _sorted(rows), _sorted(want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, columns {names}, first {bad[0]}", spent, len(rows)
    return None, spent, len(rows)


if __name__ == "__main__":
    import os
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
    only = sys.argv[1:]
    builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    spark = (
        builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", os.environ.get("TEST_TZ", "UTC")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if only and not any(o in name for o in only):
            continue
        try:
            problem, spent, n = compare(spark, con, name, query, oracle.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            problem, spent, n = f"{type(error).__name__}: {str(error)[:1500]}", 0, 0
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {spent:6.2f}s {n:7d} rows {'' if name in oracle else '(rows only)'} {problem or ''}", flush=True)
    print("failed:", failed)
