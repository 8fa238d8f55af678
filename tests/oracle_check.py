"""Compare every registered query with its DuckDB oracle.

Usable from pytest (``compare``) and as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9) + 0.0  # -0.0 -> 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def compare(spark, con, key: str, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    rel = con.sql(sql)
    o_cols = list(rel.columns)
    o_rows = [tuple(_norm(v) for v in r) for r in rel.fetchall()]
    if sorted(s_cols) != sorted(o_cols):
        return False, f"columns differ: spark={s_cols} oracle={o_cols}"
    order = [o_cols.index(c) for c in s_cols]
    o_rows = [tuple(r[i] for i in order) for r in o_rows]
    if len(s_rows) != len(o_rows):
        return False, f"row count spark={len(s_rows)} oracle={len(o_rows)}"
    s_sorted = sorted(s_rows, key=_sort_key)
    o_sorted = sorted(o_rows, key=_sort_key)
    bad = [(a, b) for a, b in zip(s_sorted, o_sorted) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, first: spark={bad[0][0]} oracle={bad[0][1]}"
    return True, f"{len(s_rows)} rows"


def main(argv: list[str]) -> int:
    import time

    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("ORACLE_SPARK_TZ", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb_connection(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for key in keys or list(qs):
        t0 = time.time()
        try:
            ok, msg = compare(spark, con, key, qs[key], sqls[key], sf_dir)
        except Exception as exc:  # report and go on
            ok, msg = False, f"error: {exc!r}"[:800]
        failed += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {key:32s} {time.time() - t0:6.2f}s {msg}", flush=True)
    print(f"{len(keys or qs) - failed} ok, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
