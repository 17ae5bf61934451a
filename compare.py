"""Run registered queries against their SQL twins in DuckDB: ``python compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession


def session(cpus: str = "8") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("heliospark")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{directory}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, decimal.Decimal):
            v = float(v)
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        if isinstance(v, dt.datetime):
            return v.isoformat()
        if isinstance(v, list):
            return str([cell(e) for e in v])
        return repr(v)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, con, entry, directory: str) -> tuple[str, float, int]:
    start = time.perf_counter()
    df = entry.run(spark, directory)
    got = df.collect()
    seconds = time.perf_counter() - start
    if entry.sql is None:
        return "rows only", seconds, len(got)
    cursor = con.execute(entry.sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"COLUMNS spark-only={set(df.columns) - set(names)} sql-only={set(names) - set(df.columns)}", seconds, len(got)
    if len(got) != len(want):
        return f"ROWS {len(got)} != {len(want)}", seconds, len(got)
    a, b = canonical(df.columns, got), canonical(names, want)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"VALUES {len(wrong)} differ {sorted(df.columns)}\n   spark {wrong[0][0]}\n   sql   {wrong[0][1]}", seconds, len(got)
    return "ok", seconds, len(got)


def main() -> None:
    from catalog import REGISTRY
    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(REGISTRY)
    spark, con = session(), oracle(directory)
    bad = 0
    for name in chosen:
        try:
            verdict, seconds, rows = compare(spark, con, REGISTRY[name], directory)
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict, seconds, rows = f"ERROR {type(error).__name__}: {str(error)[:900]}", 0.0, 0
        bad += verdict not in ("ok", "rows only")
        sys.stdout.write("\r"); print(f"{name:34s} {seconds:6.2f}s {rows:7d} rows  {verdict}", flush=True)
    print(f"{len(chosen) - bad}/{len(chosen)} fine")
    spark.stop()


if __name__ == "__main__":
    main()
