"""Run registered queries on Spark and DuckDB and compare rows, columns and values."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, bool):
        return f"bool:{v}"
    if isinstance(v, int):
        return f"int:{v}"
    if isinstance(v, float):
        return f"float:{v + 0.0!r}"
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return f"{type(v).__name__}:{v}"


def rows_of(columns, records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in records)


def compare(spark: SparkSession, con, build, sql: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    result = build(spark, sf_dir)
    spark_rows = rows_of(result.columns, result.collect())
    answer = con.execute(sql)
    columns = [d[0] for d in answer.description]
    duck_rows = rows_of(columns, answer.fetchall())
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(set(columns) ^ set(result.columns))}"
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} vs {len(duck_rows)}"
    names = sorted(columns)
    for a, b in zip(spark_rows, duck_rows):
        if a != b:
            return str([(n, x, y) for n, x, y in zip(names, a, b) if x != y][:4])
    return None


if __name__ == "__main__":
    import __spark_entry__ as contract

    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    oracle = contract.oracle_sql()
    queries = contract.queries()
    print("without oracle:", sorted(queries.keys() - oracle.keys()))
    bad = 0
    for name, build in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(session, duck(sf_dir), build, oracle[name], sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("failures:", bad)
