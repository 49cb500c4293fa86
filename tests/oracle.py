"""Compare registered queries with their SQL: ``python -m tests.oracle [sf_dir] [query ...]``."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.replace(tzinfo=None)
    return value


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(found, key=repr)


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> tuple[int, float, str]:
    """``(rows, seconds, problem)``; the problem is empty when the results are equal."""
    start = time.time()
    df = contract.queries()[name](spark, sf_dir)
    rows = df.collect()
    seconds = time.time() - start
    if name not in contract.oracle_sql():
        return len(rows), seconds, "" if rows else "no rows"
    result = connection.execute(contract.oracle_sql()[name])
    want_columns, want = normal([c[0] for c in result.description], result.fetchall())
    have_columns, have = normal(df.columns, rows)
    if want_columns != have_columns:
        return len(rows), seconds, f"columns {have_columns} want {want_columns}"
    if len(want) != len(have):
        return len(rows), seconds, f"{len(have)} rows, want {len(want)}"
    different = [(h, w) for h, w in zip(have, want) if h != w]
    if different:
        return len(rows), seconds, f"{len(different)} rows differ, first {different[0]}"
    return len(rows), seconds, ""


def main() -> None:
    from gridlake.session import local_session

    arguments = sys.argv[1:]
    sf_dir = arguments.pop(0) if arguments and os.path.isdir(arguments[0]) else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(sf_dir)
    bad = 0
    for name in arguments or contract.queries():
        try:
            count, seconds, problem = compare(spark, connection, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - every query is reported
            count, seconds, problem = -1, 0.0, f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "sql " if name in contract.oracle_sql() else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name:28s} {count:8d} rows {seconds:6.2f}s {problem}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
