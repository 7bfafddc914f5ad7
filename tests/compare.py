"""Run the registered queries next to their SQL and compare whole results.

    python -m tests.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as contract


def local_session(cores: int = 8, **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, connection, folder, name):
    started = time.time()
    df = contract.queries()[name](spark, folder)
    rows = df.collect()
    took = time.time() - started
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None, f"{len(rows)} rows, no SQL", took
    cursor = connection.execute(sql)
    expected_names, expected = normal_rows([c[0] for c in cursor.description], cursor.fetchall())
    names, actual = normal_rows(df.columns, rows)
    if names != expected_names:
        return False, f"columns {names} instead of {expected_names}", took
    if len(actual) != len(expected):
        return False, f"{len(actual)} rows instead of {len(expected)}", took
    for got, wanted in zip(actual, expected):
        if got != wanted:
            for column, a, b in zip(names, got, wanted):
                if a != b:
                    return False, f"{column}: {str(a)[:300]!r} instead of {str(b)[:300]!r}", took
    return True, f"{len(actual)} rows", took


def main(folder: str, *wanted: str) -> None:
    spark = local_session()
    connection = connect(folder)
    for name in wanted or contract.queries():
        try:
            good, note, took = compare(spark, connection, folder, name)
        except Exception as error:
            good, note, took = False, f"{type(error).__name__}: {str(error)[:600]}", 0.0
        verdict = {True: "same", False: "DIFFERENT", None: "unchecked"}[good]
        print(f"{name:28} {verdict:10} {took:6.2f}s  {note}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
