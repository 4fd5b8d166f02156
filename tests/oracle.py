"""Compare registered queries with their SQL twins, row for row.

    python -m tests.oracle [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import os
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '8')}]")
        .appName("tidemill-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("TEST_ZONE", "UTC"))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", "/tmp/tidemill-warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    return rows_of([d[0] for d in cursor.description], cursor.fetchall())


def differences(got, want, show=3):
    if got[0] != want[0]:
        return [f"columns {got[0]} against {want[0]}"]
    out = []
    if got[1] != want[1]:
        out.append(f"{sum(got[1].values())} rows against {sum(want[1].values())}")
        out += [f"only in Spark {r}" for r in list((got[1] - want[1]).elements())[:show]]
        out += [f"only in SQL   {r}" for r in list((want[1] - got[1]).elements())[:show]]
    return out


def type_differences(df, con, sql):
    """Type families that differ (integer, floating, text, time)."""
    family = {
        "bigint": "int", "int": "int", "smallint": "int", "integer": "int", "hugeint": "int", "tinyint": "int",
        "double": "real", "float": "real", "string": "text", "varchar": "text",
        "timestamp_ntz": "time", "timestamp": "time", "date": "date", "boolean": "bool",
    }
    cursor = con.execute(f"DESCRIBE {sql}")
    want = {r[0]: r[1].lower() for r in cursor.fetchall()}
    out = []
    for name, kind in df.dtypes:
        other = want.get(name, "")
        if family.get(kind, kind) != family.get(other, other) or other == "hugeint" or kind == "timestamp":
            out.append(f"type of {name}: {kind} against {other}")
    return out


def main():
    from __spark_entry__ import oracle_sql, queries

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = session(), database(args.sf)
    bad = 0
    for name, run in queries().items():
        if args.names and not any(n in name for n in args.names):
            continue
        sql = oracle_sql().get(name)
        begin = time.time()
        try:
            df = run(spark, args.sf)
            got = spark_rows(df)
            took = time.time() - begin
            problems = [] if sql is None else differences(got, sql_rows(con, sql)) + type_differences(df, con, sql)
        except Exception as error:  # report and go on with the next query
            problems, took, got = [f"{type(error).__name__}: {str(error)[:1500]}"], time.time() - begin, ([], Counter())
        bad += bool(problems)
        state = "FAIL" if problems else ("ok" if sql else "rows")
        print(f"{state:5} {took:6.2f}s {sum(got[1].values()):7} {name}", flush=True)
        for problem in problems:
            print("      ", problem)
    print("failed:", bad)


if __name__ == "__main__":
    main()
