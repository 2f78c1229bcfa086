"""Compare registered queries with their SQL in DuckDB: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(tables: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{tables}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows_of(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def difference(spark, connection, name: str, tables: str) -> str | None:
    """None when query and SQL agree in columns and rows, else what differs."""
    from listinglake.plans.catalog import ORACLES, QUERIES

    frame = QUERIES[name](spark, tables)
    got = rows_of(frame.columns, frame.collect())
    if name not in ORACLES:
        return None
    answer = connection.execute(ORACLES[name])
    columns = [c[0] for c in answer.description]
    wanted = rows_of(columns, answer.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} <> {sorted(columns)}"
    if got != wanted:
        only = [r for r in got if r not in set(wanted)][:2], [r for r in wanted if r not in set(got)][:2]
        return f"{len(got)} rows <> {len(wanted)} rows; only in Spark {only[0]}; only in SQL {only[1]}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    from listinglake.plans.catalog import QUERIES

    tables = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.001'}"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(tables)
    failed = 0
    for name in names:
        start = time.time()
        try:
            found = difference(spark, connection, name, tables)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{name:22s} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
