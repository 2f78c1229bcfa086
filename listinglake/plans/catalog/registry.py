"""Queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query function under ``name``, with its SQL when there is one."""

    def register(build):
        def run(spark: SparkSession, tables: str) -> DataFrame:
            return build(configure(spark), tables)

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, tables: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{tables}/{name}.parquet")


def day(name: str):
    """Date column as ISO text, the same in every engine's result."""
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def second(name: str):
    """Timestamp column as text to the second."""
    return F.date_format(F.col(name).cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias(name)


def money(name: str):
    """Price as text with two decimals."""
    return F.col(name).cast("decimal(18,2)").cast("string")
