"""Distinct members as bitmaps over dense keys: exact, merged by OR, never counted again.

A set of keys 1..n is a table (bucket, bits) of bitmaps of 32,768 keys each. Every task sets the
bits of its rows before the shuffle, so rows are neither expanded nor moved. Sets of captures
are kept and merged; counting a merged set reads bitmaps and no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def member_set(frame: DataFrame, key: str) -> DataFrame:
    """(bucket, bits) of the distinct non-null values of the dense key ``key``."""
    place = F.col(key).cast("bigint")
    return (
        frame.where(place.isNotNull())
        .groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    )


def merged(sets: list[DataFrame]) -> DataFrame:
    """The union of sets over the same keys."""
    every = reduce(DataFrame.unionByName, sets)
    return every.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def common(one: DataFrame, other: DataFrame) -> DataFrame:
    """The members that two sets share."""
    both = one.join(other.toDF("bucket", "_bits"), "bucket")
    pair = F.explode(F.array("bits", "_bits")).alias("bits")
    return both.select("bucket", pair).groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"))


def size(members: DataFrame) -> DataFrame:
    """One row: how many members a set has."""
    return members.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias("members"))


def figures(fact: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row: ``vacancies``, and under each name the distinct members of its dense key.

    Each key is one narrow scan with bitmaps made before the shuffle; no row is expanded.
    """
    rows = fact.agg(F.count(F.lit(1)).alias("vacancies"))
    for name, key in columns.items():
        # One row on both sides.
        rows = rows.join(size(member_set(fact, key)).withColumnRenamed("members", name))
    return rows
