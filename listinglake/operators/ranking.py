"""One row per key, chosen by a total order.

Each step is a ``row_number() = 1`` window. Spark puts a group limit below the
shuffle, so a map task sends at most one row of a key, however often it occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(frame: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each ``keys`` group; null keys form a group."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return frame.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_per_key(
    frame: DataFrame, keys: list[str], by: str, ties: list[str] | None = None
) -> DataFrame:
    """Newest row per key, nulls last; equal dates fall back to ``ties``.

    Without ``ties`` all other columns break them, so the same rows always give the
    same survivor, in whatever order they arrive.
    """
    rest = ties if ties is not None else [c for c in frame.columns if c not in (*keys, by)]
    order = [F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]]
    return first_per_key(frame, keys, order)


def latest_on_two_keys(
    frame: DataFrame, key: str, pair: list[str], by: str, ties: list[str] | None = None
) -> DataFrame:
    """Newest per ``key``; among those winners, newest per ``pair``, then lowest key.

    A row beaten on ``key`` takes no part in the second step.
    """
    winners = latest_per_key(frame, [key], by, ties)
    return latest_per_key(winners, pair, by, [key])
