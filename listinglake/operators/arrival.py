"""Greedy first-arrival dedupe on two keys, exact and distributed.

Rows are taken in arrival order; a row stays unless its id or its pair already
belongs to a row that stayed. Dropped rows block nothing, so two plain
``dropDuplicates`` would give another answer.

The rows are edges between ids and pairs. Copies of one edge can never beat their
first arrival, so they collapse first. Then, in rounds: an edge that is the earliest
of its id *and* of its pair stays for sure; every other edge at these ids and pairs
goes. What is left is a smaller problem of the same kind. Both minima are map-side
aggregates and the winners are matched on the unique arrival, so a hot id or pair
does not reach one task; the two anti-joins salt hot keys.

Usual data is settled in a few rounds, however large. A long chain of conflicts in arrival
order gives a round only its first link, so after a round that settles less than
``PROGRESS`` of what is open, the ``slice_rows`` earliest open edges are settled in arrival
order inside one task. A slice is bounded by the parameter and exact, as no edge outside it
arrives earlier. It names ids and pairs by the first arrival that Spark's own equality groups
under them, so it agrees with the rounds for keys of any type. What is open, large or small,
never picks the method; only progress does.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listinglake.operators.skew import HOT_ROWS, hot_keys, spread_join
from listinglake.session import remove, scratch_path

# A round that settles a smaller share of the open edges is followed by a slice.
PROGRESS = 0.01
SLICE_ROWS = 100_000


def first_arrivals(
    frame: DataFrame,
    key: Column,
    pair: list[Column],
    arrival: Column,
    progress: float = PROGRESS,
    slice_rows: int = SLICE_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows of ``frame`` that stay; ``arrival`` is unique and orders the rows.

    Two null keys are equal, as are two pairs that agree in their nulls. A number as
    ``arrival`` lets Spark aggregate by hash; see :func:`two_part_arrival`.
    """
    named = frame.withColumn("_arrival", arrival)
    edges = (
        named.select(F.struct(key).alias("_id"), F.struct(*pair).alias("_pair"), "_arrival")
        .groupBy("_id", "_pair")
        .agg(F.min("_arrival").alias("_arrival"))
    )
    kept = _settle(edges, progress, slice_rows, hot_rows).select("_arrival")
    return named.join(kept, "_arrival", "left_semi").drop("_arrival")


def two_part_arrival(major: str, minor: str) -> Column:
    """Bigint ``major`` and int ``minor`` as one number in the same order."""
    return F.col(major).cast("decimal(20,0)") * F.lit(1 << 32) + F.col(minor).cast("bigint")


def _settle(
    edges: DataFrame, progress: float, slice_rows: int, hot_rows: int
) -> DataFrame:
    """The edges that stay, stored by all rounds together."""
    spark = edges.sparkSession
    root = scratch_path(spark, "first-arrivals")
    kept: list[str] = []

    def save(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{root}/{name}")
        return spark.read.schema(edges.schema).parquet(f"{root}/{name}")

    def keep(rows: DataFrame) -> DataFrame:
        name = f"kept-{len(kept)}"
        kept.append(f"{root}/{name}")
        return save(rows, name)

    rest, number = save(edges, "open-0"), 0
    size = rest.count()  # from the file footers
    # Groups only shrink, so what is not hot now never becomes larger.
    hot = {side: hot_keys(rest, [side], size, rows=hot_rows) for side in ("_id", "_pair")}
    slow = False
    while size:
        stays = keep(_slice_winners(rest, slice_rows) if slow else _local_winners(rest))
        following = save(_without(rest, stays, hot), f"open-{number + 1}")
        remove(spark, f"{root}/open-{number}")
        left = following.count()
        slow = slice_rows > 0 and size - left < progress * size
        rest, number, size = following, number + 1, left
    remove(spark, f"{root}/open-{number}")
    if not kept:
        return edges.limit(0)
    return spark.read.schema(edges.schema).parquet(*kept)


def _local_winners(edges: DataFrame) -> DataFrame:
    """Edges that are the earliest at both ends."""
    by_id = edges.groupBy("_id").agg(F.min("_arrival").alias("_arrival"))
    by_pair = edges.groupBy("_pair").agg(F.min("_arrival").alias("_arrival"))
    return by_id.join(by_pair, "_arrival").select("_id", "_pair", "_arrival")


def _without(
    edges: DataFrame, stays: DataFrame, hot: dict[str, DataFrame | None]
) -> DataFrame:
    """Edges that touch no id and no pair of ``stays``."""
    for side in ("_id", "_pair"):
        edges = spread_join(edges, stays.select(side), [side], "left_anti", hot[side], ["_arrival"])
    return edges.select("_id", "_pair", "_arrival")


def _slice_winners(edges: DataFrame, rows: int) -> DataFrame:
    """Settle the ``rows`` earliest edges one after the other, in one bounded task."""

    def named(side: str) -> Column:
        return F.min("_arrival").over(Window.partitionBy(side)).cast("string")

    earliest = (
        edges.orderBy("_arrival")
        .limit(rows)
        .withColumns({"_left": named("_id"), "_right": named("_pair")})
        .coalesce(1)
        .sortWithinPartitions("_arrival")
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lefts: set[str] = set()
        rights: set[str] = set()
        for batch in batches:
            stays = []
            ends = zip(batch.column("_left").to_pylist(), batch.column("_right").to_pylist())
            for left, right in ends:
                free = left not in lefts and right not in rights
                if free:
                    lefts.add(left)
                    rights.add(right)
                stays.append(free)
            yield batch.filter(pa.array(stays, pa.bool_()))

    return earliest.mapInArrow(walk, earliest.schema).select("_id", "_pair", "_arrival")
