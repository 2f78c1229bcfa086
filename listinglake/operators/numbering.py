"""Dense 1..n keys in name order without a one-task window."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listinglake.operators.skew import hot_from_counts
from listinglake.session import store

_SLOT_BITS = 33  # monotonically_increasing_id: partition << 33 | row


@dataclass(frozen=True)
class Numbered:
    """``frame`` (key, name) and how often each name occurs in the rows behind it."""

    frame: DataFrame
    counts: DataFrame

    def hot(self, **limits) -> DataFrame | None:
        """The names a join of those rows has to salt; None when there are none."""
        total = self.counts.agg(F.sum("_rows")).first()[0] or 0
        return hot_from_counts(self.counts, total, **limits)


def dense_keys(frame: DataFrame, name: str, key: str, key_type: str = "int") -> Numbered:
    """Number the distinct values of ``name`` from 1 in their order.

    Pass 1 counts rows per name (map-side, so a hot name costs one row per task),
    range-partitions the names and stores each with its place inside its partition.
    Pass 2 adds the row counts of the partitions before. The stored table fixes the
    sampled range bounds, so a lost executor cannot shift a number. ``key_type`` may
    be ``bigint``; an ``int`` that overflows fails the job.
    """
    placed = (
        frame.groupBy(name)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .repartitionByRange(F.col(name))
        .sortWithinPartitions(name)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    names = store(placed, "dense-keys").select(
        name,
        "_rows",
        F.shiftright("_slot", _SLOT_BITS).alias("_part"),
        F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1)).alias("_place"),
    )
    # One row per range partition: bounded by the shuffle partitions, not by the names.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        names.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    numbered = names.join(F.broadcast(starts), "_part").select(
        (F.col("_start") + F.col("_place") + 1).cast(key_type).alias(key), name
    )
    return Numbered(numbered, names.select(F.xxhash64(name).alias("_hot"), "_rows"))


def positions(frame: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``frame`` with each row's place, from 1, in a total ``order``; stored.

    Rows are range-partitioned by the order, numbered inside their partition and shifted by the
    sizes of those before, so no task sees all rows.
    """
    placed = store(
        frame.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "positions",
    )
    part = F.shiftright("_slot", _SLOT_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    place = F.col("_start") + F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1)) + 1
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, place.cast("bigint"))
        .drop("_part", "_slot", "_start")
    )
