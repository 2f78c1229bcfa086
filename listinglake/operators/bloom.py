"""Bloom filters as small tables of bitmaps, built and asked by Spark expressions.

A key's hash names one block of ``BLOCK_BITS`` bits and ``PROBES`` bits inside it. So a filter is
(block, bits) rows, which grow with a group-by, merge with an OR and are asked by an equi-join on
the block. A filter never rules out a key it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglake.operators.skew import BROADCAST_BYTES, hot_keys, measured_bytes, spread_join

#: Bits of a filter per key and bits that each key sets: about 2 false alarms in 100.
BITS, PROBES = 10, 4
#: Bits of one block: what ``bitmap_construct_agg`` builds.
BLOCK_BITS = 32768
#: Blocks of a filter that is broadcast, 8 MiB, whatever the number of its keys.
MOST_BLOCKS = 2048


def blocks_for(keys: int) -> int:
    """Blocks for that many keys, a power of two."""
    blocks = 1
    while blocks * BLOCK_BITS < keys * BITS:
        blocks *= 2
    return blocks


def block_of(hashed: Column, blocks: int) -> Column:
    return F.pmod(hashed, F.lit(blocks)).cast("bigint")


def _places(hashed: Column) -> list[Column]:
    """The bits of a key inside its block."""
    return [
        F.pmod(F.xxhash64(F.lit(probe), hashed), F.lit(BLOCK_BITS)).cast("bigint") for probe in range(PROBES)
    ]


def filter_of(keys: DataFrame, blocks: int, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, block, bits) of rows with a ``hash``; one filter for each value of ``by``."""
    placed = keys.select(
        *by, block_of(F.col("hash"), blocks).alias("block"), F.explode(F.array(*_places(F.col("hash")))).alias("place")
    )
    return placed.distinct().groupBy(*by, "block").agg(F.bitmap_construct_agg("place").alias("bits"))


def either(one: DataFrame, other: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The filter of all keys of two filters of the same number of blocks."""
    return one.unionByName(other).groupBy(*by, "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def held(bits: Column, hashed: Column) -> Column:
    """Whether a block has all bits of a key; false without a block."""
    every = F.lit(True)
    for place in _places(hashed):
        byte = F.conv(F.hex(F.substr(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10)
        every = every & (F.getbit(byte.cast("bigint"), (place % 8).cast("int")) == 1)
    return F.coalesce(every, F.lit(False))


def marked(frame: DataFrame, keys: DataFrame, on: list[str], most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """``frame`` with ``_maybe``: false only for rows whose key is not among ``keys``.

    A shuffle or a join spared for most rows of a large ``frame``. The filter is bounded: with
    more keys than it can tell apart it rules out less, and nothing else changes.
    """
    hashed = F.xxhash64(*[F.col(name) for name in on])
    blocks = min(blocks_for(keys.count()), most_blocks)
    bits = filter_of(keys.select(hashed.alias("hash")), blocks).toDF("_block", "_bits")
    asked = frame.withColumn("_block", block_of(hashed, blocks)).join(F.broadcast(bits), "_block", "left")
    return asked.withColumn("_maybe", held(F.col("_bits"), hashed)).drop("_block", "_bits")


def semi_join(frame: DataFrame, keys: DataFrame, on: list[str], small: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``frame`` whose key is among the stored ``keys``.

    Keys of at most ``small`` measured bytes are broadcast. Beyond that the rows a bounded
    filter cannot rule out move, and no others.
    """
    if measured_bytes(keys) <= small:
        return frame.join(F.broadcast(keys), on, "left_semi")
    likely = marked(frame, keys, on).where("_maybe").drop("_maybe")
    return spread_join(likely, keys, on, "left_semi", hot_keys(frame, on))


def anti_join(frame: DataFrame, keys: DataFrame, on: list[str], small: int = BROADCAST_BYTES) -> DataFrame:
    """Rows of ``frame`` whose key is not among the stored ``keys``; see :func:`semi_join`."""
    if measured_bytes(keys) <= small:
        return frame.join(F.broadcast(keys), on, "left_anti")
    likely = marked(frame, keys, on)
    rest = spread_join(likely.where("_maybe"), keys, on, "left_anti", hot_keys(frame, on))
    return likely.where("NOT _maybe").unionByName(rest).drop("_maybe")
