"""First-arrival dedupe over captures that come one after the other.

One greedy pass over all captures keeps a row unless its id or its pair belongs to a kept one.
Captures arrive in order, so it can stop after each: what later rows need to know are the kept
ids and pairs, not the listings. They are stored below a root, with a Bloom filter in front:

* ``kept/rows``: the rows kept, a part per capture;
* ``kept/ids`` and ``kept/pairs``: their keys, in parts by hash and capture;
* ``kept/filter``: (side, block, bits), see :mod:`listinglake.operators.bloom`.

The rows of a new capture ask one block each of the filter. Those it cannot rule out, its false
alarms among them, are held against the stored keys of the parts they fall into; these answers
are exact. Whatever is not blocked goes through :func:`first_arrivals`, and what stays is
admitted. Keys, filter and rows become live by one pointer, so a capture counts whole or not at
all, and the same capture again changes nothing.

The filter's blocks double when the keys outgrow them; it is then built anew from the stored
keys, which are hashes' worth of data and not listings. Parts of keys that have gathered
``LAYERS`` layers are written together.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake import publication
from listinglake.operators import bloom
from listinglake.operators.arrival import first_arrivals
from listinglake.operators.skew import HOT_ROWS, lookup_join
from listinglake.session import configure, store

ROWS, IDS, KEY_PAIRS, FILTER = "kept/rows", "kept/ids", "kept/pairs", "kept/filter"
_SIDES = {"id": IDS, "pair": KEY_PAIRS}
BUCKETS = 32
LAYERS = 8


@dataclass(frozen=True)
class Admitted:
    """Rows of a capture, those the filter could not rule out, those blocked, those kept."""

    version: int
    rows: int
    asked: int
    blocked: int
    kept: int
    key_rows_read: int


def _bucket(buckets: int) -> Column:
    return F.pmod(F.col("hash"), F.lit(buckets)).cast("int")


def admit(
    spark: SparkSession,
    root: str,
    capture: DataFrame,
    label: str,
    key: Column,
    pair: list[Column],
    arrival: Column,
    buckets: int = BUCKETS,
    hot_rows: int = HOT_ROWS,
) -> Admitted:
    """Keep the rows of ``capture`` that no kept row and no earlier one of its own excludes.

    ``arrival`` orders the rows of one capture and is unique in it; ``label`` names the capture.
    Two null keys are equal, as are two pairs that agree in their nulls.
    """
    configure(spark)
    root = root.rstrip("/")
    live = publication.live(spark, root)
    version = live.version if live else 0
    tables = dict(live.tables) if live else {}
    done = tables.get(ROWS)
    if done and label in done.parts:
        return Admitted(version, 0, 0, 0, done.parts[label].rows, 0)
    if done:
        buckets = tables[IDS].notes["buckets"]

    named = store(
        capture.select(
            F.struct("*").alias("row"), arrival.alias("arrival"), F.struct(key).alias("id"), F.struct(*pair).alias("pair")
        ),
        "admission-rows",
    )
    total = named.count()
    read = asked = 0
    blocked = None
    if done:
        hits = []
        for side, name in _SIDES.items():
            own = named.select("arrival", F.col(side).alias("key"), F.xxhash64(side).alias("hash"))
            suspects = _suspects(spark, live, own, side)
            asked += suspects.count()
            wanted = {str(row[0]) for row in suspects.select(_bucket(buckets)).distinct().collect()}
            parts = [part for part in tables[name].parts if part.split("/")[0] in wanted]
            read += tables[name].rows_in(parts)
            known = tables[name].read(spark, root, parts).select("key")
            hits.append(_known(suspects, known, hot_rows))
        blocked = store(hits[0].union(hits[1]).distinct(), "admission-blocked")
        free = lookup_join(named, blocked, "arrival", "left_anti")
    else:
        free = named
    stays = store(
        first_arrivals(free, F.col("id"), [F.col("pair")], F.col("arrival"), hot_rows=hot_rows), "admission-kept"
    )

    keys = {
        side: stays.select(F.col(side).alias("key"), F.xxhash64(side).alias("hash")) for side in _SIDES
    }
    fresh = publication.stage(stays.select("row.*"), root, ROWS)
    rows = replace(fresh, parts={label: fresh.parts[""]})
    tables[ROWS] = done.with_parts(rows) if done else rows
    for side, name in _SIDES.items():
        tables[name] = _grown(spark, root, tables.get(name), name, keys[side], version + 1, buckets)
    tables[FILTER] = _filter(spark, root, tables, keys)
    published = publication.publish(spark, root, tables.values(), expected=version)
    return Admitted(
        published.version, total, asked, blocked.count() if blocked is not None else 0, fresh.rows, read
    )


def _suspects(spark: SparkSession, live: publication.Live, own: DataFrame, side: str) -> DataFrame:
    """Rows whose key the filter cannot rule out; stored."""
    blocks = live.tables[FILTER].notes["blocks"]
    bits = live.read(spark, FILTER).where(F.col("side") == side).select("block", "bits")
    asking = own.withColumn("block", bloom.block_of(F.col("hash"), blocks))
    met = lookup_join(asking, bits, "block", "inner")
    return store(met.where(bloom.held(F.col("bits"), F.col("hash"))).select("arrival", "key", "hash"), "admission-asked")


def _known(suspects: DataFrame, known: DataFrame, hot_rows: int) -> DataFrame:
    """``arrival`` of the suspects whose key is among the ``known`` ones, which are unique."""
    return lookup_join(suspects, known, "key", "left_semi", hot_rows=hot_rows).select("arrival")


def _grown(
    spark: SparkSession,
    root: str,
    table: publication.Table | None,
    name: str,
    keys: DataFrame,
    version: int,
    buckets: int,
) -> publication.Table:
    """The table of keys with a layer of new ones; full buckets become one layer."""
    notes = {"buckets": buckets}
    placed = keys.withColumn("bucket", _bucket(buckets))
    newer = publication.stage_parts(placed, root, name, "bucket", suffix=f"/{version}", notes=notes)
    if table is None:
        return newer
    grown = table.with_parts(newer)
    layers: dict[str, list[str]] = {}
    for part in grown.parts:
        layers.setdefault(part.split("/")[0], []).append(part)
    full = [part for parts in layers.values() if len(parts) >= LAYERS for part in parts]
    if not full:
        return grown
    together = grown.read(spark, root, full).withColumn("bucket", _bucket(buckets))
    packed = publication.stage_parts(together, root, name, "bucket", suffix=f"/{version}", notes=notes)
    return grown.with_parts(packed, gone=full)


def _filter(
    spark: SparkSession, root: str, tables: dict[str, publication.Table], keys: dict[str, DataFrame]
) -> publication.Table:
    """The filter with the new keys; of all stored keys again when its blocks are too few."""

    def hashes(frames: dict[str, DataFrame]) -> DataFrame:
        each = [frame.select(F.lit(side).alias("side"), "hash") for side, frame in frames.items()]
        return each[0].union(each[1])

    blocks = bloom.blocks_for(max(tables[name].rows for name in _SIDES.values()))
    old = tables.get(FILTER)
    if old and old.notes["blocks"] >= blocks:
        blocks = old.notes["blocks"]
        fresh = bloom.filter_of(hashes(keys), blocks, ("side",))
        bits = bloom.either(old.read(spark, root), fresh, ("side",))
    else:
        stored = {side: tables[name].read(spark, root) for side, name in _SIDES.items()}
        bits = bloom.filter_of(hashes(stored), blocks, ("side",))
    return publication.stage(bits, root, FILTER, {"blocks": blocks})


def kept(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows kept of all captures so far; None before the first."""
    live = publication.live(spark, root)
    return live.read(spark, ROWS) if live else None
