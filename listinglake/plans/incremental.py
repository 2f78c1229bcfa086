"""Silver kept up to date capture by capture.

The rules are those of the full rebuild: newest row per id over all captures, then newest of
these winners per title and company. A winner that loses its pair can come back when the row
that beat it moves to another title, so all winners are kept, each with its verdict:

* ``silver/winners``: the winning row of every id and whether it is listed, in parts by id;
* ``silver/pairs``: (title, company_name, publication_date, id, listed) of every winner, in
  parts by pair.

A capture is first ranked by itself. Only parts that hold its ids are read, and of those rows
only the ids it names are ranked again; where the winner changes, the pairs it leaves and enters
are decided anew from the parts that hold them. Only parts with a changed row are written. All
other parts are kept by name, and both tables become live by one pointer. A capture that changes
nothing publishes nothing.

The number of parts is fixed when the first capture is merged; :func:`deal_anew` changes it.
Lists of touched parts are the only thing the driver collects: at most ``buckets`` numbers. Joins
broadcast ids up to ``SMALL`` measured bytes; beyond that both sides shuffle by id, of which each
side has a row at most, so what passes through the driver does not grow with the tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake import publication, schemas
from listinglake.constants import TITLE_KEYWORDS
from listinglake.operators import silver
from listinglake.operators.ranking import first_per_key, latest_per_key
from listinglake.operators.skew import lookup_join, measured_bytes
from listinglake.session import configure, store

WINNERS, PAIRS = "silver/winners", "silver/pairs"
BUCKETS = 32
#: Measured bytes of a table of ids up to which it passes through the driver as a broadcast.
SMALL = 4 * 1024 * 1024
_SILVER = [name for name, _ in schemas.fields(schemas.SILVER)]
_PAIR = ["title", "company_name", "publication_date", "id"]


@dataclass(frozen=True)
class Merged:
    """What a merge did: stored rows read and kept unread, rows written, winners changed."""

    version: int
    rows_read: int
    rows_kept: int
    rows_written: int
    changed: int


def _by_id(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def _by_pair(buckets: int) -> Column:
    return F.pmod(F.xxhash64("title", "company_name"), F.lit(buckets)).cast("int")


def _pair() -> Column:
    """Title and company as one key, in which two nulls are equal."""
    return F.struct("title", "company_name")


def _by_same_id(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join by ``id``, which no side holds twice: no id can be hot.

    The hint holds a larger ``right`` back from Spark's own broadcasts too.
    """
    small = measured_bytes(right) <= SMALL
    return left.join(F.broadcast(right) if small else right.hint("shuffle_hash"), "id", how)


def _keys(frame: DataFrame, bucket: Column) -> list[str]:
    """The parts that ``frame`` touches."""
    return sorted(str(row[0]) for row in frame.select(bucket).distinct().collect())


class _Stored:
    """The live tables of a root, and how many rows were read of them."""

    def __init__(self, spark: SparkSession, root: str, buckets: int) -> None:
        self.spark, self.root = spark, root
        live = publication.live(spark, root)
        self.version = live.version if live else 0
        self.tables = {name: live.tables.get(name) if live else None for name in (WINNERS, PAIRS)}
        known = self.tables[WINNERS]
        self.buckets = known.notes["buckets"] if known else buckets
        self.read_keys: dict[str, set[str]] = {WINNERS: set(), PAIRS: set()}

    def read(self, name: str, keys: list[str], schema: str) -> DataFrame:
        table = self.tables[name]
        if table is None:
            return self.spark.createDataFrame([], schema)
        self.read_keys[name].update(keys)
        return table.read(self.spark, self.root, keys)

    def rows(self, read: bool) -> int:
        total = 0
        for name, table in self.tables.items():
            if table is not None:
                total += table.rows_in(k for k in table.parts if (k in self.read_keys[name]) == read)
        return total

    def replaced(self, newer: publication.Table, keys: list[str]) -> publication.Table:
        table = self.tables[newer.name]
        return newer if table is None else table.with_parts(newer, gone=keys)


def merge_capture(
    spark: SparkSession,
    root: str,
    listings: DataFrame,
    keywords: Sequence[str] = TITLE_KEYWORDS,
    offset: str = "drop",
    buckets: int = BUCKETS,
    files: int = 1,
) -> Merged:
    """Merge one capture of raw listings into the silver tables below ``root``.

    ``files`` tasks write each part; raise it, or the number of parts, with the table.
    """
    configure(spark)
    root = root.rstrip("/")
    stored = _Stored(spark, root, buckets)
    buckets = stored.buckets
    notes = {"buckets": buckets}

    # 1. Newest row per id: the capture's against the stored ones of the same ids.
    rows = silver.relevant(silver.project(listings, offset), keywords)
    fresh = store(latest_per_key(rows, ["id"], "publication_date"), "capture-newest")
    touched = _keys(fresh, _by_id(buckets))
    known = stored.read(WINNERS, touched, f"{schemas.SILVER}, listed boolean")
    before = store(_by_same_id(known, fresh.select("id"), "left_semi"), "capture-before")
    contest = before.select(*_SILVER, F.lit(0).alias("_new")).unionByName(
        fresh.select(*_SILVER, F.lit(1).alias("_new"))
    )
    # Of equal rows the stored one wins, so only real changes go on.
    ties = [name for name in _SILVER if name not in ("id", "publication_date")]
    newest = latest_per_key(contest, ["id"], "publication_date", [*ties, "_new"])
    changed = store(newest.where("_new = 1").drop("_new"), "capture-changed")
    count = changed.count()
    if not count:
        return Merged(stored.version, stored.rows(True), stored.rows(False), 0, 0)

    # 2. Newest winner per pair, for the pairs that changed ids leave or enter.
    left = _by_same_id(before, changed.select("id"), "left_semi")
    moved = store(left.select(*_PAIR).union(changed.select(*_PAIR)), "capture-pairs")
    pair_keys = _keys(moved, _by_pair(buckets))
    entries = stored.read(PAIRS, pair_keys, _pairs_schema())
    entries = _by_same_id(entries, changed.select("id"), "left_anti").unionByName(
        changed.select(*_PAIR, F.lit(None).cast("boolean").alias("listed"))
    )
    pairs = moved.select(_pair().alias("_pair")).distinct().withColumn("_open", F.lit(True))
    marked = store(lookup_join(entries.withColumn("_pair", _pair()), pairs, "_pair", "left", SMALL), "capture-entries")
    best = first_per_key(
        marked.where("_open").select("_pair", "id", "publication_date"),
        ["_pair"],
        [F.col("publication_date").desc_nulls_last(), F.asc("id")],
    )
    best = best.select("id", F.lit(True).alias("_best"))
    verdict = F.when(F.col("_open"), F.coalesce("_best", F.lit(False))).otherwise(F.col("listed"))
    decided = store(
        _by_same_id(marked, store(best, "capture-best"), "left").select(
            *_PAIR, verdict.alias("listed"), F.col("listed").alias("_was")
        ),
        "capture-decided",
    )

    # 3. Rows whose winner or verdict changed; the other parts stay.
    flips = store(
        decided.where(~F.col("listed").eqNullSafe(F.col("_was"))).select("id", F.col("listed").alias("_now")),
        "capture-flips",
    )
    winner_keys = _keys(flips, _by_id(buckets))
    old = stored.read(WINNERS, winner_keys, f"{schemas.SILVER}, listed boolean")
    old = _by_same_id(old, changed.select("id"), "left_anti")
    both = old.unionByName(changed.withColumn("listed", F.lit(False)))
    now = _by_same_id(both, flips, "left").select(
        *_SILVER, F.coalesce("_now", "listed").alias("listed"), _by_id(buckets).alias("bucket")
    )
    winners = publication.stage_parts(now, root, WINNERS, "bucket", files, notes=notes)
    kept = publication.stage_parts(
        decided.select(*_PAIR, "listed", _by_pair(buckets).alias("bucket")), root, PAIRS, "bucket", files, notes=notes
    )
    tables = [stored.replaced(winners, winner_keys), stored.replaced(kept, pair_keys)]
    published = publication.publish(spark, root, tables, expected=stored.version)
    written = winners.rows + kept.rows
    return Merged(published.version, stored.rows(True), stored.rows(False), written, count)


def _pairs_schema() -> str:
    kinds = dict(schemas.fields(schemas.SILVER))
    return ", ".join([*(f"{name} {kinds[name]}" for name in _PAIR), "listed boolean"])


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    """The silver table of all captures merged so far."""
    live = publication.live(spark, root)
    winners = live.read(spark, WINNERS) if live else None
    if winners is None:
        return spark.createDataFrame([], schemas.SILVER)
    return winners.where("listed").drop("listed")


def deal_anew(spark: SparkSession, root: str, buckets: int, files: int = 1) -> None:
    """Write both tables in another number of parts, as they have grown."""
    live = publication.live(spark, root)
    if live is None:
        return
    notes = {"buckets": buckets}
    tables = [
        publication.stage_parts(
            live.read(spark, name).withColumn("bucket", bucket), root, name, "bucket", files, notes=notes
        )
        for name, bucket in ((WINNERS, _by_id(buckets)), (PAIRS, _by_pair(buckets)))
    ]
    publication.publish(spark, root, tables, expected=live.version)
