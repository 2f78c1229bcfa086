"""MinHash near-duplicates: one-permutation hashing, densified, banded, star edges.

1. One map over the texts gives each document the hashes of its word shingles, one
   minimum per bin of one permutation, empty bins filled from other bins chosen by a
   fixed random order per bin (optimal densification), and ``BANDS`` band hashes.
2. Documents of one shingle set are one class; its smallest id stands for it. Copies
   are thus linked without a pair.
3. Candidate edges form stars. Each class is compared with its pivot alone: the most
   central class among the hubs of its band buckets (the one whose buckets hold most members
   in all, where an original beats its variants), or that one's own pivot, and so on while
   sizes fit. Edges are confirmed on the full sets.
4. What stars miss is found exactly. Let x, y be classes of pivot p, which lose ``p - x`` and
   ``p - y`` of it and add ``x - p`` and ``y - p``. They share what neither loses, and what
   both add. So they can be linked beyond the star only if they add a common shingle, or
   lose little enough together. These pairs come from a join on added shingles, never from
   all pairs of a group; bitmaps of what is lost and added, ``SKETCH`` words each, bound the
   shared part from above inside the join, so that hardly a pair that is not linked leaves it.
5. Buckets that still hold several components and several pivots are compared hub by hub,
   ``GROWTH`` times as many hubs each round, across pivots only, until one component is left
   or every member has been a hub. So no pair of a bucket stays undecided, and no cap is set.

Two documents at the threshold meet in no bucket with a probability under 1e-6
(``(1 - 0.85**6)**32``), above it far less.

Null and empty texts, and texts without words, have no shingles and link with nothing.
Texts of fewer than ``SHINGLE`` words have one. Rows of null id are returned unlinked,
with a null component, and stay. Every row is linked by its own text, repeated ids too.
Empty tables give no rows. Ties (equal centrality) go by the set's digest, so the same
set wins in every run. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listinglake.llm import words
from listinglake.llm.components import components
from listinglake.llm.tables import query, table
from listinglake.operators import bloom
from listinglake.operators.skew import hot_keys, lookup_join, measured_bytes, spread_join
from listinglake.session import store

SHINGLE = 5
#: Shared part of the union, in hundredths, from which two documents are linked.
SIMILARITY = 80
BANDS, ROWS = 32, 6
GROWTH = 64
SKETCH = 8
#: Steps from pivot to pivot; each doubles the way.
HOPS = 2
#: Helper tables are broadcast up to so many measured bytes, and else joined by a shuffle.
SMALL = 16 * 1024 * 1024
#: Classes of one pivot that a task meets; with more they are dealt to several.
HOT = 5_000
BINS = BANDS * ROWS


def _probe_order() -> np.ndarray:
    """For each bin, the order in which it asks the other bins for a value."""
    order = np.argsort(
        words.mix(np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(0xA5A5A5A5)).reshape(
            BINS, BINS
        ),
        axis=1,
    )
    return order.T.copy()


_PROBES = _probe_order()


def distinct_shingles(chunk: words.Chunk, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles, ascending by both."""
    row, value = words.shingles(words.words(chunk), size, chunk.rows)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    if len(row):
        fresh = np.ones(len(row), dtype=bool)
        fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        row, value = row[fresh], value[fresh]
    return row, value


def band_hashes(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """``rows x BANDS`` band hashes; rows without shingles give meaningless ones."""
    minima = np.zeros((rows, BINS), dtype=np.uint64)
    filled = np.zeros((rows, BINS), dtype=bool)
    # Hashes ascend within a row, so a bin's first entry is its minimum.
    slot = row * BINS + ((value >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(
        np.int64
    )
    lead = np.ones(len(slot), dtype=bool)
    lead[1:] = slot[1:] != slot[:-1]
    minima.ravel()[slot[lead]] = value[lead]
    filled.ravel()[slot[lead]] = True
    at, hole = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for probe in _PROBES:
        if not len(at):
            break
        lender = probe[hole]
        lends = filled[at, lender]
        minima[at[lends], hole[lends]] = minima[at[lends], lender[lends]]
        at, hole = at[~lends], hole[~lends]
    bands = np.full((rows, BANDS), 0, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for step in range(ROWS):
        bands = words.mix(bands) + minima[:, step::ROWS]
    return words.mix(bands)


def _digests(value: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """A 128-bit name of each row's shingle set."""
    return [
        hashlib.blake2b(value[a:b], digest_size=16).digest()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True)
    ]


def _signer(size: int):
    def run(batches):
        for batch in batches:
            for chunk in words.chunks(batch.column("text")):
                row, value = distinct_shingles(chunk, size)
                count = np.bincount(row, minlength=chunk.rows)
                bounds = np.concatenate([[0], np.cumsum(count)])
                bands = band_hashes(row, value, chunk.rows).view(np.int64)
                bands = [list(bands[r]) if count[r] else [] for r in range(chunk.rows)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(chunk.first, chunk.rows),
                        batch.column("text_key").slice(chunk.first, chunk.rows),
                        pa.array(count.astype(np.int64)),
                        pa.array(_digests(value, bounds), pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "same", "bands"],
                )

    return run


def _set_reader(size: int):
    def run(batches):
        for batch in batches:
            for chunk in words.chunks(batch.column("text")):
                row, value = distinct_shingles(chunk, size)
                bounds = np.searchsorted(row, np.arange(chunk.rows + 1))
                ends = pa.array(bounds.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_digests(value, bounds), pa.binary()),
                        pa.ListArray.from_arrays(ends, pa.array(value.view(np.int64))),
                    ],
                    names=["same", "shingles"],
                )

    return run


def signatures(documents: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, same, bands) of each row, stored: 0.3 KB a document."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    return store(
        documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
            _signer(size),
            f"doc_id {kind}, text_key bigint, n_shingles bigint, same binary, bands array<bigint>",
        ),
        "signatures",
    )


def _bucket_members(classes: DataFrame) -> DataFrame:
    """(band, same, n, central): members of the buckets that hold several classes; stored."""
    each = classes.select(
        F.explode("bands").alias("band"), "same", F.col("n_shingles").alias("n")
    )
    shared = store(
        each.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared"
    )
    members = store(lookup_join(each, shared, "band", "inner", SMALL), "buckets")
    central = store(members.groupBy("same").agg(F.sum("size").alias("central")), "central")
    return store(lookup_join(members.drop("size"), central, "same", "inner", SMALL), "members")


def _class_sets(
    documents: DataFrame, classes: DataFrame, members: DataFrame, pivots: DataFrame, size: int
) -> DataFrame:
    """(same, n, pivot, shingles) of every class in a shared bucket, from its representative's text.

    The sets move once: the shuffle that leaves one of equal sets also brings their pivots.
    """
    wanted = store(
        members.select("same", "n").distinct()
        .join(pivots.select("same", "pivot"), "same", "left")
        .join(classes.select("same", F.col("rep").alias("doc_id")), "same"),
        "wanted",
    )
    asked = bloom.semi_join(documents.select("doc_id", "text"), wanted.select("doc_id"), ["doc_id"], SMALL)
    read = asked.select("text").mapInArrow(_set_reader(size), "same binary, shingles array<bigint>")
    return store(read.dropDuplicates(["same"]).join(wanted.drop("doc_id"), "same"), "shingle-sets")


def _sets_of(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``sets`` whose class is among ``wanted``; the others stay where they are."""
    if measured_bytes(wanted) <= SMALL:
        return sets.join(F.broadcast(wanted), "same", "left_semi")
    return bloom.marked(sets, wanted, ["same"]).where("_maybe").drop("_maybe")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The stored pairs (a, b) whose full shingle sets are similar enough."""
    both = F.size(F.array_intersect("of_a", "of_b"))
    either = F.size("of_a") + F.size("of_b") - both
    ends = pairs.select(F.explode(F.array("a", "b")).alias("same")).distinct()
    asked = _sets_of(sets, store(ends, "asked"))
    left, right = (
        asked.select(F.col("same").alias(end), F.col("shingles").alias(f"of_{end}")) for end in ("a", "b")
    )
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .where(100 * both >= similarity * either)
        .select("a", "b")
    )


def _enough(both: str | F.Column, left: str, right: str, similarity: int) -> F.Column:
    """Whether an intersection of ``both`` suffices for sets of these sizes."""
    both = F.col(both) if isinstance(both, str) else both
    return 100 * both >= similarity * (F.col(left) + F.col(right) - both)


def _pivots(members: DataFrame, similarity: int) -> DataFrame:
    """(same, n, pivot): each class and the most central fitting hub of its buckets."""
    hubs = store(
        members.groupBy("band").agg(F.max(F.struct("central", "same", "n")).alias("hub")), "hubs"
    )

    def fits(one: str, other: str) -> F.Column:
        return 100 * F.least(one, other) >= similarity * F.greatest(one, other)

    now = store(
        lookup_join(members, hubs.select("band", "hub.*").toDF("band", "_central", "_hub", "_n"), "band", "inner", SMALL)
        .where((F.col("same") != F.col("_hub")) & fits("n", "_n"))
        .groupBy("same", "n")
        .agg(F.max(F.struct("_central", "_hub", "_n")).alias("hub"))
        .select("same", "n", F.col("hub._hub").alias("pivot"), F.col("hub._n").alias("pivot_n")),
        "pivots",
    )
    for _ in range(HOPS):
        onward = now.select(
            F.col("same").alias("pivot"), F.col("pivot").alias("_next"), F.col("pivot_n").alias("_next_n")
        )
        further = F.col("_next").isNotNull() & fits("n", "_next_n")
        now = store(
            lookup_join(now, onward, "pivot", "left", SMALL).select(
                "same",
                "n",
                F.when(further, F.col("_next")).otherwise(F.col("pivot")).alias("pivot"),
                F.when(further, F.col("_next_n")).otherwise(F.col("pivot_n")).alias("pivot_n"),
            ),
            "pivots",
        )
    return now.drop("pivot_n")


def _sketch(values: str, name: str) -> list[F.Column]:
    """``SKETCH`` words of a bitmap of the shingles: unions only ever look smaller in it."""

    def word(number: int) -> F.Column:
        def spot(value: F.Column) -> F.Column:
            return F.pmod(value, F.lit(64 * SKETCH))

        return F.aggregate(
            F.filter(values, lambda value: F.floor(spot(value) / 64) == number),
            F.lit(0).cast("bigint"),
            lambda bits, value: bits.bitwiseOR(
                F.call_function("shiftleft", F.lit(1).cast("bigint"), (spot(value) % 64).cast("int"))
            ),
        )

    return [word(number).alias(f"{name}{number}") for number in range(SKETCH)]


def _hot_pivots(frame: DataFrame) -> DataFrame | None:
    return hot_keys(frame.select("pivot"), ["pivot"], rows=HOT)


def _stars(sets: DataFrame, similarity: int) -> DataFrame:
    """Each class against its pivot, stored: what it adds, sketches, and whether it is linked."""
    own = sets.select("same", "n", "pivot", F.col("shingles").alias("own")).where("pivot IS NOT NULL")
    pivots = store(own.select(F.col("pivot").alias("same")).distinct(), "centres")
    centre = _sets_of(sets, pivots).select(F.col("same").alias("pivot"), F.col("shingles").alias("centre"))
    if (centre.agg(F.sum(64 + 8 * F.size("centre"))).first()[0] or 0) <= SMALL:
        both = own.join(F.broadcast(centre), "pivot")
    else:
        both = spread_join(own, centre, ["pivot"], "inner", _hot_pivots(own), ["same"])
    met = both.select(
        "same",
        "n",
        "pivot",
        F.size("centre").alias("pivot_n"),
        F.array_except("own", "centre").alias("added"),
        F.array_except("centre", "own").alias("lost"),
    )
    return store(
        met.select(
            "same",
            "n",
            "pivot",
            "pivot_n",
            "added",
            *_sketch("lost", "lost"),
            *_sketch("added", "new"),
            _enough(F.col("n") - F.size("added"), "n", "pivot_n", similarity).alias("linked"),
        ),
        "stars",
    )


def _beyond_stars(stars: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) of one pivot that may be linked though not both are linked to it."""
    sketches = [f"{name}{number}" for name in ("lost", "new") for number in range(SKETCH)]

    def side(frame: DataFrame, name: str) -> DataFrame:
        held = ["same", "n", "linked", *sketches]
        return frame.select(
            "pivot",
            "pivot_n",
            "added",
            F.size("added").alias(f"{name}_added"),
            *(F.col(column).alias(f"{name}_{column}") for column in held),
        )

    away = stars.where(~F.col("linked"))
    left = side(away, "x")
    right = side(
        stars.join(away.select("pivot").distinct(), "pivot", "left_semi"), "y"
    ).drop("pivot_n")

    def union_size(name: str) -> F.Column:
        words_ = [
            F.bit_count(F.col(f"x_{name}{k}").bitwiseOR(F.col(f"y_{name}{k}")))
            for k in range(SKETCH)
        ]
        return sum(words_[1:], words_[0])

    kept = F.col("pivot_n") - union_size("lost")
    common = F.least(
        F.col("x_added") + F.col("y_added") - union_size("new"),
        F.least("x_added", "y_added"),
    )
    once = (F.col("x_same") != F.col("y_same")) & (
        F.col("y_linked") | (F.col("x_same") < F.col("y_same"))
    )

    def opened(frame: DataFrame) -> DataFrame:
        return frame.withColumn("shingle", F.explode("added")).drop("added")

    sharing = (
        opened(left)
        .join(opened(right), ["pivot", "shingle"])
        .where(once & _enough(kept + common, "x_n", "y_n", similarity))
    )
    # Without a common new shingle, what is kept must suffice, if only for a small partner.
    within = F.col("x_n") - F.col("x_added")
    near = left.where(100 * within >= similarity * (F.col("x_n") * (1 + similarity / 100) - within))
    # All classes of the pivot are the large side: they are spread, the few near ones repeated.
    alone = (
        spread_join(
            right.drop("added"), near.drop("added"), ["pivot"], "inner", _hot_pivots(stars), ["y_same"]
        )
        .where(once & _enough(kept, "x_n", "y_n", similarity))
    )
    ends = [F.least("x_same", "y_same").alias("a"), F.greatest("x_same", "y_same").alias("b")]
    return sharing.select(*ends).union(alone.select(*ends)).distinct()


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components of what is known and the new links."""
    if links.isEmpty():
        return roots
    known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return store(components(known.union(links)), "roots")


def _linked(documents: DataFrame, classes: DataFrame, size: int, similarity: int) -> DataFrame:
    """(node, root): components of the classes that similar pairs within buckets link."""
    members = _bucket_members(classes)
    sets = _class_sets(documents, classes, members, _pivots(members, similarity), size)
    spark = documents.sparkSession
    stars = _stars(sets, similarity)
    others = store(_beyond_stars(stars, similarity), "pairs")
    links = stars.where("linked").select(F.col("same").alias("a"), F.col("pivot").alias("b"))
    if not others.isEmpty():
        links = links.union(_confirmed(others, sets, similarity))
    roots = _joined(spark.createDataFrame([], "node binary, root binary"), store(links, "links"))
    pivot_of = stars.select("same", "pivot")
    members = store(
        lookup_join(members, pivot_of, "same", "left", SMALL).withColumn(
            "pivot", F.coalesce("pivot", "same")
        ),
        "pivoted-buckets",
    )
    compared = spark.createDataFrame([], "a binary, b binary")
    by_rank = Window.partitionBy("band").orderBy(F.desc("central"), F.asc("same"))
    used = 0
    while True:
        rooted = lookup_join(
            members, roots.withColumnRenamed("node", "same"), "same", "left", SMALL
        ).withColumn("root", F.coalesce("root", "same"))
        # Open: several components and pivots, and members left that have not been hubs.
        open_bands = store(
            rooted.groupBy("band")
            .agg(
                (F.min("root") != F.max("root")).alias("apart"),
                (F.min("pivot") != F.max("pivot")).alias("pivots"),
                F.count(F.lit(1)).alias("size"),
            )
            .where(F.col("apart") & F.col("pivots") & (F.col("size") > used + 1))
            .select("band"),
            "open",
        )
        if open_bands.isEmpty():
            return roots
        active = store(
            lookup_join(rooted, open_bands, "band", "inner", SMALL), "open-buckets"
        )
        # The rank limit is applied before the shuffle, so no task sees a whole hot bucket.
        hubs = (
            active.withColumn("place", F.row_number().over(by_rank))
            .where(F.col("place") <= GROWTH * used + 1)
            .where(F.col("place") > used)
            .select(
                "band",
                F.col("same").alias("hub"),
                F.col("n").alias("hub_n"),
                F.col("root").alias("hub_root"),
                F.col("pivot").alias("hub_pivot"),
            )
        )
        found = (
            active.join(hubs, "band")
            .where((F.col("root") != F.col("hub_root")) & (F.col("pivot") != F.col("hub_pivot")))
            .where((F.col("pivot") != F.col("hub")) & (F.col("hub_pivot") != F.col("same")))
            .where(100 * F.least("n", "hub_n") >= similarity * F.greatest("n", "hub_n"))
            .select(F.least("same", "hub").alias("a"), F.greatest("same", "hub").alias("b"))
            .distinct()
        )
        pairs = store(found.join(compared, ["a", "b"], "left_anti") if used else found, "pairs")
        compared = compared.union(pairs)
        if not pairs.isEmpty():
            roots = _joined(roots, store(_confirmed(pairs, sets, similarity), "links"))
        used = GROWTH * used + 1


def _verdicts(documents: DataFrame, size: int, similarity: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, component, component_id, kept) of every row.

    ``component`` is the digest of one set of the row's group, which tells groups of one
    smallest id apart; null where the row links with nothing.
    """
    signed = signatures(documents, size)
    classes = store(
        signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("same", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")),
        "classes",
    )
    roots = _linked(documents, classes, size, similarity)
    rooted = classes.select("same", "rep").join(
        roots.withColumnRenamed("node", "same"), "same", "left"
    )
    smallest = (
        rooted.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("rep").alias("least"))
    )
    found = store(
        rooted.join(smallest, "root", "left").select(
            "same",
            F.coalesce("root", "same").alias("component"),
            F.coalesce("least", "rep").alias("component_id"),
        ),
        "found",
    )
    linkable = F.when(F.col("n_shingles") > 0, F.col("same"))
    return (
        lookup_join(
            signed.select("doc_id", "text_key", "n_shingles", linkable.alias("same")),
            found,
            "same",
            "left",
        )
        .select(
            "doc_id",
            "text_key",
            "n_shingles",
            "component",
            F.when(
                F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")
            ).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def near_duplicates(
    documents: DataFrame, size: int = SHINGLE, similarity: int = SIMILARITY
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``documents``."""
    verdict = _verdicts(documents, size, similarity)
    return verdict.select("doc_id", "n_shingles", "component_id", "kept")


def keep_first(documents: DataFrame) -> DataFrame:
    """One row of each near-duplicate group, as it is; rows of null id all stay.

    The group's smallest id stays. Of several rows of the group with that id, one row of the
    smallest text stays. Rows of one id whose texts are of different groups do not replace
    each other; of rows without words, only equal ones do.
    """
    verdict = _verdicts(documents, SHINGLE, SIMILARITY).where(F.col("doc_id").isNotNull())
    group = F.coalesce("component", F.col("text_key").cast("string").cast("binary"))
    verdict = store(
        verdict.select("doc_id", F.col("text_key").alias("_text"), group.alias("_group"), "kept"),
        "verdicts",
    )
    dropped = store(verdict.where(~F.col("kept")).select("doc_id", "_text").distinct(), "dropped")
    several = (
        verdict.where("kept")
        .groupBy("doc_id", "_group")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where("_rows > 1")
        .select("doc_id", "_group")
    )
    repeated = store(
        verdict.where("kept").join(several, ["doc_id", "_group"], "left_semi").drop("kept").distinct(),
        "repeated",
    )
    # The row travels as one column, so no name of it can clash.
    keyed = documents.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("_text"))
    left = bloom.anti_join(keyed, dropped, ["doc_id", "_text"], SMALL)
    if repeated.isEmpty():
        return left.select("row.*")
    again = left.join(repeated, ["doc_id", "_text"])
    order = Window.partitionBy("doc_id", "_group").orderBy("row.text", F.xxhash64("row"))
    one = again.withColumn("_place", F.row_number().over(order)).where("_place = 1").select("row.*")
    return left.join(repeated, ["doc_id", "_text"], "left_anti").select("row.*").union(one)


@query("op7_neardup")
def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, similarity=85)
