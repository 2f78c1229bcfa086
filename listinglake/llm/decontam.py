"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of template tokens: words in lower case, and typed placeholders
for numbers (digit runs, joined over one point or comma), units (a known unit right after a
number) and names (capitalised words inside a sentence, neighbours joined). Windows of
``WINDOW`` template tokens with at least half literal words are hash-joined with those of the
benchmark. Matches of one document and item on one diagonal (equal distance of positions)
must fill each slot value of the item with one value of the document, else the diagonal is
dropped. A document is contaminated when consistent diagonals together cover at least
``COVERAGE`` of an item's windows, each counted once however often the document repeats it,
whether its slots are filled as in the item or anew.

Beside the templates, the same windows over all words in lower case, numbers, units and
names as their text and without a least share of words, find verbatim copies: of items that
are mostly numbers or names, and in any case of letters. Either form's coverage suffices, but
a place where the templates show inconsistent slots is no verbatim copy.

Scale: texts are read once; a Bloom filter of the benchmark windows, of fixed size at any
input (``FILTER_BITS``), lets only likely windows leave the map. The exact join broadcasts
the benchmark windows while they measure under the library's limit and else shuffles with
hot windows salted. A match group is one document, item and diagonal, so it is never larger
than the item.

Items of ``SHORTEST`` to ``WINDOW - 1`` tokens form one window of their own length; shorter
ones, null and empty ones match nothing. A few common words ("What is the capital") also stand
in texts that have never seen the item, so an item of fewer than ``CONDEMNING`` words makes a
document contaminated only as a whole verbatim copy that holds ``TELLING`` words or more which are
neither numbers nor function words (``COMMON``); else it is reported and nothing more. Null and empty texts match nothing. Rows of null
id are judged like others; text in capitals or in lower case shows no names, so when it is
filled anew, what an item says around its names must carry the coverage; repeated rows get the same verdict each; rows of one id with
different texts are judged apart. Items with equal texts all match. With an empty benchmark
every document is clean. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm import words
from listinglake.llm.tables import query, table
from listinglake.operators.skew import (
    BROADCAST_BYTES,
    hot_keys,
    lookup_join,
    measured_bytes,
    spread_join,
)
from listinglake.session import store

WINDOW = 8
SHORTEST = 4
#: Words from which an item condemns by its windows; a shorter one needs so many telling words.
CONDEMNING, TELLING = 8, 3
COVERAGE = 0.5
FILTER_BITS = 1 << 24
#: Bytes of white space and symbols that may part a number from its unit.
UNIT_GAP = 3
#: Units that make a placeholder after a number.
UNITS = (
    "kg g mg lb lbs oz ton tons km m cm mm mile miles ft foot feet inch inches yard yards "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months "
    "year years l ml liter liters litre litres gallon gallons cup cups dollar dollars cent "
    "cents euro euros pound pounds usd eur percent degree degrees mph kmh"
).split()
#: Function words that say nothing about where a few words come from.
COMMON = (
    "a an the of in on at to for from by with and or not no is are was were be been do does did "
    "has have had can could will would should may might must it its this that these those there "
    "i you he she we they his her our their your my what which who whom whose when where why how "
    "many much more most some any all each one two if then than as so but about into over after "
    "before between find give name say tell choose following true false der die das und ist le la "
    "les un une et est de des du el los las y es que"
).split()

_DIGITS = bytes(range(48, 58))
_SYMBOLS = bytes(
    x for x in range(128) if x not in words.SPACES and not chr(x).isalnum() and x != 0x5F
)
#: 0 white space and symbols, 1 digits, 2 letters.
_CLASSES = words.byte_classes(words.SPACES + _SYMBOLS, _DIGITS, rest=2)
_ENDS = np.zeros(256, dtype=np.int64)
_ENDS[list(b".!?\n")] = 1
_NUMBER, _UNIT, _NAME = (np.uint64(x) for x in (0xA11, 0xA22, 0xA33))
#: Keeps windows of the literal form apart from those of the template form.
_LITERAL = np.uint64(0x9D39247E33776D41)
#: Numbers of the two forms.
TEMPLATE, LITERAL = 0, 1


def _word_hashes(listed: list[str]) -> np.ndarray:
    body = np.frombuffer("".join(listed).encode(), dtype=np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in listed])])
    return np.sort(words.words(words.Chunk(0, body, bounds), _CLASSES).hash)


_UNIT_HASHES, _COMMON_HASHES = _word_hashes(UNITS), _word_hashes(COMMON)


def folded(column: pa.Array) -> Iterator[tuple[words.Chunk, words.Chunk]]:
    """Chunks of the texts as they are and in lower case, byte for byte alike.

    Sharp s reads as ss in both. A text whose lower case has another length keeps its case
    beyond A-Z.
    """
    plain = pc.replace_substring(column.cast(pa.large_string()).fill_null(""), "ß", "ss")
    lower = pc.utf8_lower(plain)
    alike = pc.equal(pc.binary_length(plain), pc.binary_length(lower))
    yield from zip(
        words.chunks(plain), words.chunks(pc.if_else(alike, lower, plain)), strict=True
    )


def _capitalised(data: np.ndarray, found: words.Words) -> np.ndarray:
    """Words of an upper-case letter (A-Z or Latin-1) and a lower-case one after it."""
    body = np.concatenate([data, np.zeros(3, np.uint8)])
    lead, second = body[found.start], body[found.start + 1]
    accent = (lead == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    next_at = found.start + np.where(accent, 2, 1)
    after, trail = body[next_at], body[next_at + 1]
    lower = (after >= 97) & (after <= 122) | (after == 0xC3) & (trail >= 0x9F) | (after > 0xC3)
    return ((lead >= 65) & (lead <= 90) | accent) & lower & (next_at < found.stop)


def templates(chunk: words.Chunk, found: words.Words) -> tuple[np.ndarray, ...]:
    """(row, token, slot, word): template tokens and the number of their first word.

    ``slot`` names a placeholder's value, else 0.
    """
    data = chunk.data
    if not len(found.row):
        none = np.empty(0, np.uint64)
        return found.row, none, none, found.row
    digit = _CLASSES[data[found.start]] == 1
    before = np.concatenate([[0], found.stop[:-1]])
    follows = np.concatenate([[False], found.row[1:] == found.row[:-1]])
    gap = found.start - before
    ends = np.concatenate([[0], np.cumsum(_ENDS[data])])
    inside = follows & (ends[found.start] == ends[before])
    name = inside & _capitalised(data, found)
    after_digit = np.concatenate([[False], digit[:-1]]) & follows
    unit = after_digit & (gap <= UNIT_GAP) & ~digit & np.isin(found.hash, _UNIT_HASHES)
    name &= ~unit
    joint = data[np.minimum(before, len(data) - 1)]
    carries = digit & after_digit & (gap == 1) & ((joint == 0x2E) | (joint == 0x2C))
    carries |= name & np.concatenate([[False], name[:-1]]) & (gap == 1)
    head = np.flatnonzero(~carries)
    row, digit, unit, name = found.row[head], digit[head], unit[head], name[head]
    place = np.arange(len(carries)) - np.repeat(head, np.diff(np.append(head, len(carries))))
    value = np.add.reduceat(words.mix(found.hash + place.astype(np.uint64)), head)
    token = found.hash[head].copy()
    token[digit], token[unit], token[name] = _NUMBER, _UNIT, _NAME
    return row, token, np.where(digit | unit | name, value | np.uint64(1), np.uint64(0)), head


def windows(
    row: np.ndarray, token: np.ndarray, slot: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the windows of ``size`` tokens with enough literal words."""
    if len(token) < size:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    runs = len(token) - size + 1
    literal = np.concatenate([[0], np.cumsum(slot == 0)])
    fits = row[:runs] == row[size - 1 :]
    fits &= 2 * (literal[size:] - literal[:-size]) >= size
    start = np.flatnonzero(fits)
    return start, words.joined(token, size)[start]


def forms(chunk: words.Chunk, lower: words.Chunk) -> list[tuple[np.ndarray, ...]]:
    """The template form and the literal form of a chunk, each as (row, token, slot, word).

    The literal form keeps every word, number, unit and name as its text in lower case.
    """
    found = words.words(lower, _CLASSES)
    none = np.zeros(len(found.row), np.uint64)
    literal = (found.row, found.hash ^ _LITERAL, none, np.arange(len(found.row)))
    own = np.cumsum(np.bincount(found.row, minlength=chunk.rows))
    return [
        (row, token, slot, word - np.concatenate([[0], own])[row])
        for row, token, slot, word in (templates(chunk, found), literal)
    ]


def _bits(value: np.ndarray) -> list[np.ndarray]:
    """Two filter positions of each window hash."""
    shift = np.uint64(64 - FILTER_BITS.bit_length() + 1)
    return [(value >> shift).astype(np.int64), (words.mix(value) >> shift).astype(np.int64)]


def _slots_of(start: np.ndarray, slot: np.ndarray, size: int) -> pa.Array:
    """The placeholder values of each window, in order."""
    spans = slot[start[:, None] + np.arange(size)] if len(start) else np.empty((0, size), np.uint64)
    used = spans != 0
    ends = np.concatenate([[0], np.cumsum(used.sum(axis=1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(spans[used].view(np.int64)))


def _item_windows(batches):
    """(item_id, text) to (item_id, form, at, word_at, size, n_words, n_telling, n_windows, window, item_slots)."""
    for batch in batches:
        ids = batch.column("item_id")
        for chunk, lower in folded(batch.column("text")):
            both = forms(chunk, lower)
            own = both[LITERAL][0]
            found = words.words(lower, _CLASSES)
            telling = (_CLASSES[lower.data[found.start]] != 1) & ~np.isin(found.hash, _COMMON_HASHES)
            n_words = np.bincount(own, minlength=chunk.rows)
            n_telling = np.bincount(own[telling], minlength=chunk.rows)
            for form, (row, token, slot, word) in enumerate(both):
                count = np.bincount(row, minlength=chunk.rows)
                first = np.cumsum(count) - count
                for size in range(SHORTEST, WINDOW + 1):
                    wanted = count >= size if size == WINDOW else count == size
                    start, value = windows(row, token, slot, size)
                    mine = wanted[row[start]] if len(start) else np.empty(0, bool)
                    start, value = start[mine], value[mine]
                    if not len(start):
                        continue
                    owner = row[start]
                    number = np.bincount(owner, minlength=chunk.rows)[owner]
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(owner + chunk.first)),
                            pa.array(np.full(len(start), form, np.int32)),
                            pa.array((start - first[owner]).astype(np.int64)),
                            pa.array(word[start].astype(np.int64)),
                            pa.array(np.full(len(start), size, np.int32)),
                            pa.array(n_words[owner].astype(np.int64)),
                            pa.array(n_telling[owner].astype(np.int64)),
                            pa.array(number.astype(np.int64)),
                            pa.array(value.view(np.int64)),
                            _slots_of(start, slot, size),
                        ],
                        names=[
                            *("item_id", "form", "at", "word_at", "size", "n_words", "n_telling"),
                            *("n_windows", "window", "item_slots"),
                        ],
                    )


def item_windows(benchmark: DataFrame) -> DataFrame:
    """The benchmark's windows, stored."""
    kind = benchmark.schema["item_id"].dataType.simpleString()
    return store(
        benchmark.select("item_id", "text").mapInArrow(
            _item_windows,
            f"item_id {kind}, form int, at bigint, word_at bigint, size int, n_words bigint, n_telling bigint, n_windows bigint, window bigint,"
            " item_slots array<bigint>",
        ),
        "item-windows",
    )


def _bloom(batches):
    """Windows to (word, bits): 64-bit words of the filter."""
    for batch in batches:
        value = batch.column("window").to_numpy().view(np.uint64)
        spots = np.unique(np.concatenate(_bits(value)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(spots >> 6),
                pa.array((np.uint64(1) << (spots & 63).astype(np.uint64)).view(np.int64)),
            ],
            names=["word", "bits"],
        )


def window_filter(items: DataFrame) -> np.ndarray:
    """Filter words on the driver: ``FILTER_BITS / 8`` bytes at any input size."""
    words_set = (
        items.select("window")
        .mapInArrow(_bloom, "word bigint, bits bigint")
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .collect()
    )
    found = np.zeros(FILTER_BITS >> 6, dtype=np.int64)
    for word, bits in words_set:
        found[word] = bits
    return found.view(np.uint64)


def document_windows(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_key, pos, word_pos, window, doc_slots) of windows that the benchmark may hold."""
    sizes = [[], []]
    for form, size in sorted(items.select("form", "size").distinct().collect()):
        sizes[form].append(size)
    shared = documents.sparkSession.sparkContext.broadcast(window_filter(items))

    def run(batches):
        known = shared.value
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("text_key")
            for chunk, lower in folded(batch.column("text")):
                for form, (row, token, slot, word) in enumerate(forms(chunk, lower)):
                    count = np.bincount(row, minlength=chunk.rows)
                    first = np.cumsum(count) - count
                    for size in sizes[form]:
                        start, value = windows(row, token, slot, size)
                        for spot in (0, 1):
                            bit = _bits(value)[spot]
                            hit = known[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)
                            start, value = start[hit > 0], value[hit > 0]
                        owner = row[start]
                        at = pa.array(owner + chunk.first)
                        yield pa.RecordBatch.from_arrays(
                            [
                                ids.take(at),
                                keys.take(at),
                                pa.array((start - first[owner]).astype(np.int64)),
                                pa.array(word[start].astype(np.int64)),
                                pa.array(value.view(np.int64)),
                                _slots_of(start, slot, size),
                            ],
                            names=["doc_id", "text_key", "pos", "word_pos", "window", "doc_slots"],
                        )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        run,
        f"doc_id {kind}, text_key bigint, pos bigint, word_pos bigint, window bigint, doc_slots array<bigint>",
    )


def matches(documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, text_key, item_id, coverage, n_slots, n_changed, condemns) of documents that hold an item."""
    items = item_windows(benchmark)
    likely = store(document_windows(documents, items).distinct(), "likely-windows")
    if measured_bytes(items) <= BROADCAST_BYTES:
        met = likely.join(F.broadcast(items), "window")
    else:
        met = spread_join(
            likely, items, ["window"], "inner", hot_keys(likely, ["window"]), ["doc_id", "pos"]
        )
    pairs = F.arrays_zip(F.col("item_slots").alias("item"), F.col("doc_slots").alias("doc"))
    diagonals = (
        met.where(F.size("item_slots") == F.size("doc_slots"))
        .groupBy(
            "doc_id", "text_key", "item_id", "form", (F.col("pos") - F.col("at")).alias("shift")
        )
        .agg(
            F.first("n_windows").alias("n_windows"),
            F.first("n_words").alias("n_words"),
            F.first("n_telling").alias("n_telling"),
            F.collect_set("at").alias("covered"),
            F.array_distinct(F.flatten(F.collect_set(pairs))).alias("slots"),
            F.collect_set(F.col("word_pos") - F.col("word_at")).alias("word_shifts"),
        )
        # Consistent: no value of the item stands for two values of the document.
        .withColumn(
            "fits",
            F.size(F.array_distinct(F.transform("slots", lambda s: s["item"]))) == F.size("slots"),
        )
    )
    changed = F.size(F.filter("slots", lambda s: s["item"] != s["doc"]))
    template, literal = F.col("form") == TEMPLATE, F.col("form") == LITERAL
    grouped = (
        diagonals.select(
            "doc_id",
            "text_key",
            "item_id",
            "form",
            "shift",
            "n_windows",
            "n_words",
            "n_telling",
            "fits",
            "word_shifts",
            # Sorted, the places of a phrase that the document repeats are one member of the set.
            F.sort_array("covered").alias("covered"),
            F.size("slots").alias("slots"),
            changed.alias("changed"),
        )
        .groupBy("doc_id", "text_key", "item_id")
        .agg(
            F.max("n_words").alias("n_words"),
            F.max("n_telling").alias("n_telling"),
            F.collect_set(F.when(template & F.col("fits"), F.col("covered"))).alias("filled"),
            F.collect_set(F.when(template & ~F.col("fits"), F.col("word_shifts"))).alias("broken"),
            F.collect_set(F.when(literal, F.struct("shift", "covered"))).alias("verbatim"),
            F.max(F.when(template, F.col("n_windows"))).alias("n_templates"),
            F.max(F.when(literal, F.col("n_windows"))).alias("n_literals"),
            F.sum(F.when(F.col("fits"), F.col("slots"))).alias("n_slots"),
            F.sum(F.when(F.col("fits"), F.col("changed"))).alias("n_changed"),
        )
        .withColumn("broken", F.array_distinct(F.flatten("broken")))
    )

    def part(places: F.Column, whole: str) -> F.Column:
        found = F.size(F.array_distinct(F.flatten(places)))
        return F.coalesce(found / F.col(whole), F.lit(0.0))

    # Where the templates show slots filled inconsistently, the words between them are no copy.
    verbatim = F.filter("verbatim", lambda x: ~F.array_contains("broken", x["shift"]))
    verbatim = F.transform(verbatim, lambda x: x["covered"])
    copied = part(verbatim, "n_literals")
    whole = (F.col("n_telling") >= TELLING) & (copied == 1.0)
    return grouped.select(
        "doc_id",
        "text_key",
        "item_id",
        F.greatest(part(F.col("filled"), "n_templates"), copied).alias("coverage"),
        ((F.col("n_words") >= CONDEMNING) | whole).alias("condemns"),
        F.coalesce("n_slots", F.lit(0)).alias("n_slots"),
        F.coalesce("n_changed", F.lit(0)).alias("n_changed"),
    ).where(F.col("coverage") >= coverage)


def _by_document(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each (doc_id, text_key) that holds an item, stored."""
    return store(
        matches(documents, benchmark)
        .groupBy("doc_id", "text_key")
        .agg(
            F.sort_array(F.collect_set("item_id")).alias("items"),
            F.max("coverage").alias("coverage"),
            F.max((F.col("n_changed") > 0) & F.col("condemns")).alias("reparameterised"),
            F.max("condemns").alias("contaminated"),
        ),
        "contaminated",
    )


def _keys(frame: DataFrame, text: str = "text") -> DataFrame:
    """Join keys without nulls: whether the id is null, the id or 0, and the text's hash."""
    return frame.withColumns(
        {
            "_no_id": F.col("doc_id").isNull(),
            "_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            "_text": F.xxhash64("text") if text == "text" else F.col(text),
        }
    )


def judge(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, items, coverage, reparameterised) of every row."""
    found = _keys(_by_document(documents, benchmark), "text_key").drop("doc_id", "text_key")
    own = _keys(documents.select("doc_id", "text")).drop("text")
    return lookup_join(own, found, ["_no_id", "_id", "_text"], "left").select(
        "doc_id",
        F.coalesce("contaminated", F.lit(False)).alias("contaminated"),
        F.coalesce(F.size("items"), F.lit(0)).alias("n_items"),
        F.coalesce(F.array_join(F.col("items").cast("array<string>"), ","), F.lit("")).alias(
            "items"
        ),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("reparameterised", F.lit(False)).alias("reparameterised"),
    )


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents``, as they are, that no benchmark item condemns."""
    condemned = _by_document(documents, benchmark).where("contaminated")
    found = _keys(condemned, "text_key").select("_no_id", "_id", "_text")
    # The row travels as one column, so no name of it can clash with the keys.
    packed = _keys(documents.select(F.struct("*").alias("row"), "doc_id", "text"))
    return (
        lookup_join(packed, found.withColumn("_hit", F.lit(True)), ["_no_id", "_id", "_text"], "left")
        .where(F.col("_hit").isNull())
        .select("row.*")
    )


@query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
