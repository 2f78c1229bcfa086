"""Importance resampling towards a target distribution, by bit-sliced aggregation.

Words and pairs of neighbouring words are features; the CRC-32 of a feature's bytes names one
of ``BUCKETS`` buckets. A bucket's gain is the scaled log of its share in the target over its
share in the documents, a whole number. The weight of a document is the mean gain of its
features, and it comes from bit planes alone:

* the document's bucket counts become planes of 10,000 bits, plane k holding bit k of every
  count;
* the gains become planes too, in two's complement: plane j holds bit j, the last one the sign;
* ``popcount(count plane k AND gain plane j)`` times ``2**(k + j)``, less for the sign plane,
  summed over all k and j is the exact sum of count times gain, in 64-bit whole numbers.

CRCs are computed for all words of a chunk at once, byte place by byte place; that of a pair
follows from its words' by the shift of a CRC over the second word's length.

Plan: one map per table leaves at most ``BUCKETS`` counts a task, which are summed (10,000 rows
reach the driver, at any size); one map scores whole texts. Ranks come from a range partition
of narrow rows by (score, id), numbered inside each part and shifted by the sizes of the parts
before, so no task sees all rows; a place in the stored table ends the sort key, so equal rows
spread as well.

Null texts are read as empty: no features, weight 0. A null id hashes as the empty string and
sorts first among ties. Repeated rows count each; rows of one id and score go by n_features. An
empty table gives no rows, an empty target gains of the documents alone. Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listinglake.llm.tables import query, table
from listinglake.llm.words import Chunk, byte_classes, chunks
from listinglake.session import store

BUCKETS = 10_000
#: Gains and the noise of the draw are whole thousandths.
SCALE = 1000
MIN_WORDS, SHARE, SEED = 20, 25, 7
#: Longest word whose CRC is computed with all others of its chunk.
_SHORT = 64
#: Rows whose planes are held at a time.
_ROWS = 256
_SLOT_BITS = 33  # monotonically_increasing_id: partition << 33 | row

_ALNUM = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B))
#: Digits, letters and all bytes of characters beyond ASCII are words.
_WORDS = byte_classes(_ALNUM + bytes(range(0x80, 0x100)), rest=1) == 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_ONES = np.uint32(0xFFFFFFFF)


def _crc_steps() -> np.ndarray:
    """What one byte does to a CRC-32 (polynomial 0xEDB88320, bits reversed)."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(0xEDB88320), value >> 1)
    return value


def _crc_shifts(steps: np.ndarray) -> np.ndarray:
    """[length, place, byte]: what ``length`` zero bytes make of a byte at a place of a CRC."""
    place = np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8)
    value = np.arange(256, dtype=np.uint32)[None, :] << place
    shifts = [value]
    for _ in range(_SHORT):
        value = steps[value & 255] ^ (value >> 8)
        shifts.append(value)
    return np.stack(shifts)


_STEPS = _crc_steps()
_SHIFTS = _crc_shifts(_STEPS)


def word_spans(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop) of the words of a chunk, in bytes."""
    here = np.zeros(len(chunk.data) + 1, dtype=bool)
    here[:-1] = _WORDS[chunk.data]
    before = np.zeros(len(here), dtype=bool)
    before[1:] = here[:-1]
    edge = np.zeros(len(here), dtype=bool)
    edge[chunk.offsets] = True
    start = np.flatnonzero(here & (edge | ~before))
    stop = np.flatnonzero(before & (edge | ~here))
    return np.searchsorted(chunk.offsets, start, side="right") - 1, start, stop


def word_crcs(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """CRC-32 of every span of ``data``."""
    length = stop - start
    order = np.argsort(-length, kind="stable")
    first_short = int(np.searchsorted(-length[order], -_SHORT))
    crc = np.full(len(start), _ONES, dtype=np.uint32)
    mine, begin = order[first_short:], start[order[first_short:]]
    state, ordered = crc[first_short:], length[order[first_short:]]
    for step in range(int(ordered[0]) if len(ordered) else 0):
        active = int(np.searchsorted(-ordered, -step))
        now = state[:active]
        state[:active] = _STEPS[(now ^ data[begin[:active] + step]) & 255] ^ (now >> 8)
    found = np.empty(len(start), dtype=np.uint32)
    found[mine] = state ^ _ONES
    for k in order[:first_short]:
        found[k] = zlib.crc32(data[start[k] : stop[k]])
    return found


def pair_crcs(
    data: np.ndarray, start: np.ndarray, stop: np.ndarray, crc: np.ndarray, first: np.ndarray
) -> np.ndarray:
    """CRC-32 of word ``first[i]``, a space and the next word."""
    state = crc[first] ^ _ONES
    spaced = (_STEPS[(state ^ np.uint32(0x20)) & 255] ^ (state >> 8)) ^ _ONES
    following = first + 1
    length = stop[following] - start[following]
    short = np.minimum(length, _SHORT)
    found = crc[following].copy()
    for place in range(4):
        found ^= _SHIFTS[short, place, (spaced >> np.uint32(8 * place)) & 255]
    for k in np.flatnonzero(length > _SHORT):
        word = following[k]
        found[k] = zlib.crc32(data[start[word] : stop[word]], int(spaced[k]))
    return found


def features(chunk: Chunk, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of each feature and the number of words of each row."""
    row, start, stop = word_spans(chunk)
    data = _LOWER[chunk.data]
    crc = word_crcs(data, start, stop)
    first = np.flatnonzero(row[1:] == row[:-1])
    pairs = pair_crcs(data, start, stop, crc, first)
    bucket = np.concatenate([crc, pairs]) % np.uint32(buckets)
    return np.concatenate([row, row[first]]), bucket.astype(np.int64), np.bincount(row, minlength=chunk.rows)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of 0/1 bytes as 64-bit words."""
    packed = np.packbits(bits, axis=1)
    fill = -packed.shape[1] % 8
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, fill)))).view(np.uint64)


def gain_planes(gains: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Two's complement planes of ``gains``, and the worth of a bit in each."""
    bits = max(int(np.abs(gains).max(initial=0)).bit_length(), 1) + 1
    planes = np.stack([(gains >> j) & 1 for j in range(bits)]).astype(np.uint8)
    return _packed(planes), [1 << j for j in range(bits - 1)] + [-(1 << (bits - 1))]


def gain_sums(
    row: np.ndarray, bucket: np.ndarray, rows: int, planes: np.ndarray, worth: list[int], buckets: int = BUCKETS
) -> np.ndarray:
    """Sum over the features of each row of their bucket's gain, from bit planes."""
    total = np.zeros(rows, dtype=np.int64)
    order = np.argsort(row, kind="stable")
    row, bucket = row[order], bucket[order]
    for low in range(0, rows, _ROWS):
        here = slice(*np.searchsorted(row, [low, low + _ROWS]))
        key, count = np.unique((row[here] - low) * buckets + bucket[here], return_counts=True)
        k = 0
        while len(key):
            set_ = key[(count >> k) & 1 == 1]
            if len(set_):
                # Only rows with a bit in this plane: high planes are those of few texts.
                held, place = np.unique(set_ // buckets, return_inverse=True)
                bits = np.zeros((len(held), buckets), dtype=np.uint8)
                bits[place, set_ % buckets] = 1
                plane = _packed(bits)
                for gain_plane, value in zip(planes, worth, strict=True):
                    ones = np.bitwise_count(plane & gain_plane).sum(axis=1, dtype=np.int64)
                    total[low + held] += ones * (value << k)
            k += 1
            more = count >> k > 0
            key, count = key[more], count[more]
    return total


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all ``texts`` fall into each bucket."""

    def run(batches):
        held = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                held += np.bincount(features(chunk, buckets)[1], minlength=buckets)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], names=["bucket", "n"])

    found = texts.select("text").mapInArrow(run, "bucket bigint, n bigint")
    counts = np.zeros(buckets, dtype=np.int64)
    for bucket, n in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[bucket] = n
    return counts


def gains_of(documents: np.ndarray, target: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Scaled log ratio of the smoothed shares in target and documents, rounded down."""
    all_documents, all_target = float(documents.sum() + buckets), float(target.sum() + buckets)
    return np.array(
        [
            math.floor(SCALE * math.log((t + 1.0) * all_documents / ((s + 1.0) * all_target)))
            for s, t in zip(documents.tolist(), target.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def weigh(documents: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    planes, worth = gain_planes(gains)
    buckets = len(gains)

    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                row, bucket, words = features(chunk, buckets)
                n = np.bincount(row, minlength=chunk.rows)
                weight = gain_sums(row, bucket, chunk.rows, planes, worth, buckets) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.rows), *map(pa.array, (words, n, weight))],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint"
    )


def _noise(doc_id: Column, seed: int) -> Column:
    """Scaled Gumbel noise from the hash of seed and id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def _ranked(scored: DataFrame, drawn: int) -> DataFrame:
    """Stored ``scored`` with its rank by score, id and n_features; null behind ``drawn``."""
    order = [F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("_row")]
    placed = store(
        scored.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_row")
        .withColumn("_slot", F.monotonically_increasing_id()),
        "resampling-order",
    )
    part = F.shiftright("_slot", _SLOT_BITS)
    # One row per range partition: bounded by the shuffle partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    rank = F.col("_start") + F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1)) + 1
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn("rank", F.when(rank <= drawn, rank).cast("bigint"))
        .drop("_part", "_slot", "_start")
    )


def resample(
    documents: DataFrame,
    target: DataFrame,
    share: int = SHARE,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``documents``.

    ``share`` percent of the documents of ``min_words`` or more are drawn by importance towards
    the texts of ``target``: those of the highest scores, weight plus noise. They have a rank
    from 1; the others' is null.
    """
    gains = gains_of(bucket_counts(documents), bucket_counts(target))
    weighed = weigh(documents, gains)
    scored = store(
        weighed.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed)), "resampling-scores"
    )
    eligible = scored.where(F.col("n_words") >= min_words)
    rest = scored.where(F.col("n_words") < min_words)
    ranked = _ranked(eligible, share * eligible.count() // 100)
    return ranked.unionByName(rest.withColumn("rank", F.lit(None).cast("bigint")))


@query(
    "op11_resampling",
    r"""
    WITH steps AS (
      SELECT list(c ORDER BY i) AS step FROM (
        SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)), lambda c, k:
          CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) AS r(i))
    ), texts AS (
      SELECT 'd' AS side, row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents
      UNION ALL SELECT 't', row_number() OVER (), NULL, coalesce(text, '') FROM benchmark
    ), cut AS (
      SELECT side, id, doc_id, regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts
    ), runs AS (
      SELECT side, id, unnest(list_concat(words, list_transform(range(1, len(words)),
        lambda k: words[k] || ' ' || words[k + 1]))) AS feature FROM cut
    ), counted AS (
      SELECT side, id, feature, count(*) AS n FROM runs GROUP BY ALL
    ), bytes AS (
      SELECT feature, list_transform(range(1, CAST(2 * octet_length(encode(feature)) AS BIGINT), 2),
        lambda k: CAST('0x' || substr(hex(encode(feature)), k, 2) AS BIGINT)) AS b
      FROM (SELECT DISTINCT feature FROM counted)
    ), hashed AS (
      SELECT feature, xor(list_reduce(list_prepend(4294967295, b), lambda c, x:
        xor(c >> 8, step[CAST(xor(c, x) % 256 AS BIGINT) + 1])), 4294967295) % 10000 AS bucket
      FROM bytes, steps
    ), placed AS (
      SELECT side, id, bucket, CAST(sum(n) AS BIGINT) AS n
      FROM counted JOIN hashed USING (feature) GROUP BY ALL
    ), sums AS (
      SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0) AS s,
        coalesce(sum(n) FILTER (WHERE side = 't'), 0) AS t FROM placed GROUP BY bucket
    ), totals AS (
      SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM sums
    ), gains AS (
      SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE))) AS BIGINT) AS gain FROM sums, totals
    ), weights AS (
      SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total
      FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
    ), scored AS (
      SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features,
        CASE WHEN n_features > 0 THEN (total - ((total % n_features) + n_features) % n_features)
          // n_features ELSE 0 END AS weight,
        CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
      FROM cut LEFT JOIN weights USING (id) WHERE side = 'd'
    ), noisy AS (
      SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM scored
    ), placed_rows AS (
      SELECT *, count(*) FILTER (WHERE n_words >= 20) OVER () AS eligible,
        row_number() OVER (PARTITION BY n_words >= 20
          ORDER BY score DESC, doc_id NULLS FIRST, n_features) AS place
      FROM noisy
    )
    SELECT doc_id, n_features, weight, score,
      CASE WHEN n_words >= 20 AND place <= 25 * eligible // 100 THEN place END AS rank
    FROM placed_rows
    """,
)
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")
