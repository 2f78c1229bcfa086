"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal training.

* Features. A text is cut into word runs and symbol runs. A token equal to the one before
  it becomes one shared "repeat" token, so that stuttering shows whatever word stutters.
  Single tokens and pairs of neighbours hash into ``BUCKETS`` slots; a feature's value is
  ``SCALE * count / n_grams of the text``, so long and short texts compare.
* Training. Follow-the-regularised-leader updates over a sample of at most about
  ``TRAIN_ROWS`` labelled texts, chosen by a hash of their id. Feature extraction is
  distributed; the updates, which depend on each other, run in one task over the bounded
  sample and give at most ``BUCKETS + 1`` weights.
* Scoring. One map over all texts: a sparse dot product with the broadcast weights (at
  most 2 MiB at any input size). No shuffle.

Null and empty texts have no n-grams and score the intercept. Null ids are scored too and
are never held out. Labels that are null, or whose id is null, are left out; several
labels of one id vote (ties count as 1). Without any usable label every score is 0.5.
Repeated rows are scored each. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm import words
from listinglake.llm.tables import first_of_key, in_share, query, table

BUCKETS = 1 << 18
SCALE = 20.0
TRAIN_ROWS = 6_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.05, 0.5
THRESHOLD = 0.3
#: Every fifth id, by checksum, is held out of training.
HELD_OUT_FOLDS = 5
_LETTERS = bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
#: 0 white space, 1 letters, digits and all non-ASCII, 2 symbols.
_CLASSES = words.byte_classes(words.SPACES, _LETTERS, rest=2)
_REPEAT = np.uint64(0x5EED5EED5EED5EED)
_SHIFT = np.uint64(64 - 18)


def grams(chunk: words.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of every single token and token pair of the chunk's rows."""
    found = words.words(chunk, _CLASSES)
    token = found.hash.copy()
    together = found.row[1:] == found.row[:-1]
    token[1:][together & (found.hash[1:] == found.hash[:-1])] = _REPEAT
    pairs = words.joined(token, 2)[together]
    row = np.concatenate([found.row, found.row[1:][together]])
    slot = np.concatenate([words.mix(token), pairs]) >> _SHIFT
    return row, slot.astype(np.int64)


def held_out(doc_id: str = "doc_id") -> Column:
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT_FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def _extract(batches):
    """(key, label, text) to (key, label, slots, counts); equal rows of a partition come once."""
    for batch in first_of_key(batches):
        for chunk in words.chunks(batch.column("text")):
            row, slot = grams(chunk)
            both, count = np.unique(row * BUCKETS + slot, return_counts=True)
            bounds = np.searchsorted(both, np.arange(chunk.rows + 1) * BUCKETS)
            ends = pa.array(bounds.astype(np.int32))
            part = batch.slice(chunk.first, chunk.rows)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key"),
                    part.column("label"),
                    pa.ListArray.from_arrays(ends, pa.array((both % BUCKETS).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int32))),
                ],
                names=["key", "label", "slots", "counts"],
            )


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights after FTRL-proximal updates over (slots, values, label); last is the intercept."""
    z, squares = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(slots):
        held = z[slots]
        shrunk = np.sign(held) * np.maximum(np.abs(held) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(squares[slots])) / ALPHA + L2)

    for _ in range(epochs):
        for slots, values, label in examples:
            now = weights(slots)
            chance = 1.0 / (1.0 + np.exp(-np.clip(now @ values, -35, 35)))
            slope = (chance - label) * values
            root = np.sqrt(squares[slots])
            squares[slots] += slope * slope
            z[slots] += slope - (np.sqrt(squares[slots]) - root) / ALPHA * now
    return weights(np.arange(BUCKETS + 1))


def _train(batches):
    """One task over the sample, in key order: (slot, weight) of all weights but zeros."""
    examples = []
    for batch in first_of_key(batches):
        label = batch.column("label").to_numpy(zero_copy_only=False)
        for number in range(batch.num_rows):
            slots = np.asarray(batch.column("slots")[number].values, dtype=np.int64)
            counts = np.asarray(batch.column("counts")[number].values, dtype=float)
            values = SCALE * counts / max(counts.sum(), 1.0)
            examples.append((np.append(slots, BUCKETS), np.append(values, 1.0), label[number]))
    trained = ftrl(examples)
    slots = np.flatnonzero(trained)
    yield pa.RecordBatch.from_arrays(
        [pa.array(slots.astype(np.int32)), pa.array(trained[slots])], names=["slot", "weight"]
    )


def train(
    documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, label: str = "quality"
) -> np.ndarray:
    """Weights learned from about ``rows`` labelled texts outside the held-out fold."""
    usable = (
        labels.select("doc_id", F.col(label).cast("double").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("double").alias("label"))
        .withColumn("key", F.xxhash64("doc_id"))
    )
    share = min(1.0, rows / max(usable.count(), 1))
    # Hash order is random order, so this keeps about `rows` ids at any input size.
    sample = usable.where(in_share(F.col("key"), share)).drop("key")
    labelled = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").where("text IS NOT NULL")
    # An id can have many rows: they are drawn in turn, and equal ones count once.
    share = min(1.0, rows / max(labelled.select("doc_id").count(), 1))
    drawn = labelled.withColumn("key", F.xxhash64("doc_id", "text")).where(in_share(F.col("key"), share))
    examples = drawn.select("key", "label", "text").mapInArrow(
        _extract, "key bigint, label double, slots array<int>, counts array<int>"
    )
    learned = (
        examples.repartition(1)
        .sortWithinPartitions("key")
        .mapInArrow(_train, "slot int, weight double")
        .collect()
    )
    weights = np.zeros(BUCKETS + 1)
    for slot, weight in learned:
        weights[slot] = weight
    return weights


def text_scores(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    scores = np.empty(len(column))
    for chunk in words.chunks(column):
        row, slot = grams(chunk)
        total = np.bincount(row, weights=weights[slot], minlength=chunk.rows)
        count = np.maximum(np.bincount(row, minlength=chunk.rows), 1)
        logit = np.clip(weights[BUCKETS] + SCALE * total / count, -35, 35)
        scores[chunk.first : chunk.first + chunk.rows] = 1.0 / (1.0 + np.exp(-logit))
    return scores


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``documents``."""
    shared = documents.sparkSession.sparkContext.broadcast(train(documents, labels))

    def run(batches):
        for batch in batches:
            scores = pa.array(text_scores(batch.column("text"), shared.value))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), scores], names=["doc_id", "score"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return (
        documents.select("doc_id", "text")
        .mapInArrow(run, f"doc_id {kind}, score double")
        .select(
            "doc_id",
            held_out().alias("held_out"),
            "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        )
    )


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents``, as they are, that the classifier does not reject."""
    shared = documents.sparkSession.sparkContext.broadcast(train(documents, labels))

    def run(batches):
        for batch in batches:
            scores = text_scores(batch.column("text"), shared.value)
            yield batch.filter(pa.array(scores >= THRESHOLD))

    return documents.mapInArrow(run, documents.schema)


@query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
