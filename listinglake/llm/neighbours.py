"""Approximate nearest neighbours by learned partitions.

Fit, on a sample of about ``SAMPLE`` vectors chosen by a hash of their id: its exact
neighbour graph is cut into parts of equal size (label exchange on the graph from balanced
seeds, so that neighbours fall together), and a small classifier, one hidden layer, learns
to name a vector's part. How many parts a query needs is calibrated on the sample: the
fewest with which ``RECALL`` of the sample's true neighbours share a probed part, with
half of the sample left out of the training to measure it. Parts grow with the rows, up to
what the sample can describe.

Index: every row goes to its most probable part. Search: each query goes to its most probable
parts and meets their rows in blocks of at most ``BLOCK`` rows and ``BLOCK`` queries, the
block of a row fixed by a hash of its id, so a hot part is many tasks and no task holds a
part. Inside a block one matrix product finds likely neighbours and exact cosines, computed
pair by pair from the original vectors, rank them, so equal vectors tie exactly. The best of
each block meet in one small ranking.

Vectors that are null or zero, hold null or non-finite components, or have another length
than the first usable length (the most frequent one) take no part, as queries or as
candidates; nor do rows of null id. Repeated rows of one id count as one candidate each, but
never for a query of their own id. Ties in score go to the smaller id. With at most ``k``
candidates all are returned. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listinglake.llm.tables import query, table
from listinglake.session import store

K = 5
EVERY = 50
SAMPLE = 4_096
GRAPH = 10
ROWS_A_PART = 4_096
LEAST_PARTS, MOST_PARTS = 8, 64
RECALL = 0.95
HIDDEN = 64
EPOCHS = 60
BLOCK = 2_048


class Index(NamedTuple):
    """The classifier: two layers over unit vectors, and the parts a query probes."""

    first: np.ndarray
    second: np.ndarray
    probes: int

    def logits(self, unit: np.ndarray) -> np.ndarray:
        hidden = np.maximum(_biased(unit) @ self.first, 0)
        return _biased(hidden) @ self.second


def _biased(rows: np.ndarray) -> np.ndarray:
    return np.hstack([rows, np.ones((len(rows), 1))])


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def neighbour_graph(rows: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` nearest other rows of each row, exactly, in blocks."""
    found = np.empty((len(rows), size), dtype=np.int64)
    for start in range(0, len(rows), 512):
        near = rows[start : start + 512] @ rows.T
        near[np.arange(len(near)), start + np.arange(len(near))] = -np.inf
        found[start : start + 512] = np.argpartition(-near, size - 1, axis=1)[:, :size]
    return found


def balanced_parts(rows: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """A part for each row: parts of equal size (by one row) with few graph edges between.

    Starts from halving by principal directions. Each round lets rows ask for the part most
    of their graph neighbours are in, strongest wish first, while the part has room.
    """
    label = np.zeros(len(rows), dtype=np.int64)
    groups = [(np.arange(len(rows)), parts)]
    number = 0
    while groups:
        mine, share = groups.pop()
        if share == 1:
            label[mine] = number
            number += 1
            continue
        centred = rows[mine] - rows[mine].mean(axis=0)
        _, _, axes = np.linalg.svd(centred[:1024], full_matrices=False)
        order = np.argsort(centred @ axes[0], kind="stable")
        left = share // 2
        cut = len(mine) * left // share
        groups += [(mine[order[:cut]], left), (mine[order[cut:]], share - left)]
    room = -(-len(rows) // parts)
    both = np.concatenate([np.repeat(np.arange(len(rows)), graph.shape[1]), graph.ravel()])
    ends = np.concatenate([graph.ravel(), np.repeat(np.arange(len(rows)), graph.shape[1])])
    for _ in range(rounds):
        votes = np.zeros((len(rows), parts))
        np.add.at(votes, (both, label[ends]), 1.0)
        here = votes[np.arange(len(rows)), label]
        wish, gain = votes.argmax(axis=1), votes.max(axis=1) - here
        size = np.bincount(label, minlength=parts)
        movers = np.flatnonzero(gain > 0)
        moved = 0
        # Two rows that wish to swap keep sizes; others move while there is room.
        waiting: dict[tuple[int, int], list[int]] = {}
        for row in movers[np.argsort(-gain[movers], kind="stable")]:
            source, target = int(label[row]), int(wish[row])
            partners = waiting.get((target, source))
            if size[target] < room:
                size[source] -= 1
                size[target] += 1
                label[row] = target
                moved += 1
            elif partners:
                other = partners.pop(0)
                label[row], label[other] = target, source
                moved += 2
            else:
                waiting.setdefault((source, target), []).append(int(row))
        if not moved:
            break
    return label


def train(rows: np.ndarray, label: np.ndarray, parts: int, seed: int = 5) -> Index:
    """Softmax classifier with one hidden layer, by Adam over blocks."""
    random = np.random.default_rng(seed)
    width = rows.shape[1]
    layers = [
        random.normal(0, (2 / width) ** 0.5, (width + 1, HIDDEN)),
        random.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN + 1, parts)),
    ]
    mean, power = [0 * x for x in layers], [0 * x for x in layers]
    step = 0
    for _ in range(EPOCHS):
        for block in np.array_split(random.permutation(len(rows)), len(rows) // 128 + 1):
            step += 1
            entry = _biased(rows[block])
            raw = entry @ layers[0]
            hidden = _biased(np.maximum(raw, 0))
            logits = hidden @ layers[1]
            chance = np.exp(logits - logits.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            chance[np.arange(len(block)), label[block]] -= 1
            chance /= len(block)
            back = (chance @ layers[1][:-1].T) * (raw > 0)
            for number, slope in enumerate((entry.T @ back, hidden.T @ chance)):
                slope = slope + 1e-4 * layers[number]
                mean[number] = 0.9 * mean[number] + 0.1 * slope
                power[number] = 0.999 * power[number] + 0.001 * slope * slope
                layers[number] -= (
                    0.003
                    * (mean[number] / (1 - 0.9**step))
                    / (np.sqrt(power[number] / (1 - 0.999**step)) + 1e-8)
                )
    return Index(layers[0], layers[1], parts)


def fit(sample: np.ndarray, parts: int, k: int = K, recall: float = RECALL) -> Index:
    """The index over a sample; with too few rows to cut, one part that holds all."""
    rows = unit(sample.astype(float))
    size = min(GRAPH, len(rows) - 1)
    if size < 1 or len(rows) < 4 * parts:
        return Index(np.zeros((rows.shape[1] + 1, 1)), np.zeros((2, 1)), 1)
    graph = neighbour_graph(rows, size)
    label = balanced_parts(rows, graph, parts)
    # Even rows train; how odd rows fare tells how many parts unseen queries need.
    half = train(rows[::2], label[::2], parts)
    logits = half.logits(rows)
    home = logits.argmax(axis=1)
    odd = np.arange(1, len(rows), 2)
    order = np.argsort(-logits[odd], axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], axis=1)
    true = neighbour_graph(rows, min(k, len(rows) - 1))[odd]
    needed = np.take_along_axis(place, home[true], axis=1) + 1
    enough = [np.mean(needed <= probes) >= recall for probes in range(1, parts + 1)]
    return train(rows, label, parts)._replace(probes=1 + int(np.argmax(enough)))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part; vectors as doubles."""
    vector = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", vector.alias("vector")).where(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & (F.size("vector") > 0)
        & ~F.exists(
            "vector",
            lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")),
        )
        & F.exists("vector", lambda x: x != 0)
    )
    widths = rows.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("rows"))
    width = widths.orderBy(F.desc("rows"), "width").first()
    return rows.where(F.size("vector") == (width["width"] if width else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def build(rows: DataFrame, sample: int = SAMPLE) -> Index | None:
    """Fit on about ``sample`` rows by the hash of their id, in one task; None without rows."""
    count = rows.count()
    if not count:
        return None
    share = min(1.0, sample / count)
    parts = int(np.clip(count // ROWS_A_PART, LEAST_PARTS, MOST_PARTS))

    def run(batches):
        blocks = [_matrix(batch.column("vector")) for batch in batches if batch.num_rows]
        if blocks:
            index = fit(np.concatenate(blocks), parts)
            for number, layer in enumerate(index[:2]):
                yield pa.RecordBatch.from_pydict(
                    {
                        "layer": pa.array([number], pa.int32()),
                        "rows": pa.array([len(layer)], pa.int32()),
                        "probes": pa.array([index.probes], pa.int32()),
                        "weights": pa.array([layer.ravel().tolist()], pa.list_(pa.float64())),
                    }
                )

    picked = rows.withColumn("key", F.xxhash64("vec_id")).where(
        F.pmod("key", F.lit(1 << 30)) < int(share * (1 << 30))
    )
    layers = (
        picked.repartition(1)
        .sortWithinPartitions("key")
        .select("vector")
        .mapInArrow(run, "layer int, rows int, probes int, weights array<double>")
        .orderBy("layer")
        .collect()
    )
    if not layers:
        return None
    first, second = (np.array(x["weights"]).reshape(x["rows"], -1) for x in layers)
    return Index(first, second, layers[0]["probes"])


def routed(rows: DataFrame, index: Index, probes: int) -> DataFrame:
    """(vec_id, vector, part): one row for each of the ``probes`` most probable parts."""
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            logits = shared.value.logits(unit(_matrix(batch.column("vector"))))
            order = np.argsort(-logits, axis=1, kind="stable")[:, :probes]
            for column in range(order.shape[1]):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(order[:, column].astype(np.int32))],
                    names=["vec_id", "vector", "part"],
                )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, vector array<double>, part int")


def _blocks(frame: DataFrame, name: str) -> DataFrame:
    """Sizes of the parts as numbers of blocks of ``BLOCK`` rows: one small row a part."""
    size = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int")
    return frame.groupBy("part").agg(size.alias(name))


def _best(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best rows of one block for each of its queries, by exact cosine."""
    found = []
    if len(queries) and len(rows):
        asked, held = np.stack(queries["vector"]), np.stack(rows["vector"])
        ask_id, row_id = queries["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
        near = unit(asked) @ unit(held).T
        near[ask_id[:, None] == row_id[None, :]] = -np.inf
        size = min(k, near.shape[1])
        # The product only nominates; rounding cannot part what is equal within 1e-9.
        floor = -np.partition(-near, size - 1, axis=1)[:, size - 1] - 1e-9
        one, two = np.nonzero((near >= floor[:, None]) & np.isfinite(near))
        for start in range(0, len(one), 65_536):
            a, b = one[start : start + 65_536], two[start : start + 65_536]
            x, y = asked[a], held[b]
            norms = np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))
            found.append(
                pd.DataFrame(
                    {"query_id": ask_id[a], "vec_id": row_id[b], "score": (x * y).sum(axis=1) / norms}
                )
            )
    if not found:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    every = pd.concat(found).sort_values(
        ["query_id", "score", "vec_id"], ascending=[True, False, True], kind="stable"
    )
    return every.groupby("query_id", sort=False).head(k)


def search(rows: DataFrame, queries: DataFrame, index: Index, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query row."""
    held = store(routed(rows, index, 1), "parts")
    asked = store(routed(queries.distinct(), index, index.probes), "routes")
    # One row a part, at most MOST_PARTS: a proven size.
    sizes = F.broadcast(_blocks(held, "row_blocks").join(_blocks(asked, "query_blocks"), "part"))

    def spread(frame: DataFrame, own: str, other: str) -> DataFrame:
        spot = F.pmod(F.xxhash64("vec_id"), F.col(f"{own}_blocks")).cast("int")
        return (
            frame.join(sizes, "part")
            .withColumn(f"{own}_block", spot)
            .withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
            .select("part", "row_block", "query_block", "vec_id", "vector")
        )

    keys = ["part", "row_block", "query_block"]
    kind = rows.schema["vec_id"].dataType.simpleString()
    best = (
        spread(asked, "query", "row")
        .groupBy(*keys)
        .cogroup(spread(held, "row", "query").groupBy(*keys))
        .applyInPandas(
            lambda one, two: _best(one, two, k),
            f"query_id {kind}, vec_id {kind}, score double",
        )
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """Neighbours of the rows whose id is divisible by ``every``, among all rows."""
    rows = store(usable(vectors), "vectors")
    index = build(rows)
    if index is None:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame(
            [], f"query_id {kind}, rank int, vec_id {kind}, score double"
        )
    return search(rows, rows.where(F.col("vec_id") % every == 0), index, k)


@query("op6_neighbours")
def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings")).select(
        F.col("query_id").cast("bigint"),
        F.col("rank").cast("int"),
        F.col("vec_id").cast("bigint"),
        "score",
    )
