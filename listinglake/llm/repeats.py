"""Removal of repeated passages by relative Lempel-Ziv parsing.

A window is ``WINDOW`` consecutive words of one text. Each word goes that lies in a window whose
words also start in a document of smaller id. Windows are judged on the input.

1. *Anchors.* Each window names one run of ``SEED`` words inside it, the one of the least hash
   (the leftmost of equals). Equal windows name it at the same place, and neighbours mostly share
   it, so about one word in eighteen starts an anchor.
2. *Reference blocks.* The first occurrence of an anchor, by (doc_id, text, place), lies in a
   block of ``BLOCK`` words of its text, with margins that hold every window around it. Blocks of
   first occurrences of shared anchors are the reference; each is indexed by a suffix automaton.
3. *Parsing.* Stretches of documents that share anchors with a block are factored greedily against
   it: every factor is the longest match that goes on from the last one. Factors of ``WINDOW``
   words or more are repeated. A shorter match can only lie across one border of two factors, as
   the second would else have gone on, so windows across a border are looked up in the automaton.
   Words are compared themselves, not by hashes.
4. *Rest.* A window that is not in its anchor's block can still be in another text, or elsewhere in
   the first one, where it is then not in that block either. These windows alone are compared with
   each other, by 128-bit digests and the least id of each. So no link is lost, and no group is paired.

Texts move only where they share an anchor: a Bloom filter of bounded size rules out most others
before a join. Stretches and blocks are bounded pieces, so one long text spreads over tasks, and
a block that many documents ask for is joined with salts. Lookup sides are broadcast only after
their size is measured.

Null and empty texts have no words. Rows of a null id neither lose words nor make others lose
them. Rows of one id never make each other lose words; equal rows lose the same. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.tables import query, table
from listinglake.llm.words import chunks, mix, words
from listinglake.operators import bloom
from listinglake.operators.skew import hot_keys, lookup_join, measured_bytes, spread_join
from listinglake.session import store

WINDOW = 50
#: Words of an anchor: a power of two.
SEED = 16
#: Words of a block without its margins.
BLOCK = 512
#: Places that an anchor can have in its window.
_PLACES = WINDOW - SEED + 1
#: A block or anchor asked for more often than this is joined with salts.
_HOT = 5_000
_KEPT_BLOCKS = 64
_ROW = ["doc_id", "text_key"]
_REF = ["ref_id", "ref_key", "ref_number"]
#: Helper tables are broadcast up to so many measured bytes, and else joined by a shuffle.
SMALL = 4 * 1024 * 1024


def window_anchors(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, anchor) of each window within a row, as word numbers, and the hash of every run of SEED words."""
    none = np.empty(0, np.int64)
    if len(hashes) < WINDOW:
        return none, none, np.empty(0, np.uint64)
    runs, size = hashes, 1
    while size < SEED:
        runs = mix(runs[:-size]) + runs[size:]
        size *= 2
    runs = mix(runs)
    place = np.lib.stride_tricks.sliding_window_view(runs, _PLACES).argmin(axis=1)
    start = np.flatnonzero(row[: len(place)] == row[WINDOW - 1 :])
    return start, start + place[start], runs


def piece_start(number: int) -> int:
    """First word of block ``number`` with its margin."""
    return max(0, number * BLOCK - (_PLACES - 1))


class Block:
    """Suffix automaton over the words of a reference block."""

    def __init__(self, block: list[bytes]) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for word in block:
            last = self._extend(last, word)

    def _state(self, following: dict[bytes, int], link: int, length: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _extend(self, last: int, word: bytes) -> int:
        following, link, length = self.next, self.link, self.length
        new = self._state({}, 0, length[last] + 1)
        at = last
        while at >= 0 and word not in following[at]:
            following[at][word] = new
            at = link[at]
        if at < 0:
            return new
        known = following[at][word]
        if length[known] != length[at] + 1:
            twin = self._state(dict(following[known]), link[known], length[at] + 1)
            link[known] = twin
            while at >= 0 and following[at].get(word) == known:
                following[at][word] = twin
                at = link[at]
            known = twin
        link[new] = known
        return new

    def factors(self, text: list[bytes]) -> list[int]:
        """Ends of the greedy factors of ``text``; a word the block lacks is one of its own."""
        following, state, ends = self.next, 0, []
        for at, word in enumerate(text):
            then = following[state].get(word)
            if then is None and state:
                ends.append(at)
                then = following[0].get(word)
            if then is None:
                ends.append(at + 1)
                then = 0
            state = then
        if state:
            ends.append(len(text))
        return ends

    def _across(self, text: list[bytes], low: int, high: int) -> list[int]:
        """Starts of the windows within ``text[low:high]`` that the block holds."""
        following, state, size, found = self.next, 0, 0, []
        for at in range(low, high):
            word = text[at]
            while state and word not in following[state]:
                state = self.link[state]
                size = self.length[state]
            if word in following[state]:
                state = following[state][word]
                size += 1
            if size >= WINDOW:
                found.append(at + 1 - WINDOW)
        return found

    def windows(self, text: list[bytes]) -> np.ndarray:
        """For each window start of ``text``, whether the block holds the window."""
        held = np.zeros(max(0, len(text) - WINDOW + 1), dtype=bool)
        ends = self.factors(text)
        bounds = [0, *ends]
        for number, (start, end) in enumerate(zip(bounds, ends, strict=False)):
            if end - start >= WINDOW:
                held[start : end - WINDOW + 1] = True
            if number + 1 < len(ends):
                low, high = max(start, end - WINDOW + 1), min(ends[number + 1], end + WINDOW - 1)
                if high - low >= WINDOW:
                    held[self._across(text, low, high)] = True
        return held


class _Blocks:
    """The automata of the blocks used last."""

    def __init__(self) -> None:
        self.kept: OrderedDict[bytes, Block] = OrderedDict()

    def windows(self, block: bytes, text: bytes) -> np.ndarray:
        split = text.split(b" ")
        if block == text:
            return np.ones(max(0, len(split) - WINDOW + 1), dtype=bool)
        if block in self.kept:
            self.kept.move_to_end(block)
        else:
            self.kept[block] = Block(block.split(b" "))
            if len(self.kept) > _KEPT_BLOCKS:
                self.kept.popitem(last=False)
        return self.kept[block].windows(split)


def _anchors(texts: DataFrame) -> DataFrame:
    """(doc_id, text_key, place, anchor) of the anchors of every text."""

    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                found = words(chunk)
                _, anchor, runs = window_anchors(found.hash, found.row)
                anchor = np.unique(anchor)
                row = found.row[anchor]
                place = anchor - np.searchsorted(found.row, row)
                rows = pa.array(chunk.first + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(place.astype(np.int32)),
                        pa.array(runs[anchor].view(np.int64)),
                    ],
                    names=["doc_id", "text_key", "place", "anchor"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, text_key bigint, place int, anchor bigint")


def _requests(anchors: DataFrame) -> DataFrame:
    """(doc_id, text_key, number, ref_id, ref_key, ref_number, places): piece and block to parse it by.

    A piece asks for each block that holds the first occurrence of one of its anchors, if the
    anchor occurs in documents of several ids. Other places of the first document ask too: their
    windows may be in later documents and not in the block. Equal rows ask once.
    """
    first = F.min(F.struct("doc_id", "text_key", "place"))
    shared = (
        anchors.groupBy("anchor")
        .agg(first.alias("first"), F.max("doc_id").alias("last"))
        .where("first.doc_id < last")
        .select(
            "anchor",
            F.col("first.doc_id").alias("ref_id"),
            F.col("first.text_key").alias("ref_key"),
            F.col("first.place").alias("ref_place"),
        )
    )
    shared = store(shared, "repeat-shared")

    def number(place: str) -> Column:
        return F.floor(F.col(place) / BLOCK).cast("int")

    return (
        lookup_join(anchors, shared, "anchor", "inner", SMALL, _HOT)
        .where("doc_id > ref_id OR text_key <> ref_key OR place <> ref_place")
        .groupBy(*_ROW, number("place").alias("number"), "ref_id", "ref_key", number("ref_place").alias("ref_number"))
        .agg(F.collect_set("place").alias("places"))
    )


def _cut(texts: DataFrame, requests: DataFrame) -> DataFrame:
    """(doc_id, text_key, number, places, ref_id, ref_key, ref_number, piece): each request with
    its piece, and each block it asks for, which has no ``places``.

    A text is read once for both. Only texts that a bounded filter cannot rule out move.
    """
    block = F.struct("ref_id", "ref_key", "ref_number")
    asks = requests.groupBy(*_ROW).agg(F.collect_list(F.struct("number", "places", *_REF)).alias("asks"))
    blocks = requests.select(block.alias("_block")).distinct().select("_block.*").toDF(*_ROW, "number")
    held = blocks.groupBy(*_ROW).agg(F.collect_list("number").alias("blocks"))
    wanted = store(asks.join(held, _ROW, "full"), "repeat-wanted")
    likely = bloom.marked(texts, wanted, _ROW).where("_maybe").select(*_ROW, "text")
    rows = lookup_join(likely, wanted, _ROW, "inner", SMALL, _HOT)

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, key, text, asks, blocks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                split = text.encode().split()

                def piece(number, split=split):
                    return b" ".join(split[piece_start(number) : (number + 1) * BLOCK + WINDOW - 1])

                for ask in asks or ():
                    out.append({"doc_id": doc_id, "text_key": key, **ask, "piece": piece(ask["number"])})
                for number in blocks or ():
                    out.append({"ref_id": doc_id, "ref_key": key, "ref_number": number, "piece": piece(number)})
            schema = pa.schema(
                [
                    ("doc_id", batch.column(0).type),
                    ("text_key", pa.int64()),
                    ("number", pa.int32()),
                    ("places", pa.list_(pa.int32())),
                    ("ref_id", batch.column(0).type),
                    ("ref_key", pa.int64()),
                    ("ref_number", pa.int32()),
                    ("piece", pa.binary()),
                ]
            )
            yield pa.RecordBatch.from_pylist(out, schema)

    kind = texts.schema["doc_id"].dataType.simpleString()
    return rows.select(*_ROW, "text", "asks", "blocks").mapInArrow(
        run,
        f"doc_id {kind}, text_key bigint, number int, places array<int>, "
        f"ref_id {kind}, ref_key bigint, ref_number int, piece binary",
    )


def _parsed(cut: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, stop, digest) of repeated words, and of windows left open by their digest."""
    requests = cut.where("places IS NOT NULL")
    # Equal rows give equal blocks.
    blocks = cut.where("places IS NULL").select(*_REF, F.col("piece").alias("block"))
    blocks = store(blocks.dropDuplicates(_REF), "repeat-blocks")
    if measured_bytes(blocks) <= SMALL:
        both = requests.join(F.broadcast(blocks), _REF)
    else:
        hot = hot_keys(requests.select(*_REF), _REF, rows=_HOT)
        both = spread_join(requests, blocks, _REF, "inner", hot, spread_by=_ROW)

    def run(batches):
        known = _Blocks()
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            numbers, places, texts, blocks, later = (batch.column(k).to_pylist() for k in range(2, 7))
            for chunk in chunks(batch.column(4).cast(pa.string())):
                found = words(chunk)
                start, anchor, _ = window_anchors(found.hash, found.row)
                first = np.searchsorted(found.row, np.arange(chunk.rows))
                mine = np.searchsorted(found.row[start], np.arange(chunk.rows + 1))
                out = []
                for row in range(chunk.rows):
                    at = chunk.first + row
                    begin, here = piece_start(numbers[at]), slice(mine[row], mine[row + 1])
                    held = known.windows(blocks[at], texts[at])
                    edges = np.flatnonzero(np.diff(held, prepend=False, append=False)) if later[at] else ()
                    for low, high in zip(edges[0::2], edges[1::2], strict=True):
                        out.append((at, begin + low, begin + high - 1 + WINDOW, None))
                    asked = np.isin(anchor[here] - first[row] + begin, places[at])
                    left = (start[here] - first[row])[asked & ~held[start[here] - first[row]]]
                    text = texts[at]
                    for window in left.tolist():
                        word = first[row] + window
                        low = found.start[word] - chunk.offsets[row]
                        high = found.stop[word + WINDOW - 1] - chunk.offsets[row]
                        digest = hashlib.blake2b(text[low:high], digest_size=16).digest()
                        out.append((at, begin + window, begin + window + WINDOW, digest))
                if not out:
                    continue
                rows, starts, stops, digests = zip(*out, strict=True)
                rows = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(rows),
                        keys.take(rows),
                        pa.array(starts, pa.int32()),
                        pa.array(stops, pa.int32()),
                        pa.array(digests, pa.binary()),
                    ],
                    names=[*_ROW, "start", "stop", "digest"],
                )

    kind = cut.schema["doc_id"].dataType.simpleString()
    later = (F.col("doc_id") > F.col("ref_id")).alias("later")
    return both.select(*_ROW, "number", "places", "piece", "block", later).mapInArrow(
        run, f"doc_id {kind}, text_key bigint, start int, stop int, digest binary"
    )


def repeated_spans(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans) of rows with repeated words: spans are (start, stop) in words.

    Spans may overlap. ``text_key`` is xxhash64 of the text; equal rows have one entry.
    """
    texts = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("text_key"), "text"
    )
    requests = store(_requests(store(_anchors(texts), "repeat-anchors")), "repeat-requests")
    parsed = store(_parsed(store(_cut(texts, requests), "repeat-pieces")), "repeat-parsed")
    left = parsed.where("digest IS NOT NULL")
    firsts = (
        left.groupBy("digest")
        .agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
        .where("_first < _last")
        .drop("_last")
    )
    late = lookup_join(left, store(firsts, "repeat-rest"), "digest", "inner", SMALL, _HOT).where("doc_id > _first")
    spans = [*_ROW, "start", "stop"]
    every = parsed.where("digest IS NULL").select(*spans).union(late.select(*spans))
    return store(every.groupBy(*_ROW).agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "repeat-spans")


def remove_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) of every row; ``kept`` joins the kept words by one space.

    ``spans`` are the removed runs of words as (start, stop), in order.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select("doc_id", F.xxhash64("text").alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    spans = repeated_spans(documents)
    # Texts that cannot have spans stay where they are.
    likely = bloom.marked(texts, spans, _ROW)
    rows = lookup_join(likely.where("_maybe"), spans, _ROW, "left", SMALL, _HOT).select("doc_id", "text", "spans")
    rest = likely.where("NOT _maybe").select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))

    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                split = text.encode().split()
                runs: list[list[int]] = []
                for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
                    if runs and start <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], stop)
                    else:
                        runs.append([start, stop])
                kept, at = [], 0
                for start, stop in [*runs, (len(split), len(split))]:
                    kept += split[at:start]
                    at = stop
                cut = [{"start": start, "stop": stop} for start, stop in runs]
                out.append((len(split), len(split) - len(kept), cut, b" ".join(kept).decode()))
            columns = list(zip(*out, strict=True)) or [()] * 4
            span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            kinds = (pa.int64(), pa.int64(), span, pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    return rows.union(rest).mapInArrow(
        run, f"doc_id {kind}, n_words bigint, n_removed bigint, spans array<struct<start:int,stop:int>>, kept string"
    )


@query(
    "op13_repeats",
    r"""
    WITH cut AS (
      SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), placed AS (
      SELECT r, doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM cut
    ), windows AS (
      SELECT r, doc_id, p, count(*) OVER w AS n, md5(string_agg(word, ' ') OVER w) AS k
      FROM placed WINDOW w AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
    ), firsts AS (
      SELECT k, min(doc_id) AS first FROM windows WHERE n = 50 GROUP BY k
    ), gone AS (
      SELECT DISTINCT r, unnest(range(p, p + 50)) AS p
      FROM windows JOIN firsts USING (k) WHERE n = 50 AND first < doc_id
    ), kept AS (
      SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
      FROM placed ANTI JOIN gone USING (r, p) GROUP BY r
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
      CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM cut LEFT JOIN kept USING (r)
    """,
)
def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = remove_repeats(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
