"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton of the vocabulary enumerates all pieces of a text. Going through
their ends, dynamic programming keeps the best score of each prefix and the number of pieces
on its path, and nothing else: no lattice and no back pointers. Ties follow the tokenizer:
of equally good paths to a place the one whose last piece starts first (is longest) stays. A
character without a piece of its own may also be unknown, at the lowest score less
``UNKNOWN_PENALTY``, and then counts one piece for each of its bytes (byte fallback).

White space as the tokenizer sees it: one blank is put before the text, each blank becomes
the mark U+2581. No piece holds a mark behind another character (checked when the vocabulary
is read), so every path cuts before such a mark and words can be counted by themselves; their
counts are kept in a dictionary of bounded size. New words go through the automaton together
and their tables advance side by side, one place at a time. A vocabulary for which the cut
does not hold is searched over whole texts. Scores add up in double precision.

The vocabulary file is read once, on the driver, and broadcast: its size is fixed by the
tokenizer. One map over whole texts, no shuffle. Null and empty texts have 0 tokens. Null ids
and repeated rows are counted each. Extra columns are ignored.
"""

from __future__ import annotations

import re
from itertools import chain
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from listinglake.llm.tables import query, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Word counts kept at a time, and the longest word that is kept.
KEPT_WORDS, KEPT_LENGTH = 400_000, 48
#: Characters of text whose words are looked up together.
TOGETHER = 1 << 20
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Vocabulary(NamedTuple):
    pieces: list[tuple[str, float]]
    """Pieces that text can match, with their scores; no control or byte pieces."""
    lowest: float

    @property
    def by_word(self) -> bool:
        return not any(MARK in piece.lstrip(MARK) for piece, _ in self.pieces)


def read_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_byte)
    pieces = [
        (model.id_to_piece(number), model.get_score(number))
        for number in range(model.get_piece_size())
        if not any(test(number) for test in special)
    ]
    return Vocabulary(pieces, min(score for _, score in pieces))


class Counter:
    """Counts pieces; keeps the counts of short words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.by_word = vocabulary.by_word
        self.unknown = vocabulary.lowest - UNKNOWN_PENALTY
        self.lengths = np.array([len(piece) for piece, _ in vocabulary.pieces])
        self.scores = np.array([score for _, score in vocabulary.pieces])
        self.automaton = ahocorasick.Automaton()
        for number, (piece, _) in enumerate(vocabulary.pieces):
            self.automaton.add_word(piece, number)
        self.automaton.make_automaton()
        self.kept: dict[str, int] = {}

    def pieces(self, text: str) -> int:
        """Pieces on the best path over ``text``, marks already in place."""
        scores, counts = [0.0], [0]
        ends = [[] for _ in text]
        for end, number in self.automaton.iter(text):
            ends[end].append((int(self.lengths[number]), float(self.scores[number])))
        for at, found in enumerate(ends):
            best, count, alone = None, 0, False
            # Longest first, so the earliest start; only a better score replaces it.
            for length, score in found:
                value = scores[at + 1 - length] + score
                if best is None or value > best:
                    best, count = value, counts[at + 1 - length] + 1
                alone = alone or length == 1
            if not alone:
                value = scores[at] + self.unknown
                if best is None or value > best:
                    best = value
                    count = counts[at] + len(text[at].encode("utf-8", "surrogatepass"))
            scores.append(best)
            counts.append(count)
        return counts[-1]

    def pieces_of_all(self, words: list[str]) -> np.ndarray:
        """As ``pieces`` for each of many short words."""
        # No piece holds the separator, so no match crosses it.
        joined = "\0".join(words)
        size = np.array([len(word) for word in words])
        start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        found = np.fromiter(chain.from_iterable(self.automaton.iter(joined)), np.int64)
        end, number = found[0::2], found[1::2]
        length, score = self.lengths[number], self.scores[number]
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lone = np.ones(len(code), dtype=bool)
        lone[end[length == 1]] = False
        lone[start[1:] - 1] = False
        unknown = np.flatnonzero(lone)
        bytes_ = 1 + sum((code[unknown] >= bound).astype(np.int64) for bound in (0x80, 0x800, 0x10000))
        end = np.concatenate([end, unknown])
        length = np.concatenate([length, np.ones(len(unknown), np.int64)])
        score = np.concatenate([score, np.full(len(unknown), self.unknown)])
        worth = np.concatenate([np.ones(len(number), np.int64), bytes_])
        word = np.searchsorted(start, end, side="right") - 1
        place = end - start[word]
        order = np.lexsort((-length, word, place))
        word, place, length, score, worth = (x[order] for x in (word, place, length, score, worth))
        best = np.full((len(words), size.max() + 1), -np.inf)
        count = np.zeros(best.shape, dtype=np.int64)
        best[:, 0] = 0
        bounds = np.searchsorted(place, np.arange(size.max() + 1))
        for at in range(size.max()):
            here = slice(bounds[at], bounds[at + 1])
            mine, since = word[here], at + 1 - length[here]
            value = best[mine, since] + score[here]
            fresh = np.concatenate([[True], mine[1:] != mine[:-1]])
            heads = np.flatnonzero(fresh)
            top = np.maximum.reduceat(value, heads)
            group = np.cumsum(fresh) - 1
            ties = np.flatnonzero(value == top[group])
            # The first of the best is the longest piece.
            first = ties[np.unique(group[ties], return_index=True)[1]]
            best[mine[heads], at + 1] = top
            count[mine[heads], at + 1] = count[mine[first], since[first]] + worth[here][first]
        return count[np.arange(len(words)), size]

    def _chunks(self, text: str) -> list[str]:
        """Runs of marks, each with the characters up to the next mark."""
        marked = MARK + text.replace(" ", MARK)
        if not self.by_word:
            return [marked]
        if MARK + MARK in marked or marked[-1] == MARK:
            return _CHUNK.findall(marked)
        return [MARK + word for word in marked[1:].split(MARK)]

    def counts(self, texts: list[str | None]) -> list[int]:
        result: list[int] = []
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and size < TOGETHER:
                size += len(texts[stop] or "")
                stop += 1
            result += self._counts([self._chunks(t) if t else [] for t in texts[start:stop]])
            start = stop
        return result

    def _counts(self, texts: list[list[str]]) -> list[int]:
        if len(self.kept) > KEPT_WORDS:
            self.kept = {}
        kept = self.kept
        new = {chunk for chunks in texts for chunk in chunks}.difference(kept)
        short = [chunk for chunk in new if len(chunk) <= KEPT_LENGTH]
        if short:
            kept.update(zip(short, self.pieces_of_all(short).tolist(), strict=True))
        if len(short) == len(new):
            return [sum(map(kept.__getitem__, chunks)) for chunks in texts]
        return [
            sum(kept[c] if c in kept else self.pieces(c) for c in chunks) for chunks in texts
        ]


_counters: dict[int, Counter] = {}


def count_tokens(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_chars, n_tokens) of every row, for the vocabulary file at ``path``."""
    shared = documents.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    number = hash(path)

    def run(batches):
        if number not in _counters:
            _counters[number] = Counter(shared.value)
        counter = _counters[number]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(text or "") for text in texts], pa.int64()),
                    pa.array(counter.counts(texts), pa.int64()),
                ],
                names=["doc_id", "n_chars", "n_tokens"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_chars bigint, n_tokens bigint"
    )


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
