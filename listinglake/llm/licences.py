"""License scans: a trained paragraph classifier, confirmed by template comparison.

Lines, cut further at sentence ends, are the paragraphs; a run of neighbouring ones without
a blank line between them, joined over line ends and comment marks, is judged like a
paragraph too, so that notices broken over lines are seen. Each becomes hashed single words and
word pairs, averaged, and a softmax regression names its licence family or "none". The
classifier is trained on the notices in ``TEMPLATES`` with words lost, repeated and added,
against about ``BACKGROUND`` paragraphs of the corpus itself, from documents chosen by the
hash of their id. "None" is calibrated on training examples held out: a temperature that
makes probabilities honest, and the lowest probability above which at most ``FALSE_RATE`` of
held-out background passes. A paragraph that passes is reported only if a notice of the same
family shares at least ``CONFIRM`` of its word pairs with it. Paragraphs that pass stand; of
overlapping runs for one notice, the one that holds most of it is reported, the shortest of
equal ones. A run has at most as many paragraphs as the longest notice has words.

Texts are read whole by one map, without shuffle; the model is ``BUCKETS`` times the number
of families, broadcast. Training runs in one task over the bounded sample. Null and empty
texts have no paragraphs; paragraphs without words are none. Ties go to the family listed
first. Null ids are scanned, but not sampled. Repeated rows are scanned each. With an empty
table there are no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm import words
from listinglake.llm.tables import fitting_sample, query, table

BUCKETS = 1 << 12
BACKGROUND = 6_000
#: Documents sampled for background, paragraphs taken from each and characters of those.
SAMPLED_DOCUMENTS, FROM_EACH, FROM_PARAGRAPH = 2_000, 3, 2_000
COPIES = 60
EPOCHS = 40
FALSE_RATE = 0.001
CONFIRM = 0.6
SCALE = 12.0

#: Short public notices of each licence family.
TEMPLATES = {
    "agpl": (
        "Licensed under the GNU Affero General Public License, version 3",
        "This program is licensed under the GNU AGPL version 3 or later",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License",
        "Released under the Apache License 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License",
        "Released under the BSD 2-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc0": (
        "This work is dedicated to the public domain under CC0 1.0 Universal",
        "Released under CC0 1.0",
        "To the extent possible under law, the author has waived all copyright and related rights",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Released under the Creative Commons Attribution License",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "Released under CC BY-NC-SA 4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "Released under the Creative Commons Attribution-ShareAlike License",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Released under the GNU GPL version 2",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "This library is released under the GNU LGPL version 3",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "mit": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "reserved": (
        "All rights reserved",
        "Copyright, all rights reserved",
        "No part of this publication may be reproduced without prior written permission",
    ),
}
FAMILIES = tuple(TEMPLATES)
NONE = len(FAMILIES)

_LETTERS = bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
_CLASSES = words.byte_classes(bytes(set(range(256)) - set(_LETTERS)), rest=1)
_WORD = re.compile(r"[^\W_]+")
_SHIFT = np.uint64(64 - 12)


def word_pairs(text: str) -> set[tuple[str, str]]:
    found = _WORD.findall(text.lower())
    return set(zip(found, found[1:], strict=False))


_PAIRS = {family: [word_pairs(t) for t in texts] for family, texts in TEMPLATES.items()}


#: No notice can be broken over more paragraphs than it has words.
LONGEST_RUN = max(len(_WORD.findall(t)) for texts in TEMPLATES.values() for t in texts)


def confirmation(text: str, family: str) -> float:
    """Largest share of a notice's word pairs that the paragraph has."""
    pairs = word_pairs(text)
    return max(len(pairs & known) / len(known) for known in _PAIRS[family])


def paragraphs(chunk: words.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop) of the paragraphs that have words, as bytes of the chunk.

    A paragraph ends at a line end, or after ``. ! ?`` and white space.
    """
    data, size = chunk.data, len(chunk.data)
    if not size:
        none = np.empty(0, np.int64)
        return none, none, none
    space = np.isin(data, np.frombuffer(words.SPACES, np.uint8))
    stop = (data == 0x2E) | (data == 0x21) | (data == 0x3F)
    cut = data == 0x0A
    cut[1:] |= space[1:] & stop[:-1]
    edge = np.zeros(size + 1, dtype=bool)
    edge[1:] = cut
    edge[chunk.offsets] = True
    edge[0] = edge[-1] = True
    bounds = np.flatnonzero(edge)
    letters = np.concatenate([[0], np.cumsum(_CLASSES[data])])
    full = letters[bounds[1:]] > letters[bounds[:-1]]
    start, stop = bounds[:-1][full], bounds[1:][full]
    return np.searchsorted(chunk.offsets, start, side="right") - 1, start, stop


def grams(chunk: words.Chunk, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(paragraph, slot) of the single words and word pairs of each paragraph."""
    found = words.words(chunk, _CLASSES)
    owner = np.searchsorted(start, found.start, side="right") - 1
    together = owner[1:] == owner[:-1]
    pairs = words.joined(found.hash, 2)[together] if len(owner) > 1 else found.hash[:0]
    slots = np.concatenate([words.mix(found.hash), pairs]) >> _SHIFT
    return np.concatenate([owner, owner[1:][together]]), slots.astype(np.int64)


def logits(chunk: words.Chunk, start: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Paragraphs by classes: mean weight of the paragraph's n-grams, and the intercept."""
    owner, slot = grams(chunk, start)
    count = np.maximum(np.bincount(owner, minlength=len(start)), 1)
    order = np.argsort(owner, kind="stable")
    heads = np.searchsorted(owner[order], np.arange(len(start)))
    total = np.add.reduceat(weights[slot[order]], heads, axis=0)
    return SCALE * total / count[:, None] + weights[BUCKETS]


def _softmax(values: np.ndarray) -> np.ndarray:
    raised = np.exp(values - values.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def neighbourhoods(chunk: words.Chunk, row: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A number for each paragraph, the same for those of a row without a blank line between."""
    data = chunk.data
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[1:] = data == 0x0A
    edge[chunk.offsets] = True
    edge[0] = edge[-1] = True
    lines = np.flatnonzero(edge)
    letters = np.concatenate([[0], np.cumsum(_CLASSES[data])])
    blank = np.cumsum(letters[lines[1:]] == letters[lines[:-1]])
    return row + blank[np.searchsorted(lines, start, side="right") - 1]


def _family_bits() -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the notices' word pairs, and the families of each as bits."""
    known: dict[int, int] = {}
    for number, family in enumerate(FAMILIES):
        for text in TEMPLATES[family]:
            body = np.frombuffer(text.encode(), np.uint8)
            found = words.words(words.Chunk(0, body, np.array([0, len(body)])), _CLASSES)
            for pair in words.joined(found.hash, 2).tolist():
                known[pair] = known.get(pair, 0) | 1 << number
    pairs = np.array(sorted(known), np.uint64)
    return pairs, np.array([known[p] for p in pairs.tolist()], np.int64)


_PAIR_HASHES, _PAIR_FAMILIES = _family_bits()


def sure_runs(
    chunk: words.Chunk, row: np.ndarray, start: np.ndarray, weights: np.ndarray, heat: float, bound: float
) -> list[tuple[int, int, int]]:
    """(first paragraph, last paragraph, family) of the runs that the classifier is sure of.

    Weights are summed from the front, so a run costs one subtraction. Runs whose first or
    last paragraph holds no word pair of the family's notices are left to shorter ones.
    """
    found = words.words(chunk, _CLASSES)
    owner = np.searchsorted(start, found.start, side="right") - 1
    size, classes = len(start), weights.shape[1]
    if size < 2:
        return []
    pairs = words.joined(found.hash, 2)
    at = np.minimum(np.searchsorted(_PAIR_HASHES, pairs), len(_PAIR_HASHES) - 1)
    bits = np.where(_PAIR_HASHES[at] == pairs, _PAIR_FAMILIES[at], 0)
    inside = owner[1:] == owner[:-1]
    # The pair over the border behind each paragraph but the last.
    over = np.flatnonzero(~inside)
    held = np.zeros(size, np.int64)
    np.bitwise_or.at(held, owner[1:][inside], bits[inside])
    opens, closes = held.copy(), held.copy()
    opens[:-1] |= bits[over]
    closes[1:] |= bits[over]
    near = neighbourhoods(chunk, row, start)
    joint = near[1:] == near[:-1]
    if not np.any(joint & (opens[:-1] != 0)):
        return []
    slot, pair_slot = ((x >> _SHIFT).astype(np.int64) for x in (words.mix(found.hash), pairs))
    wide = weights.astype(np.float64)
    sums = np.zeros((size + 1, classes))
    heads = np.searchsorted(owner, np.arange(size))
    each = wide[slot]
    each[1:][inside] += wide[pair_slot[inside]]
    np.cumsum(np.add.reduceat(each, heads, axis=0), axis=0, out=sums[1:])
    borders = np.zeros((size, classes))
    np.cumsum(wide[pair_slot[over]], axis=0, out=borders[1:])
    grams_in = np.zeros(size + 1, np.int64)
    lengths = np.bincount(owner, minlength=size)
    np.cumsum(2 * lengths - 1, out=grams_in[1:])
    runs = []
    for more in range(1, min(LONGEST_RUN, size)):
        shared = opens[:-more] & closes[more:]
        first = np.flatnonzero((near[more:] == near[:-more]) & (shared != 0))
        if not len(first):
            continue
        last = first + more
        total = sums[last + 1] - sums[first] + borders[last] - borders[first]
        count = grams_in[last + 1] - grams_in[first] + more
        values = SCALE * total / count[:, None] + wide[BUCKETS]
        best = values.argmax(axis=1)
        mine = np.flatnonzero((best != NONE) & ((shared[first] >> np.minimum(best, NONE - 1)) & 1 > 0))
        chance = _softmax(values[mine] / heat)[np.arange(len(mine)), best[mine]]
        mine = mine[chance >= bound]
        runs += zip(first[mine].tolist(), last[mine].tolist(), best[mine].tolist(), strict=True)
    return runs


def _shares(text: str, family: str) -> list[float]:
    """Share of each notice's word pairs that the text has."""
    pairs = word_pairs(text)
    return [len(pairs & known) / len(known) for known in _PAIRS[family]]


def confirmed(
    chunk: words.Chunk, row, start, stop, weights: np.ndarray, heat: float, bound: float
) -> list[tuple[int, int, int, str]]:
    """(row, start, stop, family) in bytes of the chunk, in text order."""

    def text(first: int, last: int) -> str:
        return chunk.data[start[first] : stop[last]].tobytes().decode()

    chance = _softmax(logits(chunk, start, weights) / heat)
    best = chance.argmax(axis=1)
    sure = (best != NONE) & (chance[np.arange(len(best)), best] >= bound)
    taken: dict[tuple[int, int], set[int]] = {}
    spans = []
    for k in np.flatnonzero(sure).tolist():
        shares = _shares(text(k, k), FAMILIES[best[k]])
        if max(shares) >= CONFIRM:
            spans.append((k, k, int(best[k])))
            for notice, share in enumerate(shares):
                if share >= CONFIRM:
                    taken.setdefault((int(best[k]), notice), set()).add(k)
    longer = []
    for first, last, family in sure_runs(chunk, row, start, weights, heat, bound):
        for notice, share in enumerate(_shares(text(first, last), FAMILIES[family])):
            if share >= CONFIRM:
                longer.append((-share, last - first, first, last, family, notice))
    for _, _, first, last, family, notice in sorted(longer):
        places, own = taken.setdefault((family, notice), set()), range(first, last + 1)
        if places.isdisjoint(own):
            places.update(own)
            spans.append((first, last, family))
    # Spans of one family that overlap are one.
    whole: list[list[int]] = []
    for first, last, family in sorted(spans, key=lambda s: (s[2], s[0], s[1])):
        if whole and whole[-1][2] == family and first <= whole[-1][1]:
            whole[-1][1] = max(whole[-1][1], last)
        else:
            whole.append([first, last, family])
    return [
        (int(row[first]), int(start[first]), int(stop[last]), FAMILIES[family])
        for first, last, family in sorted(whole)
    ]


def _as_chunk(texts: list[str]) -> words.Chunk:
    body = [re.sub(r"\s+", " ", text).replace(". ", " ").encode() for text in texts]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in body])])
    return words.Chunk(0, np.frombuffer(b"".join(body), np.uint8), bounds)


def _varied(background: list[str], random) -> tuple[list[str], list[int]]:
    """Notices with words lost, repeated, and words of the background around them."""
    spare = [w for text in background for w in text.split()[:6]] or ["the"]
    texts, labels = [], []
    for number, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            for copy in range(COPIES):
                found = template.split()
                if copy:
                    found = [w for w in found if random.random() > 0.06] or found
                    extra = random.integers(0, 5, 2)
                    found = [
                        *(spare[k] for k in random.integers(0, len(spare), extra[0])),
                        *found,
                        *(spare[k] for k in random.integers(0, len(spare), extra[1])),
                    ]
                texts.append(" ".join(found))
                labels.append(number)
    return texts, labels


def fit(background: list[str], seed: int = 3) -> np.ndarray:
    """Weights of ``BUCKETS + 2`` rows: slots, intercept, and (temperature, bound, ...)."""
    random = np.random.default_rng(seed)
    kept = [t for t in background if max(confirmation(t, f) for f in FAMILIES) < CONFIRM / 2]
    texts, labels = _varied(kept, random)
    texts, labels = texts + kept, np.array(labels + [NONE] * len(kept))
    chunk = _as_chunk([t if _WORD.search(t) else "none" for t in texts])
    owner, slot = grams(chunk, chunk.offsets[:-1])
    order = np.argsort(owner, kind="stable")
    owner, slot = owner[order], slot[order]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    count = np.maximum(np.diff(bounds), 1)
    held = random.random(len(texts)) < 0.3
    weights = np.zeros((BUCKETS + 2, NONE + 1))
    squares = np.full(weights.shape, 1e-8)
    truth = np.eye(NONE + 1)[labels]
    learners = np.flatnonzero(~held)
    for _ in range(EPOCHS):
        for block in np.array_split(random.permutation(learners), len(learners) // 256 + 1):
            where = np.concatenate([np.arange(bounds[b], bounds[b + 1]) for b in block])
            of = np.repeat(np.arange(len(block)), np.diff(bounds)[block])
            total = np.zeros((len(block), NONE + 1))
            np.add.at(total, of, weights[slot[where]])
            share = SCALE / count[block]
            slope = _softmax(total * share[:, None] + weights[BUCKETS]) - truth[block]
            step = np.zeros_like(weights)
            np.add.at(step, slot[where], (slope * share[:, None])[of])
            step[BUCKETS] = slope.sum(axis=0)
            step = step / len(block) + 1e-5 * weights
            squares += step * step
            weights -= 0.3 * step / np.sqrt(squares)
    every = logits(chunk, chunk.offsets[:-1], weights)[held]
    losses = []
    grid = (0.5, 0.75, 1.0, 1.5, 2.0, 3.0)
    for heat in grid:
        chance = _softmax(every / heat)
        losses.append(-np.log(chance[np.arange(len(chance)), labels[held]] + 1e-12).mean())
    heat = grid[int(np.argmin(losses))]
    wrong = np.sort(_softmax(every / heat)[labels[held] == NONE][:, :NONE].max(axis=1, initial=0.0))
    spare = int(FALSE_RATE * len(wrong))
    bound = max(0.5, float(wrong[len(wrong) - 1 - spare]) if len(wrong) else 0.5)
    weights[BUCKETS + 1, :2] = heat, min(bound, 0.95)
    return weights


def _background(batches):
    """A few paragraphs of each text, chosen by their hash."""
    for batch in batches:
        for chunk in words.chunks(batch.column("text")):
            row, start, stop = paragraphs(chunk)
            body = chunk.data.tobytes()
            for number in np.unique(row):
                mine = np.flatnonzero(row == number)
                order = np.argsort(words.mix(start[mine].astype(np.uint64)), kind="stable")
                picked = [body[start[k] : stop[k]].decode() for k in mine[order[:FROM_EACH]]]
                key = batch.column("key")[chunk.first + int(number)].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(picked), pa.int64()), pa.array([p[:FROM_PARAGRAPH] for p in picked])],
                    names=["key", "text"],
                )


def _fit_task(batches):
    texts = sorted(text for batch in batches for text in batch.column("text").to_pylist())
    order = np.argsort(words.mix(np.arange(len(texts), dtype=np.uint64)), kind="stable")
    weights = fit([texts[k] for k in order[:BACKGROUND]])
    used = np.flatnonzero(weights.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(weights[used].tolist())],
        names=["slot", "weights"],
    )


def train(documents: DataFrame) -> np.ndarray:
    """The model, from the notices and a bounded background sample of ``documents``."""
    rows = (
        fitting_sample(documents, SAMPLED_DOCUMENTS)
        .mapInArrow(_background, "key bigint, text string")
        .distinct()
        .select("text")
        .repartition(1)
        .mapInArrow(_fit_task, "slot int, weights array<double>")
        .collect()
    )
    weights = np.zeros((BUCKETS + 2, NONE + 1))
    for slot, values in rows:
        weights[slot] = values
    if not rows:
        weights = fit([])
    return weights


def scan(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, n_paragraphs, n_licensed, families, spans) of every row.

    ``spans`` lists family:start:end in code points, in text order.
    """
    shared = documents.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches):
        model = shared.value
        heat, bound = float(model[BUCKETS + 1, 0]), float(model[BUCKETS + 1, 1])
        for batch in batches:
            for chunk in words.chunks(batch.column("text")):
                row, start, stop = paragraphs(chunk)
                spans: list[list[str]] = [[] for _ in range(chunk.rows)]
                families: list[set[str]] = [set() for _ in range(chunk.rows)]
                if len(start):
                    for owner, begin, end, family in confirmed(
                        chunk, row, start, stop, model, heat, bound
                    ):
                        first = int(chunk.offsets[owner])
                        piece = chunk.data[begin:end].tobytes().decode()
                        at = len(chunk.data[first:begin].tobytes().decode())
                        spans[owner].append(f"{family}:{at}:{at + len(piece.rstrip())}")
                        families[owner].add(family)
                count = np.bincount(row, minlength=chunk.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(chunk.first, chunk.rows),
                        pa.array(count.astype(np.int64)),
                        pa.array([len(s) for s in spans], pa.int64()),
                        pa.array([",".join(sorted(f)) for f in families], pa.string()),
                        pa.array([",".join(s) for s in spans], pa.string()),
                    ],
                    names=["doc_id", "n_paragraphs", "n_licensed", "families", "spans"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, n_paragraphs bigint, n_licensed bigint, families string, spans string",
    )


@query("op8_licences")
def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return scan(documents, train(documents))
