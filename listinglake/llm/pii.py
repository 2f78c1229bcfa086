"""Personal data: exact patterns, and a skip-chain conditional random field around them.

Base spans are the leftmost non-overlapping matches of four patterns, failing ones dropped.

The field labels the tokens of a document that hold a digit or an at sign; every other
token cannot be part of an entity and is "none" by definition. Factors:

* unary, over the token's shape, digit count, checksum and neighbouring words;
* chain, between tokens next to each other;
* skip, between all tokens of a document with one key: the same last ``KEY_DIGITS`` digits,
  or the same mailbox name. Each token meets the others of its group through their summed
  beliefs, so a group of any size costs one message a token and no pairs.

Tokens in base spans are observed. Damped loopy messages give beliefs for the others; one
that is surely (``SURE``) of a kind adds a span, neighbours of a kind join. So a number
that the patterns miss is found where the document repeats it or its context says so, and
what a pattern has dropped is learned as "none".

Weights are learned by pseudo-likelihood, with base spans as labels and unary features
masked half of the time so that chain and skip weights are learned too, from a sample of
about ``TRAIN_DOCUMENTS`` documents by the hash of their id, in one task (a few numbers a
token, no texts). Weak priors stand in where the sample shows nothing.

Texts are read whole, by maps without shuffle. Null and empty texts have no spans and the
hash of an empty list. Null ids and repeated rows are searched each. Ties in start go by
kind in the order email, ip, card, phone. Extra columns are ignored, and kept as they are
by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.tables import first_of_key, fitting_sample, query, table

KINDS = ("email", "ip", "card", "phone")
NONE = 0  # label of no entity; kinds are 1 to 4
LABELS = len(KINDS) + 1
#: A token's group is its last digits, from so many on.
KEY_DIGITS = 7
KEY_LETTERS = 5
SLOTS = 1 << 12
#: Unary features of a token.
FEATURES = 7
TRAIN_DOCUMENTS = 20_000
EPOCHS, RATE, PULL = 6, 0.5, 1e-3
SKIP_PRIOR, CHAIN_PRIOR = 6.0, 0.5
ROUNDS, DAMPING = 8, 0.5
SURE = 0.9

_CANDIDATE = re.compile(r"[0-9@][^\x20\t-\r]*")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_MAILBOX = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# A start within a digit run fails or matches as the run's start does, hence the look-behind.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_SPACE = "\x20\t\n\v\f\r"
_SHAPES = (
    (re.compile("[0-9]+"), "9"),
    (re.compile("[^\\W\\d_]+"), "a"),
)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str):
    done = looked = 0
    at = text.find("@")
    while at >= 0:
        # The mailbox reaches left to its first character, but not into what is used up.
        head = text[max(done, looked) : at]
        size = len(head) - len(head.rstrip(_MAILBOX))
        found = _DOMAIN.match(text, at + 1) if size else None
        if found:
            yield at - size, found.end()
            done = found.end()
        looked = at + 1
        at = text.find("@", max(looked, done))


def _is_byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base, sorted; kinds count from 0."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for match in _IP.finditer(text):
            if all(map(_is_byte, match.groups())):
                found.append((match.start(), 1, match.end()))
        for match in _CARD.finditer(text):
            if match.end() - match.start() >= 12:
                digits = re.sub("[^0-9]", "", match.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((match.start(), 2, match.end()))
        for match in _PHONE.finditer(text) if "+" in text else ():
            if 9 <= len(re.sub("[^0-9]", "", match.group())) <= 15:
                found.append((match.start(), 3, match.end()))
    return sorted(found)


def _slot(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % SLOTS


class Token(NamedTuple):
    start: int
    end: int
    key: str
    """Group within the document, or empty."""
    features: tuple[int, ...]


def _described(text: str, start: int, end: int) -> Token:
    token = text[start:end]
    digits = re.sub("[^0-9]", "", token)
    shape = token
    for pattern, sign in _SHAPES:
        shape = pattern.sub(sign, shape)
    key = ""
    if "@" in token or len(digits) < KEY_DIGITS:
        name = token.split("@")[0].lower()
        if len(name) >= KEY_LETTERS and any(c.isalpha() for c in name):
            key = "m" + name
    else:
        key = "d" + digits[-KEY_DIGITS:]
    before = text[max(0, start - 24) : start].split()[-1:]
    after = text[end : end + 24].split()[:1]
    many = 12 <= len(digits) <= 19
    names = (
        "bias",
        f"shape {shape[:24]}",
        f"digits {min(len(digits), 20)}",
        f"luhn {many and luhn(digits)}",
        f"sign {token[0] == '+'} {'@' in token}",
        f"before {''.join(before).lower()}",
        f"after {''.join(after).lower()}",
    )
    return Token(start, end, key, tuple(_slot(name) for name in names))


def candidates(text: str) -> list[Token]:
    """Tokens with a digit or an at sign, without the marks around them."""
    found, done = [], 0
    for match in _CANDIDATE.finditer(text):
        head = text[done : match.start()]
        first = done + 1 + max(head.rfind(c) for c in _SPACE)
        done = match.end()
        token = text[first:done]
        bare = token.lstrip("!\"#$%&'*,-./:;<=>?[\\]^_`{|}~")
        start = done - len(bare)
        end = start + len(bare.rstrip("!\"#$%&'(*+,-./:;<=>?[\\]^_`{|}~"))
        if start < end:
            found.append(_described(text, start, end))
    return found


class Nodes(NamedTuple):
    """Candidate tokens of many documents as arrays, in document order."""

    document: np.ndarray
    features: np.ndarray
    seen: np.ndarray
    """Label from the base; NONE for all others."""
    chained: np.ndarray
    """Whether the token stands right after the one before it."""
    group: np.ndarray
    """Group number, or -1."""


def nodes(documents: list[tuple[list[Token], list[tuple[int, int, int]], str]]) -> Nodes:
    document, features, seen, chained, group = [], [], [], [], []
    groups: dict[tuple[int, str], int] = {}
    for number, (tokens, base, text) in enumerate(documents):
        at, before = 0, None
        for token in tokens:
            while at < len(base) and base[at][2] <= token.start:
                at += 1
            label, near = NONE, at
            while near < len(base) and base[near][0] < token.end:
                if base[near][2] > token.start:
                    label = base[near][1] + 1
                    break
                near += 1
            document.append(number)
            features.append(token.features)
            seen.append(label)
            between = text[before:token.start] if before is not None else None
            chained.append(between is not None and len(between) <= 2)
            before = token.end
            group.append(groups.setdefault((number, token.key), len(groups)) if token.key else -1)
    return Nodes(
        np.array(document, np.int64),
        np.array(features, np.int64).reshape(len(document), FEATURES),
        np.array(seen, np.int64),
        np.array(chained, bool),
        np.array(group, np.int64),
    )


class Weights(NamedTuple):
    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def prior() -> Weights:
    agree = np.eye(LABELS)
    agree[NONE, NONE] = 0
    return Weights(np.zeros((SLOTS, LABELS)), CHAIN_PRIOR * agree, SKIP_PRIOR * agree)


def _others(group: np.ndarray, belief: np.ndarray) -> np.ndarray:
    """Summed belief of the others of each token's group, over the root of their number."""
    mean = np.zeros_like(belief)
    mine = np.flatnonzero(group >= 0)
    if len(mine):
        total = np.zeros((group.max() + 1, belief.shape[1]))
        np.add.at(total, group[mine], belief[mine])
        count = np.bincount(group[mine])[group[mine]] - 1
        rest = total[group[mine]] - belief[mine]
        mean[mine] = np.where(count[:, None] > 0, rest / np.sqrt(np.maximum(count, 1))[:, None], 0.0)
    return np.maximum(mean, 0.0)


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def learn(sample: Nodes, epochs: int = EPOCHS) -> Weights:
    """Pseudo-likelihood by scaled gradient steps over blocks of tokens, from the prior."""
    start = prior()
    now = Weights(*(part.copy() for part in start))
    if not len(sample.seen):
        return now
    size = [np.full(part.shape, 1e-6) for part in now]
    truth = np.eye(LABELS)[sample.seen]
    skip = _others(sample.group, truth)
    left, right = np.zeros_like(truth), np.zeros_like(truth)
    left[1:] = truth[:-1] * sample.chained[1:, None]
    right[:-1] = truth[1:] * sample.chained[1:, None]
    random = np.random.default_rng(7)
    for _ in range(epochs):
        for block in np.array_split(random.permutation(len(truth)), len(truth) // 256 + 1):
            shown = random.random(len(block)) < 0.5
            used = sample.features[block][shown]
            logits = left[block] @ now.chain + right[block] @ now.chain.T + skip[block] @ now.skip
            np.add.at(logits, np.flatnonzero(shown), now.unary[used].sum(axis=1))
            slope = _softmax(logits) - truth[block]
            unary = np.zeros_like(now.unary)
            np.add.at(unary, used.ravel(), np.repeat(slope[shown], used.shape[1], axis=0))
            steps = (
                unary,
                left[block].T @ slope + slope.T @ right[block],
                skip[block].T @ slope,
            )
            for part, begun, total, step in zip(now, start, size, steps, strict=True):
                step = step / len(block) + PULL * (part - begun) / len(block)
                total += step * step
                part -= RATE * step / np.sqrt(total)
    return now


def beliefs(found: Nodes, weights: Weights) -> np.ndarray:
    """Marginals after damped loopy messages; observed tokens keep their label."""
    unary = weights.unary[found.features].sum(axis=1)
    observed = found.seen != NONE
    unary[observed] = -50.0
    unary[observed, found.seen[observed]] = 50.0
    forward, backward, skip = (np.zeros_like(unary) for _ in range(3))
    chained = np.flatnonzero(found.chained)

    def sent(logits: np.ndarray, table: np.ndarray) -> np.ndarray:
        top = logits.max(axis=1, keepdims=True)
        message = np.log(np.exp(logits - top) @ np.exp(table) + 1e-300)
        return message - message.max(axis=1, keepdims=True)

    for _ in range(ROUNDS):
        ahead, behind = np.zeros_like(unary), np.zeros_like(unary)
        if len(chained):
            before = chained - 1
            ahead[chained] = sent((unary + forward + skip)[before], weights.chain)
            behind[before] = sent((unary + backward + skip)[chained], weights.chain.T)
        # Cavity: what a token tells its group leaves out what the group told it.
        told = _others(found.group, _softmax(unary + forward + backward))
        heard = told.sum(axis=1) > 0
        across = np.zeros_like(unary)
        across[heard] = told[heard] @ weights.skip
        forward = DAMPING * forward + (1 - DAMPING) * ahead
        backward = DAMPING * backward + (1 - DAMPING) * behind
        skip = DAMPING * skip + (1 - DAMPING) * across
    return _softmax(unary + forward + backward + skip)


def _added(tokens: list[Token], label: np.ndarray, chained: np.ndarray) -> list:
    """Spans of unobserved tokens of a kind; neighbours of one kind join."""
    found = []
    for number, token in enumerate(tokens):
        kind = int(label[number]) - 1
        if kind < 0:
            continue
        if found and chained[number] and found[-1][1] == kind and label[number - 1] - 1 == kind:
            found[-1] = (found[-1][0], kind, token.end)
        else:
            found.append((token.start, kind, token.end))
    return found


def search(texts: list[str | None], weights: Weights) -> list[tuple[list, list]]:
    """(base spans, added spans) of each text."""
    entries = []
    for text in texts:
        text = text or ""
        hit = _CANDIDATE.search(text)
        entries.append((candidates(text), base_spans(text), text) if hit else ([], [], ""))
    found = nodes(entries)
    added: list[list] = [[] for _ in texts]
    if len(found.seen):
        belief = beliefs(found, weights)
        label = np.where(belief.max(axis=1) >= SURE, belief.argmax(axis=1), NONE)
        label[found.seen != NONE] = NONE
        bounds = np.searchsorted(found.document, np.arange(len(texts) + 1))
        for number in np.unique(found.document[label != NONE]):
            mine = slice(bounds[number], bounds[number + 1])
            added[number] = _added(entries[number][0], label[mine], found.chained[mine])
    return [(base, more) for (_, base, _), more in zip(entries, added, strict=True)]


def _sample_nodes(batches):
    for batch in first_of_key(batches):
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            tokens = candidates(text)
            if not tokens:
                continue
            found = nodes([(tokens, base_spans(text), text)])
            yield pa.RecordBatch.from_pydict(
                {
                    "key": [key],
                    "features": [found.features.ravel().tolist()],
                    "seen": [found.seen.tolist()],
                    "chained": [found.chained.astype(np.int64).tolist()],
                    "members": [found.group.tolist()],
                },
                schema=_KEYED,
            )


_SAMPLE = pa.schema(
    [(name, pa.list_(pa.int64())) for name in ("features", "seen", "chained", "members")]
)
_KEYED = pa.schema([("key", pa.int64()), *_SAMPLE])


def _learn(batches):
    """One task over the sample: the weights as (part, spot, weight), zeros left out."""
    parts: list[list[np.ndarray]] = [[], [], [], []]
    groups = 0
    for batch in first_of_key(batches):
        for row in batch.to_pylist():
            group = np.array(row["members"], np.int64)
            group[group >= 0] += groups
            groups = max(groups, int(group.max(initial=-1)) + 1)
            for part, values in zip(
                parts, (row["features"], row["seen"], row["chained"], group), strict=True
            ):
                part.append(np.asarray(values, np.int64))
    if not parts[0]:
        return
    features, seen, chained, group = (np.concatenate(part) for part in parts)
    learned = learn(
        Nodes(seen * 0, features.reshape(len(seen), FEATURES), seen, chained.astype(bool), group)
    )
    for number, part in enumerate(learned):
        spots = np.flatnonzero(part)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(spots), number, np.int32)),
                pa.array(spots.astype(np.int32)),
                pa.array(part.ravel()[spots]),
            ],
            names=["part", "spot", "weight"],
        )


def train(documents: DataFrame, size: int = TRAIN_DOCUMENTS) -> Weights:
    """Weights from a sample of about ``size`` documents; at most ``SLOTS * LABELS`` numbers."""
    rows = (
        fitting_sample(documents, size)
        .where(F.col("text").rlike("[0-9@]"))
        .mapInArrow(_sample_nodes, "key bigint, " + ", ".join(f"{name} array<bigint>" for name in _SAMPLE.names))
        .repartition(1)
        # One order of the sample in every run.
        .sortWithinPartitions("key")
        .mapInArrow(_learn, "part int, spot int, weight double")
        .collect()
    )
    learned = prior()
    if rows:
        for part in learned:
            part[:] = 0
        for part, spot, weight in rows:
            learned[part].ravel()[spot] = weight
    return learned


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_personal(documents: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, n_added, base_sha256, spans) of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(train(documents))

    def run(batches):
        for batch in batches:
            spans = search(batch.column("text").to_pylist(), shared.value)
            counts = [
                pa.array([sum(s[1] == kind for s in base) for base, _ in spans], pa.int64())
                for kind in range(len(KINDS))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *counts,
                    pa.array([len(more) for _, more in spans], pa.int64()),
                    pa.array([hashlib.sha256(_listed(b).encode()).hexdigest() for b, _ in spans]),
                    pa.array([_listed(sorted(b + more)) for b, more in spans]),
                ],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "n_added", "base_sha256", "spans"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{name} bigint" for name in (*KINDS, "added"))
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, {counts}, base_sha256 string, spans string"
    )


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span, overlapping ones as one, replaced by its first kind's name."""
    pieces, done = [], 0
    for start, kind, end in sorted(spans):
        if start >= done:
            pieces += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*pieces, text[done:]])


def redact(documents: DataFrame) -> DataFrame:
    """All rows and columns of ``documents``; spans in ``text`` replaced, ``n_chars`` renewed."""
    shared = documents.sparkSession.sparkContext.broadcast(train(documents))

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans = search(texts, shared.value)
            clean = [
                redacted(text, base + more) if base or more else text
                for text, (base, more) in zip(texts, spans, strict=True)
            ]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.schema.field(at).type))

    out = documents.mapInArrow(run, documents.schema)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        size = F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(kind))
        out = out.withColumn("n_chars", size)
    return out


@query("op4_personal")
def op4_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal(table(spark, sf_dir, "documents"))
