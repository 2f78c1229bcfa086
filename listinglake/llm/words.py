"""Hashed words of whole texts, vectorised with numpy over the UTF-8 bytes of Arrow columns.

A text becomes 64-bit word hashes without a Python object per word: a prefix sum of
``byte * BASE**i`` gives the hash of every span, and class changes between neighbouring
bytes give the spans. Work goes in chunks of whole rows, so memory follows
``CHUNK_BYTES`` or the longest single text, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, size: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < size:
        steps = np.full(max(size, CHUNK_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return known


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on every bit (a bijection)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def byte_classes(*groups: bytes, rest: int) -> np.ndarray:
    """Class of each byte value: i for members of ``groups[i]``, ``rest`` for all others."""
    table = np.full(256, rest, dtype=np.uint8)
    for number, members in enumerate(groups):
        table[list(members)] = number
    return table


SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: 0 white space, 1 everything else.
PLAIN = byte_classes(SPACES, rest=1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Chunk(NamedTuple):
    first: int
    """Number of the first row in its batch."""
    data: np.ndarray
    offsets: np.ndarray
    """Byte bounds of the rows within ``data``, one more than rows."""

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Whole rows of a string column in runs of about ``limit`` bytes; null reads as empty."""
    if not len(column):
        return
    column = column.cast(pa.large_string()).fill_null("")
    _, bounds, body = column.buffers()
    bounds = np.frombuffer(bounds, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(body, dtype=np.uint8) if body is not None else np.empty(0, np.uint8)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(bounds, bounds[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), len(column))
        offsets = bounds[start : stop + 1]
        yield Chunk(start, body[offsets[0] : offsets[-1]], offsets - offsets[0])
        start = stop


class Words(NamedTuple):
    row: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    hash: np.ndarray


def words(chunk: Chunk, classes: np.ndarray = PLAIN) -> Words:
    """Maximal runs of bytes of one class other than 0; A-Z hash as a-z."""
    data, offsets = chunk.data, chunk.offsets
    if not len(data):
        none = np.empty(0, np.int64)
        return Words(none, none, none, np.empty(0, np.uint64))
    kind = classes[data]
    edge = np.empty(len(data) + 1, dtype=bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    edge[0] = edge[-1] = True
    cuts = np.flatnonzero(edge)
    kept = kind[cuts[:-1]] > 0
    start, stop = cuts[:-1][kept], cuts[1:][kept]
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    lowered = _LOWER[data].astype(np.uint64)
    lowered += np.uint64(1)
    lowered *= _power_table(_BASE, len(data))[: len(data)]
    np.cumsum(lowered, out=sums[1:])
    spans = (sums[stop] - sums[start]) * _power_table(_INVERSE, len(data) + 1)[start]
    hashed = mix(spans + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    row = np.searchsorted(offsets, start, side="right") - 1
    return Words(row, start, stop, hashed)


def joined(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` neighbouring values; one entry per possible start."""
    runs = max(0, len(hashes) - size + 1)
    value = hashes[:runs].copy()
    for step in range(1, size):
        value = mix(value) + hashes[step : step + runs]
    return mix(value + np.uint64(size))


def shingles(found: Words, size: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each run of ``size`` words within a row, in order.

    A row of fewer words gives its whole word sequence as one; a row without words none.
    """
    runs = joined(found.hash, size)
    whole = found.row[: len(runs)] == found.row[size - 1 : size - 1 + len(runs)]
    row, value = [found.row[: len(runs)][whole]], [runs[whole]]
    count = np.bincount(found.row, minlength=rows)
    first = np.cumsum(count) - count
    for few in range(1, size):
        short = np.flatnonzero(count == few)
        if len(short):
            row.append(short)
            value.append(joined(found.hash, few)[first[short]])
    return np.concatenate(row), np.concatenate(value)
