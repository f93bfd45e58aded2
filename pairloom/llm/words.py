"""Words of Arrow text columns, found and hashed for a whole batch at once.

Texts are handled as UTF-8 bytes. All separators are single ASCII bytes, so no character is ever cut.
Work goes in slices of about a megabyte that end between words, so memory does not grow with a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
BLOCK = 2 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1

# Byte classes as in the contracts: words of every byte but white space; words of ASCII letters, digits and non-ASCII.
WHITE = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALPHANUMERIC = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@cache
def _tables(separators: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: is it part of a word; its value in the hash."""
    fold = np.arange(256)
    if lower:
        fold[65:91] += 32
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    inside = inside[fold]
    value = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))[fold]
    value[~inside] = 0
    return inside, value


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64."""
    up = np.full(size, _MULTIPLIER, np.uint64)
    down = np.full(size, pow(_MULTIPLIER, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins; a null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(starts):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def blocks(offsets: np.ndarray, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``most`` bytes together; one long text is a range of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, min(last, rows)
        first = min(last, rows)


def words(data: np.ndarray, offsets: np.ndarray, separators: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, begin and end of every word, and at which word each text begins (one more entry than texts)."""
    inside, value = _tables(separators, lower)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(data):
        end = at + SLICE
        while end < len(data):  # back or forth to a place between words
            part = inside[data[max(at, end - 4096) : end]]
            if not part.all():
                end = max(at, end - 4096) + int(np.flatnonzero(~part)[-1]) + 1
                break
            end += SLICE
        end = min(end, len(data))
        piece = data[at:end]
        word = inside[piece]
        cut = edge[at:end]
        first = word.copy()
        first[1:] &= ~word[:-1] | cut[1:]
        last = word.copy()
        last[:-1] &= ~word[1:] | cut[1:]
        begin = np.flatnonzero(first)
        if len(begin):
            until = np.flatnonzero(last) + 1
            up, down = _powers(1 << (len(piece) - 1).bit_length()) if len(piece) > SLICE else _powers(SLICE)
            total = np.add.reduceat(value[piece] * up[: len(piece)], begin)
            found.append((mix(total * down[begin] + (until - begin).astype(np.uint64)), begin + at, until + at))
        at = end
    if not found:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    hashes, begin, until = (np.concatenate([f[i] for f in found]) for i in range(3))
    return hashes, begin, until, np.searchsorted(begin, offsets)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words; those that run over the end of a text are for the caller to leave out."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    count = len(hashes) - size + 1
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = total * np.uint64(_MULTIPLIER) + hashes[k : k + count]
    return mix(total + np.uint64(size))


def spans(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def cover(size: int, begin: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in a range ``[begin, begin + length)``."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + length, -1)
    return np.cumsum(change[:-1]) > 0
