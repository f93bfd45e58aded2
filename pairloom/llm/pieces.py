"""Texts cut into pieces that a byte-level BPE tokenizer handles independently, and encoded once per distinct piece.

A token never reaches over the place before white space that follows anything but white space, nor over the
place between an ASCII letter and an ASCII punctuation mark. Texts are cut there, all at once on their bytes;
where a neighbour may be a wider white-space character the text is not cut, which is always safe. Distinct
pieces of a block are found by hash and compared byte by byte with their representative, so a piece is
never taken for another. What was encoded lately is remembered, up to a fixed number of pieces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

from pairloom.llm.words import SLICE, _powers, blocks, mix, utf8

REMEMBERED = 500_000
LONGEST = 128  # bytes of a piece that is remembered
_MARK = np.uint64(0xD6E8FEB86659FD93)

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _MARK)


def cuts(data: np.ndarray, special: Sequence[bytes] = ()) -> np.ndarray:
    """Where a piece begins, besides the beginnings of texts."""
    cut = np.zeros(len(data), bool)
    if len(data) < 2:
        return cut
    before = data[:-1]
    white = np.flatnonzero(_WHITE[data[1:]] & (before > 0x20)) + 1
    wide = white[data[white - 1] >= 0x80]  # after a character of several bytes: may it be white space?
    two, three = data[np.maximum(wide - 2, 0)], data[np.maximum(wide - 3, 0)]
    risky = (two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3))
    cut[white] = True
    cut[wide[risky]] = False
    cut[1:] |= _LETTER[before] & _PUNCTUATION[data[1:]]
    raw = data.tobytes() if special else b""
    for mark in special:
        at = raw.find(mark)
        while at >= 0:
            cut[at : at + len(mark)] = False
            cut[at] = True
            if at + len(mark) < len(data):
                cut[at + len(mark)] = True
            at = raw.find(mark, at + len(mark))
    return cut


def _taken(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The parts of ``flat`` that begin at ``begin``, one after another."""
    ends = np.cumsum(size)
    return flat[np.repeat(begin - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]


def first_ones(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which piece is the first of each distinct one, their hashes, and which of the distinct ones each piece is."""
    end = np.append(begin[1:], len(data))
    up, down = _powers(max(SLICE, 1 << (len(data) - 1).bit_length()))
    length = end - begin
    keys = mix(np.add.reduceat(_VALUE[data] * up[: len(data)], begin) * down[begin] + length.astype(np.uint64))
    _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    same = first[inverse]
    if (length[same] != length).any() or (_taken(data, begin[same], length) != data).any():
        raw, number = data.tobytes(), {}
        inverse = np.array([number.setdefault(raw[b:e], len(number)) for b, e in zip(begin, end)])
        first = np.unique(inverse, return_index=True)[1]
    return first, keys[first], inverse


def distinct(data: np.ndarray, begin: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct pieces, and which of them each piece is."""
    first, _, inverse = first_ones(data, begin)
    raw, end = data.tobytes(), np.append(begin[1:], len(data))
    return [raw[b:e] for b, e in zip(begin[first].tolist(), end[first].tolist())], inverse


class Remembering:
    """Encodes distinct pieces; keeps the latest of them in arrays ordered by hash, so that memory stays bounded.

    ``encode`` gives the ids of each piece as little-endian 32-bit integers. What is kept is compared byte by byte before it is taken.
    """

    def __init__(self, encode: Callable[[list[bytes]], Sequence[bytes]], most: int = REMEMBERED) -> None:
        self.encode, self.most, self.calls = encode, most, 0
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes in order, and where what they stand for is kept
        self.used = np.zeros(0, np.int64)  # the last call that asked for it
        self.data, self.begin, self.size = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.start, self.many = np.zeros(0, "<i4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _known(self, keys: np.ndarray, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each piece is kept, and where."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        near = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        place = self.place[near]
        hit = (self.keys[near] == keys) & (self.size[place] == size)
        at = np.flatnonzero(hit)
        wrong = np.flatnonzero(_taken(data, begin[at], size[at]) != _taken(self.data, self.begin[place[at]], size[at]))
        hit[at[np.searchsorted(np.cumsum(size[at]), wrong, "right")]] = False
        return hit, place

    def __call__(self, keys: np.ndarray, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each piece where its ids begin there and how many they are."""
        self.calls += 1
        hit, place = self._known(keys, data, begin, size)
        miss = np.flatnonzero(~hit)
        raw, coded = data.tobytes() if len(miss) else b"", []
        for at in range(0, len(miss), 20_000):
            part = miss[at : at + 20_000]
            coded += self.encode([raw[b : b + n] for b, n in zip(begin[part].tolist(), size[part].tolist())])
        made = np.frombuffer(b"".join(coded), "<i4")
        many, start = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        many[hit], start[hit] = self.many[place[hit]], self.start[place[hit]]
        many[miss] = [len(c) >> 2 for c in coded]
        start[miss] = len(self.ids) + np.cumsum(many[miss]) - many[miss]
        ids = np.concatenate([self.ids, made])
        self.used[place[hit]] = self.calls
        keep = miss[size[miss] <= LONGEST]
        keep = keep[np.unique(keys[keep], return_index=True)[1]]
        keep = keep[~np.isin(keys[keep], self.keys[np.minimum(np.searchsorted(self.keys, keys[keep]), len(self.keys) - 1)])] if len(self.keys) else keep
        self._keep(keys[keep], _taken(data, begin[keep], size[keep]), size[keep], _taken(ids, start[keep], many[keep]), many[keep])
        return ids, start, many

    def _keep(self, keys: np.ndarray, data: np.ndarray, size: np.ndarray, ids: np.ndarray, many: np.ndarray) -> None:
        at = np.searchsorted(self.keys, keys)
        self.place = np.insert(self.place, at, len(self.keys) + np.arange(len(keys)))
        self.keys = np.insert(self.keys, at, keys)
        self.used = np.append(self.used, np.full(len(keys), self.calls))
        self.begin, self.size = np.append(self.begin, len(self.data) + np.cumsum(size) - size), np.append(self.size, size)
        self.start, self.many = np.append(self.start, len(self.ids) + np.cumsum(many) - many), np.append(self.many, many)
        self.data, self.ids = np.append(self.data, data), np.append(self.ids, ids)
        if len(self.keys) > self.most:
            self._forget()

    def _forget(self) -> None:
        """Keep the half that was asked for last."""
        stay = np.zeros(len(self.used), bool)
        stay[np.argsort(self.used, kind="stable")[len(self.used) // 2 :]] = True
        kept = np.flatnonzero(stay)
        self.data, self.ids = _taken(self.data, self.begin[kept], self.size[kept]), _taken(self.ids, self.start[kept], self.many[kept])
        self.used, self.size, self.many = self.used[kept], self.size[kept], self.many[kept]
        self.begin, self.start = np.cumsum(self.size) - self.size, np.cumsum(self.many) - self.many
        left = stay[self.place]
        self.keys, self.place = self.keys[left], (np.cumsum(stay) - 1)[self.place[left]]


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of texts of about a block, or parts of one long text: first and last row, first and last byte."""
    for first, last in blocks(offsets, SLICE):
        low, high = int(offsets[first]), int(offsets[last])
        while high - low > 2 * SLICE:
            part = data[low + SLICE : min(high, low + 2 * SLICE)]
            safe = np.flatnonzero((part[1:] == 0x20) & _LETTER[part[:-1]])
            if not len(safe):
                break
            until = low + SLICE + 1 + int(safe[0])
            yield first, last, low, until
            low = until
        yield first, last, low, high


def encode_texts(texts: pa.Array, encoder: Remembering, special: Sequence[bytes] = ()) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: first row, last row, ids of all, and where each text's ids begin (one more entry than texts)."""
    data, offsets = utf8(texts)
    held: list[np.ndarray] = []
    for first, last, low, high in _segments(data, offsets):
        part = data[low:high]
        if len(part):
            cut = cuts(part, special)
            here = offsets[first : last + 1]
            here = here[(here >= low) & (here < high)] - low
            cut[here] = True
            cut[0] = True
            begin = np.flatnonzero(cut)
            one, keys, which = first_ones(part, begin)
            flat, starts, many = encoder(keys, part, begin[one], np.append(begin[1:], len(part))[one] - begin[one])
            counts = many[which]
            ends = np.cumsum(counts)
            ids = _taken(flat, starts[which], counts)
        else:
            begin, ends, counts, ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<i4")
        if high < offsets[last]:  # a part of one long text
            held.append(ids)
            continue
        if held:
            ids = np.concatenate([*held, ids])
            held = []
            yield first, last, ids, np.array([0, len(ids)])
            continue
        at = np.searchsorted(begin, offsets[first : last + 1] - low)
        yield first, last, ids, np.append(ends - counts, len(ids))[at] if len(begin) else np.zeros(last - first + 1, np.int64)
