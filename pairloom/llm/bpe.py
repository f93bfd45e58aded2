"""Byte-level BPE encoding and decoding by speculation and verification.

Every word is first split greedily into longest vocabulary entries. A token sequence is the BPE result exactly if
each adjacent pair is compatible: merging the two tokens' bytes gives the two tokens again. The pairs of all
words of a block are tested at once: the right edge of the left token and the left edge of the right token are
unmerged step by step, in reverse order of their merges, and a pair that could have been merged across
the border before either side went on rules the proposal out. Only words with such a pair are merged exactly.

The vocabulary file (a tokenizers JSON of a byte-level BPE) is a parameter and is read where the work is done. A
null text is empty and has no ids; an empty text decodes to an empty text; the text of a special token is that
token. Rows that repeat an id are encoded one by one; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.pieces import Remembering, encode_texts

# Fixed value: the published split pattern of byte-level BPE.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Fixed value: white space as the tokenizer's pattern language has it; the \s used here has four control characters more.
_SPACE = r"[\t-\r \x85\xa0  -     　]"
_NOT_SPACE = _SPACE.replace("[", "[^", 1)
_PATTERN = SPLIT.replace(r"[^\s", _NOT_SPACE[:-1]).replace(r"\s", _SPACE).replace(r"(?!\S)", f"(?!{_NOT_SPACE})")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Merges as arrays over token ids: how a token was made, when, and what two tokens make."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            loaded = json.load(file)
        letters = byte_letters()
        ids = loaded["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in loaded["model"]["merges"]]
        size = max([*ids.values(), *(t["id"] for t in loaded["added_tokens"])]) + 1
        self.text = [b""] * size
        for token, i in ids.items():
            self.text[i] = bytes(letters[c] for c in token)
        self.special = {t["content"].encode(): t["id"] for t in loaded["added_tokens"]}
        for token, i in self.special.items():
            self.text[i] = token
        left = np.array([ids[a] for a, _ in merges])
        right = np.array([ids[b] for _, b in merges])
        made = np.array([ids[a + b] for a, b in merges])
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        self.born = np.full(size, -1)
        ranks = np.arange(len(merges))
        self.left[made[::-1]], self.right[made[::-1]], self.born[made[::-1]] = left[::-1], right[::-1], ranks[::-1]
        key = left * size + right
        order = np.argsort(key, kind="stable")
        self.size, self.keys, self.ranks = size, key[order], ranks[order]
        self.merge = dict(zip(zip(left.tolist(), right.tolist()), zip(ranks.tolist(), made.tolist())))
        self.byte = [ids[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        whole = np.flatnonzero(self.born >= 0)
        sound = np.ones(size, bool)
        sound[whole] = self.compatible(self.left[whole], self.right[whole], self.born[whole])
        for i in whole[np.argsort(self.born[whole])]:  # a token is sound if its parts are
            sound[i] &= sound[self.left[i]] and sound[self.right[i]]
        self.find = {self.text[i]: i for i in ids.values() if sound[i]}
        self.longest = max(map(len, self.find))

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], np.iinfo(np.int64).max)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For each pair: does no merge across its border come first (of rank below ``before``, if given)?"""
        never = np.iinfo(np.int64).max
        end_a = np.full(len(a), never) if before is None else before.copy()
        end_b = end_a.copy()
        good, active = np.ones(len(a), bool), np.arange(len(a))
        a, b = a.copy(), b.copy()
        while len(active):
            rank = self._rank(a, b)
            # A border merge wins against a later merge on either side; of equal ones the leftmost goes first.
            crossed = (rank != never) & (rank < end_a) & (rank <= end_b)
            if before is not None:
                crossed &= rank < before[active]
            good[active[crossed]] = False
            undo_a = (self.born[a] > self.born[b]) & ~crossed
            undo_b = ~undo_a & (self.born[b] >= 0) & ~crossed
            end_a = np.where(undo_a, self.born[a], end_a)
            end_b = np.where(undo_b, self.born[b], end_b)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_b, self.left[b], b)
            on = undo_a | undo_b
            active, a, b, end_a, end_b = active[on], a[on], b[on], end_a[on], end_b[on]
        return good

    def propose(self, word: bytes) -> list[int]:
        out, at, find = [], 0, self.find
        while at < len(word):
            for end in range(min(len(word), at + self.longest), at, -1):
                token = find.get(word[at:end])
                if token is not None:
                    break
            out.append(token)
            at = end
        return out

    def exact(self, word: bytes) -> list[int]:
        """Lowest rank first, leftmost first, by a heap over linked tokens."""
        tokens = [self.byte[b] for b in word]
        after, before = list(range(1, len(tokens) + 1)), list(range(-1, len(tokens) - 1))
        heap = [(*m, k, pair) for k, pair in enumerate(zip(tokens, tokens[1:])) if (m := self.merge.get(pair))]
        heapq.heapify(heap)
        while heap:
            _, token, k, (a, b) = heapq.heappop(heap)
            n = after[k]
            if tokens[k] != a or n >= len(tokens) or tokens[n] != b:
                continue
            tokens[k], tokens[n] = token, -1
            after[k] = after[n]
            if after[n] < len(tokens):
                before[after[n]] = k
            for x in (before[k], k):
                if x >= 0 and after[x] < len(tokens) and (m := self.merge.get(pair := (tokens[x], tokens[after[x]]))):
                    heapq.heappush(heap, (*m, x, pair))
        return [t for t in tokens if t >= 0]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        proposed = [self.propose(w) for w in words]
        many = np.array([len(p) for p in proposed])
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(many.sum()))
        owner = np.repeat(np.arange(len(words)), many)
        inner = np.flatnonzero(owner[:-1] == owner[1:]) if len(flat) else np.zeros(0, np.int64)
        pairs, which = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        wrong = owner[inner[~self.compatible(pairs // self.size, pairs % self.size)[which]]]
        for k in np.unique(wrong):
            proposed[k] = self.exact(words[k])
        return proposed

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        number: dict[bytes, int] = {}
        split = []
        for piece in pieces:
            if piece in self.special:
                split.append(self.special[piece])
            else:
                split.append([number.setdefault(w.encode(), len(number)) for w in _SPLITTER.findall(piece.decode())])
        coded = self.encode_words(list(number))
        return [[s] if isinstance(s, int) else [t for w in s for t in coded[w]] for s in split]


_SPLITTER = regex.compile(_PATTERN)


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@cache
def _encoder(path: str) -> Remembering:
    return Remembering(lambda pieces: [array("i", ids).tobytes() for ids in vocabulary(path).encode_pieces(pieces)])


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = tuple(vocabulary(path).special)
        for batch in batches:
            for first, last, ids, at in encode_texts(batch.column(1), _encoder(path), special):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))],
                    names=["id", "ids"],
                )

    return run


@cache
def _bytes_of(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    text = vocabulary(path).text
    size = np.array([len(t) for t in text])
    return np.frombuffer(b"".join(text), np.uint8), np.cumsum(size) - size, size


def _text_of(ids: pa.ListScalar, flat: np.ndarray, starts: np.ndarray, size: np.ndarray) -> str:
    numbers = np.asarray(ids.values) if ids.is_valid else np.zeros(0, np.int64)
    raw = []
    for at in range(0, len(numbers), 1 << 18):
        part = numbers[at : at + (1 << 18)]
        counts = size[part]
        ends = np.cumsum(counts)
        raw.append(flat[np.repeat(starts[part] - (ends - counts), counts) + np.arange(int(ends[-1]))].tobytes())
    return b"".join(raw).decode("utf-8", "replace")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, starts, size = _bytes_of(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # few rows at a time leave the worker
                part = batch.slice(at, 256)
                texts = [_text_of(ids, flat, starts, size) for ids in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["id", "ids", "decoded"])

    return run


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: id and the token ids of its whole text."""
    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(_encode(path), "id bigint, ids array<int>")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``, to rows of (id, ids)."""
    return coded.select("id", "ids").mapInArrow(_decode(path), "id bigint, ids array<int>, decoded string")
