"""Benchmark passages in documents, by a prefix-filtered set join.

A window is ``WINDOW`` consecutive words of an item (all words of a shorter item). A window is taken as its set
of shingles of ``SHINGLE`` words. For exact containment all of them must occur, so the necessary prefix is one shingle:
the rarest by the number of documents that hold it. Documents are joined with the windows on that shingle; a
candidate's place follows from the shingle's place in the window and must lie inside the document (positional and
length bounds); then all shingles of the window are compared at their places.

Shingle counts come from all documents. The benchmark's windows go to the tasks in blocks of at most
``BLOCK_WINDOWS`` windows, counted before; a larger benchmark takes several blocks, each over all documents.

Null, empty and word-free texts have no words and no hits; such items have no windows. Items without an id count for hits
but cannot be listed. Rows that repeat an id are judged one by one. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.stages import Stage
from pairloom.llm.words import NOT_ALPHANUMERIC, blocks, cover, grams, spans, utf8, words

WINDOW = 10
SHINGLE = 3
BLOCK_WINDOWS = 200_000

_FOUND = "id bigint, n_words bigint, begins array<int>, ends array<int>, items array<bigint>"


def _runs(texts: pa.Array) -> Iterator[np.ndarray]:
    """The word hashes of each text."""
    data, offsets = utf8(texts)
    for first, last in blocks(offsets):
        low = offsets[first]
        hashes, _, _, at = words(data[low : offsets[last]], offsets[first : last + 1] - low, NOT_ALPHANUMERIC, lower=True)
        for k in range(last - first):
            yield hashes[at[k] : at[k + 1]]


def _shingles_of(run: np.ndarray, size: int) -> np.ndarray:
    return grams(run, size).view(np.int64)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item, text -> one row per window: its length in words and its shingles in order."""
    for batch in batches:
        for item, run in zip(batch.column(0).to_pylist(), _runs(batch.column(1))):
            length = min(WINDOW, len(run))
            if not length:
                continue
            size = min(SHINGLE, length)
            shingles = np.lib.stride_tricks.sliding_window_view(_shingles_of(run, size), length - size + 1)
            for at in range(0, len(shingles), 10_000):
                part = shingles[at : at + 10_000]
                ends = np.arange(0, part.size + 1, part.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * len(part), pa.int64()),
                        pa.array(np.full(len(part), length, np.int32)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(part.ravel())),
                    ],
                    names=["item", "length", "shingles"],
                )


def _ranges(counts: np.ndarray) -> np.ndarray:
    """0..n-1 for each n, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


class _Block:
    """Windows of one block, as arrays that travel with the tasks."""

    def __init__(self, rows: pa.Table) -> None:
        self.items = rows.column("item").combine_chunks()
        self.length = rows.column("length").to_numpy().astype(np.int64)
        lists = rows.column("shingles").combine_chunks()
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        self.at = np.asarray(lists.offsets).astype(np.int64)
        self.flat = np.asarray(lists.flatten())
        self.at -= self.at[0] if len(self.at) else 0
        self.known = np.unique(self.flat)
        self.sizes = sorted({min(SHINGLE, int(n)) for n in np.unique(self.length)})
        bits = np.zeros(1 << 22, bool)
        bits[self.known & (len(bits) - 1)] = True
        self.bits = np.packbits(bits)

    def rank(self, counts: dict[int, int]) -> None:
        """Choose each window's rarest shingle; windows with a shingle that no document has are left out."""
        documents = np.array([counts.get(int(s), 0) for s in self.known], np.int64)
        each = documents[np.searchsorted(self.known, self.flat)]
        window = np.repeat(np.arange(len(self.length)), np.diff(self.at))
        order = np.lexsort((_ranges(np.diff(self.at)), each, window))
        first = order[self.at[:-1]] if len(self.length) else order
        rare = np.flatnonzero(each[first] > 0)
        by = rare[np.argsort(self.flat[first[rare]], kind="stable")]
        self.window, self.prefix, self.offset = by, self.flat[first[by]], first[by] - self.at[by]
        self.bits = None


def _match(block: _Block):
    """id, text -> the places of the block's shingles in each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(block.bits).view(bool)
        for batch in batches:
            count, places, found = [], [], []
            for run in _runs(batch.column(1)):
                count.append(len(run))
                at, what = [], []
                for size in block.sizes:
                    shingles = _shingles_of(run, size)
                    maybe = np.flatnonzero(bits[shingles & (len(bits) - 1)])
                    if len(maybe):
                        near = np.searchsorted(block.known, shingles[maybe])
                        maybe = maybe[block.known[np.minimum(near, len(block.known) - 1)] == shingles[maybe]]
                    at.append(maybe)
                    what.append(shingles[maybe])
                places.append(np.concatenate([np.zeros(0, np.int64), *at]))  # a block may have no windows at all
                found.append(np.concatenate([np.zeros(0, np.int64), *what]))
            ends = pa.array(np.cumsum([0, *map(len, places)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(k) for k in range(batch.num_columns)],
                    pa.array(count, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*places, np.zeros(0, np.int64)]).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64))),
                ],
                names=[*batch.schema.names, "n_words", "places", "shingles"],
            )

    return run


def _contained(block: _Block, n_words: int, places: np.ndarray, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the block in one document, and where each begins."""
    low = np.searchsorted(block.prefix, shingles, "left")
    many = np.searchsorted(block.prefix, shingles, "right") - low
    hit = np.repeat(np.arange(len(shingles)), many)
    which = np.repeat(low, many) + _ranges(many)
    window, begin = block.window[which], places[hit] - block.offset[which]
    inside = (begin >= 0) & (begin + block.length[window] <= n_words)
    window, begin = window[inside], begin[inside]
    if not len(window):
        return window, begin
    counts = np.diff(block.at)[window]
    owner = np.repeat(np.arange(len(window)), counts)
    step = _ranges(counts)
    wanted = block.flat[block.at[window][owner] + step]
    # Every shingle of the window must stand at its place; places of one text are distinct per shingle size.
    order = np.lexsort((shingles, places))
    pairs = np.empty(len(order), dtype=[("place", np.int64), ("shingle", np.int64)])
    pairs["place"], pairs["shingle"] = places[order], shingles[order]
    asked = np.empty(len(owner), dtype=pairs.dtype)
    asked["place"], asked["shingle"] = begin[owner] + step, wanted
    there = np.isin(asked.view("V16"), pairs.view("V16")) if len(asked) > 64 else np.array([bool((pairs == a).any()) for a in asked])
    whole = np.bincount(owner, weights=~there, minlength=len(window)) == 0
    return window[whole], begin[whole]


def _verify(block: _Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = block.items.to_pylist()
        for batch in batches:
            names = batch.schema.names
            column = {n: batch.column(k) for k, n in enumerate(names)}
            begins, ends, items = [], [], []
            for k, n in enumerate(column["n_words"].to_pylist()):
                places, shingles = (np.asarray(column[c][k].values) for c in ("places", "shingles"))
                window, begin = _contained(block, n, places.astype(np.int64), shingles)
                old = [np.asarray(column[c][k].values, np.int64) for c in ("begins", "ends")]
                first, last = np.concatenate([old[0], begin]), np.concatenate([old[1], begin + block.length[window]])
                if len(first):
                    first, last = spans(cover(n, first.astype(np.int64), (last - first).astype(np.int64)))
                begins.append(first)
                ends.append(last)
                items.append(sorted({*column["items"][k].as_py(), *(listed[w] for w in np.unique(window))} - {None}))
            lists = lambda x, kind: pa.array([list(map(int, y)) for y in x], pa.list_(kind))
            yield pa.RecordBatch.from_arrays(
                [
                    *[column[n] for n in names if n not in ("begins", "ends", "items", "places", "shingles")],
                    lists(begins, pa.int32()),
                    lists(ends, pa.int32()),
                    lists(items, pa.int64()),
                ],
                names=[*(n for n in names if n not in ("begins", "ends", "items", "places", "shingles")), "begins", "ends", "items"],
            )

    return run


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Per row of ``docs``: id, n_words, begins and ends of the word spans that windows cover, items found (sorted)."""
    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    named = benchmark.select(F.col(item_column).cast("bigint").alias("item"), F.col(item_text).alias("text"))
    # equal windows of one item are one: only different ones can be dealt to different blocks
    windows = Stage(named.mapInArrow(_windows, "item bigint, length int, shingles array<bigint>").distinct(), "windows")
    total = windows.df.count()
    many = max(1, -(-total // BLOCK_WINDOWS))
    while total and many > 1:  # until no block is too large
        largest = windows.df.groupBy(F.pmod(F.xxhash64("item", "shingles"), F.lit(many)).alias("block")).count().agg(F.max("count")).first()[0]
        if largest <= BLOCK_WINDOWS:
            break
        many += max(1, many // 8)
    none = F.array().cast("array<int>")
    state = texts.select("id", "text", none.alias("begins"), none.alias("ends"), F.array().cast("array<bigint>").alias("items"))
    for b in range(many):
        own = windows.df.where(F.pmod(F.xxhash64("item", "shingles"), F.lit(many)) == b)
        block = _Block(own.toArrow())
        last = b == many - 1
        matched = Stage(
            state.select("id", "text", "begins", "ends", "items").mapInArrow(
                _match(block), "id bigint, text string, begins array<int>, ends array<int>, items array<bigint>, n_words bigint, places array<int>, shingles array<bigint>"
            ).drop(*(["text"] if last else [])),
            "matched",
        )
        held = matched.df.select(F.explode(F.array_distinct("shingles")).alias("shingle")).groupBy("shingle").count()
        block.rank({r[0]: r[1] for r in held.toLocalIterator()})  # at most one row per shingle of the block
        carried = ["id", "n_words"] if last else ["id", "text", "n_words"]
        schema = ", ".join({"id": "id bigint", "text": "text string", "n_words": "n_words bigint"}[c] for c in carried)
        state = matched.df.select(*carried, "begins", "ends", "items", "places", "shingles").mapInArrow(
            _verify(block), f"{schema}, begins array<int>, ends array<int>, items array<bigint>"
        )
    windows.drop()
    return state
