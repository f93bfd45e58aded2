"""Windows of items counted exactly, without sending each window by itself.

Windows that follow one another overlap in all but one item. A task cuts its lists into runs of windows that share their smallest part (``PART``
consecutive items, by hash), sends each distinct run once per block with its count, and all runs with one smallest part meet in one bucket: so
do all occurrences of a window. A bucket is opened and its windows are compared item by item; hashes only deal out. The number
of buckets follows the size of the input, a bucket's size does not.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

ITEMS = 1 << 21  # items that are cut into runs at once
PART = 3
LONGEST = 64  # windows of a run
BUCKETS = 64  # for each partition of the input
ROWS = 1 << 16  # windows that leave a worker at once
_ITEM, _RUN, _ESCAPE = "\x1f", "\x1e", "\x1d"
_ESCAPED = ((_ESCAPE, _ESCAPE + "e"), (_ITEM, _ESCAPE + "i"), (_RUN, _ESCAPE + "r"))
_NULL = _ESCAPE + "n"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _escaped(items: pa.Array) -> pa.Array:
    """Items in which no separator occurs; a null has its own mark. Different items stay different."""
    for plain, marked in _ESCAPED:
        items = pc.replace_substring(items, plain, marked)
    return items.fill_null(_NULL)


def _plain(items: pa.Array) -> pa.Array:
    items = pc.if_else(pc.equal(items, _NULL), pa.scalar(None, pa.string()), items)
    for plain, marked in reversed(_ESCAPED):
        items = pc.replace_substring(items, marked, plain)
    return items


def _coded(items: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each item's number, and the distinct items."""
    coded = items.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def _spread(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Places first, first + 1, ... of each range, one after the other."""
    ends = np.cumsum(many)
    return np.repeat(first - (ends - many), many) + np.arange(int(ends[-1]) if len(ends) else 0)


def _runs(lists: pa.ListArray, width: int, short: int, buckets: int) -> pa.RecordBatch:
    """Distinct runs of the lists' windows by bucket: bucket, the runs' text (compressed), how often each occurs."""
    part = min(PART, width)
    codes, distinct = _coded(_escaped(lists.flatten()))
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin = np.cumsum(size) - size
    starts = _spread(begin, np.maximum(size - short, 0))
    own = _mix(np.array([zlib.crc32(t.encode()) for t in distinct.to_pylist()], np.uint64) * _ODD)[codes]
    hashed = np.zeros(len(codes), np.uint64)
    for i in range(part):
        hashed[: len(codes) - i] = _mix(hashed[: len(codes) - i] * _ODD + own[i:])
    smallest = hashed[starts]
    for i in range(1, width - part + 1):
        np.minimum(smallest, hashed[starts + i], out=smallest)
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != starts[:-1] + 1) | (smallest[1:] != smallest[:-1])
    new[np.searchsorted(starts, begin[size > short])] = True
    place = np.arange(len(new))
    new |= (place - np.maximum.accumulate(np.where(new, place, 0))) % LONGEST == 0  # so that one item over and over makes equal runs
    first = np.flatnonzero(new)
    many = np.diff(np.append(first, len(starts))) + width - 1
    items = distinct.take(pa.array(codes[_spread(starts[first], many)]))
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(many)).astype(np.int32)), items), _ITEM)
    which, texts = _coded(texts)
    bucket = np.zeros(len(texts), np.int64)
    bucket[which] = (smallest[first] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    found, at = np.unique(bucket[order], return_index=True)
    at = np.append(at, len(order))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), texts.take(pa.array(order))), _RUN)
    times = np.bincount(which, minlength=len(texts))[order].astype("<i4")
    packed = [(pa.compress(t.as_buffer(), "zstd", asbytes=True), t.as_buffer().size) for t in joined]
    counts = [pa.compress(times[a:b].tobytes(), "zstd", asbytes=True) for a, b in zip(at[:-1], at[1:])]
    columns = [pa.array(found), pa.array([p for p, _ in packed], pa.binary()), pa.array([n for _, n in packed], pa.int64())]
    return pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.binary()), pa.array(np.diff(at))], ["bucket", "runs", "size", "times", "n"])


def _cut(width: int, short: int, buckets: int, items: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(batch.column(0)), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + items, "right")) - 1)
                found = _runs(batch.column(0).slice(first, last - first), width, short, buckets)
                if found.num_rows:
                    yield found
                first = last

    return run


def _bucket_counts(held: list[tuple[bytes, int, bytes, int]], width: int) -> Iterator[pa.RecordBatch]:
    """The windows of one bucket, each with its frequency."""
    texts = pa.chunked_array([pc.split_pattern(pa.array([pa.decompress(r, size, "zstd", asbytes=True).decode()]), _RUN).flatten() for r, size, _, _ in held])
    times = np.concatenate([np.frombuffer(pa.decompress(t, 4 * n, "zstd", asbytes=True), "<i4") for _, _, t, n in held])
    lists = pc.split_pattern(texts.combine_chunks(), _ITEM)
    codes, distinct = _coded(lists.flatten())
    size = lists.value_lengths().to_numpy().astype(np.int64)
    starts = _spread(np.cumsum(size) - size, size - (width - 1))
    weight = np.repeat(times, size - (width - 1)).astype(np.int64)
    key, most, base = codes[starts].astype(np.int64), len(distinct), len(distinct)
    for i in range(1, width):
        if most * base >= 1 << 62:
            numbers, key = np.unique(key, return_inverse=True)
            most = len(numbers)
        key = key * base + codes[starts + i]
        most *= base
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    freq, place, words = np.add.reduceat(weight[order], first), starts[order[first]], _plain(distinct)
    for at in range(0, len(place), ROWS):
        rows = place[at : at + ROWS]
        gram = pa.StructArray.from_arrays([words.take(pa.array(codes[rows + i])) for i in range(width)], [str(i) for i in range(width)])
        yield pa.RecordBatch.from_arrays([gram, pa.array(freq[at : at + ROWS])], ["gram", "freq"])


def _counted(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = [], None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if held and row[0] != bucket:
                    yield from _bucket_counts(held, width)
                    held = []
                bucket = row[0]
                held.append(row[1:])
        if held:
            yield from _bucket_counts(held, width)

    return run


def count_windows(df: DataFrame, lists: str, width: int, include_last: bool, items: int = ITEMS) -> DataFrame:
    """gram (struct of ``width`` strings), freq: each distinct window of a column of string lists, and how often it occurs."""
    buckets = BUCKETS * df.rdd.getNumPartitions()
    cut = df.select(lists).mapInArrow(_cut(width, width - 1 if include_last else width, buckets, items), "bucket bigint, runs binary, size bigint, times binary, n bigint")
    # By bucket and in its order, so that a task holds one bucket at a time.
    met = cut.repartition("bucket").sortWithinPartitions("bucket")
    fields = ", ".join(f"`{i}`: string" for i in range(width))
    return met.mapInArrow(_counted(width), f"gram struct<{fields}>, freq bigint")
