"""Passages that an earlier document has too, found by fixed-block anchors.

A passage of ``WINDOW`` words holds at least one whole block of ``BLOCK`` = (WINDOW + 1) / 2 words that starts at a multiple of
BLOCK in the document it is taken from. So the non-overlapping blocks of every document are the index, and every
rolling window of BLOCK words of every document probes it. Only hits go on: a hit is extended to
all windows of WINDOW words that contain it, and a window is repeated if the same words start in a document of smaller id.
Runs of repeated windows are the maximal exact repeats of at least WINDOW words.

Index and probes meet in one exchange by hash. Tasks send them packed: one row per hash range with the ids of its
documents and 32-bit hash remainders, one entry per distinct window of a run of documents, so a passage that a third of
all documents hold costs one entry per run. Windows that two documents of a run share are hits at once. A false hit (equal remainders)
costs time only, as windows are compared by 64-bit hashes of all their words afterwards.

Null and empty texts have no words. Rows without an id are compared with nothing and keep all words. Rows that
repeat an id are one document: no window is removed because of another row of the same id. Words and their order
are kept, white space between kept words becomes one space. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.stages import Stage, carried, partitions, release, with_carried
from pairloom.llm.words import WHITE, blocks, cover, grams, utf8, words

WINDOW = 13
BLOCK = (WINDOW + 1) // 2
RUN_WORDS = 1 << 21  # words of the documents whose windows are combined before they are sent

_NONE = np.zeros(0, np.int64)


def _hashed(texts: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = utf8(texts)
    for first, last in blocks(offsets):
        low = offsets[first]
        hashes, _, _, at = words(data[low : offsets[last]], offsets[first : last + 1] - low, WHITE, lower=False)
        for k in range(last - first):
            yield hashes[at[k] : at[k + 1]]


def _packed(ids: np.ndarray, owner: np.ndarray, hashes: np.ndarray, bucket: np.ndarray, local: bool, width: type) -> pa.RecordBatch | None:
    """Entries (owner's id, hash) as one row per bucket: the ids, how many entries each has, and the entries."""
    if not len(hashes):
        return None
    order = np.lexsort((owner, bucket))
    owner, hashes, bucket = owner[order], hashes[order].astype(width), bucket[order]
    new = np.append(True, (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1]))
    begin = np.flatnonzero(new)  # of each (bucket, document)
    rows = np.flatnonzero(np.append(True, bucket[begin][1:] != bucket[begin][:-1]))
    ends = np.append(rows, len(begin)).astype(np.int32)
    counts = np.diff(np.append(begin, len(hashes))).astype(np.int32)
    byte = np.append(begin, len(hashes))[ends].astype(np.int64) * hashes.itemsize
    binary = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(byte), pa.py_buffer(hashes.tobytes())]).cast(pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[begin][rows].astype(np.int32)),
            pa.array(np.full(len(rows), local)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(ids[owner[begin]])),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(counts)),
            binary,
        ],
        names=["bucket", "local", "ids", "counts", "entries"],
    )


_ENTRIES = "bucket int, local boolean, ids array<bigint>, counts array<int>, entries binary"


def _probe(buckets: int):
    """id, text -> packed windows of BLOCK words. The lowest bit of an entry says: starts at a multiple of BLOCK."""
    shift = np.uint64(64 - (buckets - 1).bit_length())

    def send(ids: list[int], parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        names, doc_of = np.unique(np.array(ids, np.int64), return_inverse=True)
        owner = np.repeat(doc_of, [len(p) for p in parts])
        window = np.concatenate(parts)
        aligned = np.concatenate([np.arange(len(p)) % BLOCK == 0 for p in parts])
        order = np.argsort(window, kind="stable")
        sorted_, docs = window[order], owner[order]
        begin = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
        length = np.diff(np.append(begin, len(order)))
        low, high = np.minimum.reduceat(docs, begin), np.maximum.reduceat(docs, begin)
        anchor = np.maximum.reduceat(aligned[order], begin)
        place = lambda h: (h >> shift).astype(np.int64) if buckets > 1 else np.zeros(len(h), np.int64)
        first = docs[begin]
        entry = (sorted_[begin] & np.uint64(0xFFFFFFFE)) | anchor.astype(np.uint64)
        yield _packed(names, first, entry, place(sorted_[begin]), False, np.uint32)
        shared = np.repeat(low != high, length)
        if shared.any():  # found inside the run
            yield _packed(names, docs[shared], sorted_[shared] & np.uint64(0xFFFFFFFE), place(sorted_[shared]), True, np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        parts: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for i, hashes in zip(batch.column(0).to_pylist(), _hashed(batch.column(1))):
                if i is None or len(hashes) < WINDOW:
                    continue
                ids.append(i)
                parts.append(grams(hashes, BLOCK))
                held += len(hashes)
                if held >= RUN_WORDS:
                    yield from send(ids, parts)
                    ids, parts, held = [], [], 0
        if parts:
            yield from send(ids, parts)

    return run


def _meet(table: pa.Table) -> pa.Table:
    """One hash range: entries that an index block and a window of another run have in common, and the runs' own hits."""
    ids, entries, owner, run, local = [], [], [], [], []
    base = 0
    for k, (own, counts, raw, inside) in enumerate(zip(table["ids"].to_pylist(), table["counts"].to_pylist(), table["entries"].to_pylist(), table["local"].to_pylist())):
        part = np.frombuffer(raw, np.uint32)
        ids.append(np.array(own, np.int64))
        entries.append(part)
        owner.append(np.repeat(np.arange(base, base + len(own), dtype=np.int32), counts))
        run.append(np.full(len(part), k, np.int32))
        local.append(np.full(len(part), inside))
        base += len(own)
    ids, entry, owner, run, local = map(np.concatenate, (ids, entries, owner, run, local))
    key = entry & np.uint32(0xFFFFFFFE)
    order = np.lexsort((run, key))
    begin = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    length = np.diff(np.append(begin, len(order)))
    sent = ~local[order]
    many = np.add.reduceat(sent.astype(np.int64), begin) > 1
    anchored = np.bitwise_or.reduceat(entry[order] & np.uint32(1), begin) == 1
    hit = (np.repeat(many & anchored, length) & sent) | local[order]
    owner, key = owner[order][hit], key[order][hit]
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else _NONE
    byte = np.append(begin, len(key)).astype(np.int64) * 4
    hits = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(byte), pa.py_buffer(key.tobytes())]).cast(pa.binary())
    return pa.table({"id": pa.array(ids[owner[begin]] if len(owner) else _NONE), "bucket": pa.array(np.full(len(begin), table["bucket"][0].as_py(), np.int32)), "hits": hits})


def _extend(buckets: int):
    """id, text, hits -> per document its distinct windows of WINDOW words that contain a hit."""
    shift = np.uint64(64 - (buckets - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for hashes, groups in zip(_hashed(batch.column(1)), batch.column(2).to_pylist()):
                small = grams(hashes, BLOCK)
                place = (small >> shift) if buckets > 1 else np.zeros(len(small), np.uint64)
                key = (place << np.uint64(32)) | (small & np.uint64(0xFFFFFFFE))
                known = np.concatenate([(np.uint64(g["bucket"]) << np.uint64(32)) | np.frombuffer(g["hits"], np.uint32).astype(np.uint64) for g in groups])
                hit = np.flatnonzero(np.isin(key, known))
                long = grams(hashes, WINDOW)
                first = np.maximum(hit - (WINDOW - BLOCK), 0)
                last = np.minimum(hit, len(long) - 1)
                fits = first <= last
                out.append(np.unique(long[cover(len(long), first[fits], (last - first + 1)[fits])]))
            ends = np.cumsum([0, *map(len, out)]).astype(np.int32)
            flat = np.concatenate([*out, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["id", "windows"])

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text, hashes of repeated windows -> counts and the words that stay."""
    for batch in batches:
        total, gone, kept = [], [], []
        data, offsets = utf8(batch.column(1))
        lists = batch.column(2)
        for first, last in blocks(offsets):
            low = offsets[first]
            part = data[low : offsets[last]]
            hashes, begin, until, at = words(part, offsets[first : last + 1] - low, WHITE, lower=False)
            raw = part.tobytes()
            for k in range(first, last):
                b, e = int(at[k - first]), int(at[k - first + 1])
                text = raw[int(offsets[k] - low) : int(offsets[k + 1] - low)]
                total.append(e - b)
                if not lists[k].is_valid or e - b < WINDOW:
                    gone.append(0)
                    kept.append(b" ".join(text.split()))
                    continue
                repeated = np.asarray(lists[k].values).view(np.uint64)
                covered = cover(e - b, np.flatnonzero(np.isin(grams(hashes[b:e], WINDOW), repeated)), WINDOW)
                gone.append(int(covered.sum()))
                stay = np.flatnonzero(~covered) + b
                kept.append(b" ".join([raw[x:y] for x, y in zip(begin[stay].tolist(), until[stay].tolist())]))
        handed = {"text": batch.column(1), "row": batch.column(3)} if batch.num_columns > 3 else {}
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), *handed.values()],
            names=["id", "n_words", "n_removed", "kept", *handed],
        )


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_removed, and ``kept``: the words that stay, joined by one space.

    With ``keep``, also the text as it was and these columns as a struct ``row``.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    many = partitions(spark)
    buckets = 1 << max(many - 1, 1).bit_length()
    entries = texts.mapInArrow(_probe(buckets), _ENTRIES)
    hits = Stage(entries.groupBy("bucket").applyInArrow(_meet, "id bigint, bucket int, hits binary"), "hits")
    del entries
    release(spark)
    per_doc = hits.df.groupBy("id").agg(F.collect_list(F.struct("bucket", "hits")).alias("hits"))
    windows = Stage(texts.join(per_doc, "id").select("id", "text", "hits").mapInArrow(_extend(buckets), "id bigint, windows array<bigint>"), "windows")
    hits.drop()
    del per_doc
    release(spark)
    each = windows.df.select("id", F.explode("windows").alias("window"))
    earliest = each.groupBy("window").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("window", "first")
    repeated = Stage(
        each.join(earliest, "window").where("id > first").groupBy("id").agg(F.collect_list("window").alias("repeated")), "repeated"
    )
    windows.drop()
    del each, earliest
    release(spark)
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"), *carried(keep))
    schema = "id bigint, n_words bigint, n_removed bigint, kept string" + (", text string" if keep else "")
    joined = rows.join(repeated.df, "id", "left").select("id", "text", "repeated", *rows.columns[2:])
    return joined.mapInArrow(_remove, with_carried(schema, joined))
