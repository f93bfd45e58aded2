"""Audit of five document filters in every order, over a sparse document-term matrix.

Matrix. Texts are cut into shards of about ``SHARD`` bytes (a longer text is a shard of its own). A shard numbers its own distinct words
and holds its rows as CSR: ``starts``, ``columns``, ``counts``. Only the shards' word lists are shuffled, each word once per shard however often it
occurs, so that a very common word is no hot key. They go to buckets by ranges of their hash, as one row for each shard and bucket; there are as
many buckets as the texts have ``BUCKET`` bytes, so one bucket stays small at any size. A bucket numbers its distinct words by their text, and every
shard gets the numbers of its words back and rewrites its columns. Row sums of the matrix are the numbers of words, the nonzero
counts are the numbers of distinct words; these decide the filters A and B.

Filters, as bits of ``fails``: A under 100 words; B 100 * distinct words < 80 * words; C 100 * [A-Z] characters > 10 * code points; D holds any of
``#$%&*|``; E identical to the text of a smaller id, table-wide.

Audit. Rows that agree in part, text, id and flags become one row with a count in the task already; copies of one text meet as
counts per part and label, never as rows. At most 32 combinations of failures per part and label remain, from which the
results of all 120 orders follow.

Null texts are empty: no words, A fails, no other filter does, and E compares them with empty texts. Rows without an id never fail E and
have no labels; they do not make others fail E. Rows that repeat an id are rows of their own and do not make each other fail
E. If labels repeat an id, one row that says 1 is enough. A null part is the empty string. An empty table gives no rows. Within a
shard words are told apart by 64-bit hashes, across shards by their text. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.stages import Stage
from pairloom.llm.words import WHITE, blocks, utf8, words
from pairloom.operators.lookup import lookup_join
from pairloom.session import fixed_table

SHARD = 2 << 20
BUCKET = 8 << 20
FILTERS = "ABCDE"
A, B, C, D, E = (1 << k for k in range(5))
FEWEST_WORDS = 100
DISTINCT_PERCENT = 80
UPPER_PERCENT = 10
SIGNS = b"#$%&*|"
_ROWS = "parts array<string>, digests array<binary>, fails array<int>, starts array<int>"


def _distinct_words(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The words at the given places."""
    size = end - begin
    ends = np.cumsum(size)
    at = np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))).cast(pa.string())


def _character_flags(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """C and D of each text, from its bytes; a code point is a byte that continues no other."""
    signs = np.zeros(256, bool)
    signs[list(SIGNS)] = True

    def per_text(hit: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(hit), offsets))

    upper, points = per_text((data >= 65) & (data <= 90)), np.diff(offsets) - per_text((data & 0xC0) == 0x80)
    return np.where(100 * upper > UPPER_PERCENT * points, C, 0) | np.where(per_text(signs[data]) > 0, D, 0)


def _csr(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, columns and counts of the rows, and the place of each column's first word; columns follow the words' hashes."""
    _, first, column = np.unique(hashes, return_index=True, return_inverse=True)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    cells, counts = np.unique((row.astype(np.int64) << 32) | column, return_counts=True)
    starts = np.searchsorted(cells, np.arange(len(at), dtype=np.int64) << 32)
    return starts.astype(np.int32), (cells & 0xFFFFFFFF).astype(np.int32), counts.astype(np.int32), first


def _one_row(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _local_shards(size: int, buckets: int):
    """For each shard its matrix, and its words as one row for each bucket: a range of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for first, last in blocks(offsets, size):
                low, high = offsets[first], offsets[last]
                here, within = data[low:high], offsets[first : last + 1] - low
                hashes, begin, end, at = words(here, within, WHITE, lower=False)
                starts, columns, counts, places = _csr(hashes, at)
                part = batch.slice(first, last - first)
                matrix = {
                    "ids": part.column("id"),
                    "parts": part.column("part"),
                    "digests": part.column("digest"),
                    "fails": pa.array(_character_flags(here, within), pa.int32()),
                    "starts": pa.array(starts),
                    "columns": pa.array(columns),
                    "counts": pa.array(counts),
                }
                ranges = ((hashes[places] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                filled, cut = np.unique(ranges, return_index=True)
                listed = pa.ListArray.from_arrays(np.append(cut, len(places)).astype(np.int32), _distinct_words(here, begin[places], end[places]))
                none = len(filled)
                rows = [pa.array(np.full(none + 1, number)), pa.array([None, *filled.tolist()], pa.int64())]
                rows += [pa.concat_arrays([_one_row(v), pa.nulls(none, pa.list_(v.type))]) for v in matrix.values()]
                rows.append(pa.concat_arrays([pa.nulls(1, listed.type), listed]))
                yield pa.RecordBatch.from_arrays(rows, ["shard", "bucket", *matrix, "words"])
                number += 1

    return run


def _numbered(bucket: pa.Table) -> pa.Table:
    """The words of a bucket numbered by their text; each shard's words as numbers."""
    listed = bucket.column("words").combine_chunks()
    number = listed.flatten().dictionary_encode().indices.cast(pa.int32())
    offsets = np.concatenate([[0], np.cumsum(np.diff(listed.offsets.to_numpy()))]).astype(np.int32)
    return pa.table({"shard": bucket.column("shard"), "bucket": bucket.column("bucket"), "number": pa.ListArray.from_arrays(offsets, number)})


def _global_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shards with global columns, in rising order within each row."""
    for batch in batches:
        for k in range(batch.num_rows):
            one = batch.slice(k, 1)
            starts, local, counts = (one.column(c).flatten().to_numpy() for c in ("starts", "columns", "counts"))
            bucket, number = one.column("numbers").flatten().flatten()
            many = np.diff(number.offsets.to_numpy())
            known = (np.repeat(bucket.to_numpy(), many) << 32) | number.flatten().to_numpy()
            column = known[local] if len(local) else np.zeros(0, np.int64)
            order = np.lexsort((column, np.repeat(np.arange(len(starts) - 1), np.diff(starts))))
            changed = {"columns": _one_row(pa.array(column[order], pa.int64())), "counts": _one_row(pa.array(counts[order], pa.int32()))}
            names = [n for n in one.schema.names if n != "numbers"]
            yield pa.RecordBatch.from_arrays([changed.get(n, one.column(n)) for n in names], names)


def _row_flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            one = batch.slice(k, 1)
            starts, counts, fails = (one.column(c).flatten().to_numpy() for c in ("starts", "counts", "fails"))
            total = np.diff(np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[starts])
            distinct = np.diff(starts).astype(np.int64)
            flags = fails | np.where(total < FEWEST_WORDS, A, 0) | np.where(100 * distinct < DISTINCT_PERCENT * total, B, 0)
            rows = [one.column(c).flatten() for c in ("ids", "parts", "digests")]
            yield pa.RecordBatch.from_arrays([*rows, pa.array(total), pa.array(distinct), pa.array(flags, pa.int32())], ["id", "part", "digest", "n_words", "n_distinct", "fails"])


def _flags_of_local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _row_flags(_global_columns(batches))


class Matrix:
    """The document-term matrix: ``shards`` (CSR over global columns) and ``dictionary`` (word, column); ``drop`` removes their table.

    A word's column is its bucket and its number in the bucket, as the high and the low half of a long.
    """

    def __init__(self, docs: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang", size: int = SHARD, bucket: int = BUCKET) -> None:
        whole = F.coalesce(F.col(text), F.lit(""))
        given = docs.select(
            F.col(id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(whole, 256)).alias("digest"), F.col(text).alias("text")
        )
        length = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = -(-length // bucket) or 1  # the words of all shards are never more than the texts
        rows = f"ids array<{given.schema['id'].dataType.simpleString()}>, {_ROWS}"
        local = given.mapInArrow(_local_shards(size, buckets), f"shard bigint, bucket bigint, {rows}, columns array<int>, counts array<int>, words array<string>")
        self._local = Stage(local, "shards")
        self._numbers = (
            self._local.df.where("bucket is not null").select("shard", "bucket", "words").groupBy("bucket").applyInArrow(_numbered, "shard bigint, bucket bigint, number array<int>")
        )
        numbers = self._numbers.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("bucket", "number"))).alias("numbers"))
        self._placed = self._local.df.where("bucket is null").drop("bucket", "words").join(numbers, "shard", "left")
        self.shards = self._placed.mapInArrow(_global_columns, f"shard bigint, {rows}, columns array<bigint>, counts array<int>")

    def row_flags(self) -> DataFrame:
        """id, part, digest, n_words (row sum), n_distinct (nonzero count) and the failures A to D of every row; columns and sums are made by one worker."""
        kind = self.shards.schema["ids"].dataType.elementType.simpleString()
        return self._placed.mapInArrow(_flags_of_local, f"id {kind}, part string, digest binary, n_words bigint, n_distinct bigint, fails int")

    @property
    def dictionary(self) -> DataFrame:
        listed = self._local.df.where("bucket is not null").select("shard", "bucket", "words").join(self._numbers, ["shard", "bucket"])
        pairs = listed.select("bucket", F.explode(F.arrays_zip("words", "number")).alias("w"))
        return pairs.select(F.col("w.words").alias("word"), (F.shiftleft("bucket", 32) + F.col("w.number")).alias("column")).distinct()

    def drop(self) -> None:
        self._local.drop()


def copies_of_texts(flags: DataFrame, labels: DataFrame, id: str = "doc_id") -> DataFrame:
    """One row for each text, part and label: how many rows, how many without an id, the smallest id and how many have it."""
    rows = flags.groupBy("id", "part", "digest", "fails").agg(F.count(F.lit(1)).alias("n"))
    known = labels.where(F.col(id).isNotNull()).groupBy(F.col(id).alias("id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("is_good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("is_toxic")
    )
    labelled = lookup_join(rows, known, ["id"], "left", ["digest", "part"])
    return labelled.groupBy("part", "digest", "fails", F.coalesce("is_good", F.lit(False)).alias("is_good"), F.coalesce("is_toxic", F.lit(False)).alias("is_toxic")).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("without_id"),
        F.min("id").alias("first"),
        F.min_by("n", "id").alias("of_first"),  # skips rows without an id
    )


def failure_counts(copies: DataFrame) -> DataFrame:
    """part, fails (A to E), n, good, toxic: the rows of each combination of failures."""
    least = copies.groupBy("digest").agg(F.min("first").alias("least"))
    met = copies.join(least, "digest")  # a text has few rows by now: one for each part and label
    stays = F.col("without_id") + F.when(F.col("first") == F.col("least"), F.col("of_first")).otherwise(F.lit(0))
    split = F.explode(F.array(F.struct(F.col("fails").alias("f"), stays.alias("m")), F.struct((F.col("fails") + E).alias("f"), (F.col("n") - stays).alias("m"))))
    opened = met.select("part", "is_good", "is_toxic", split.alias("s")).where("s.m > 0")
    return opened.groupBy("part", F.col("s.f").alias("fails")).agg(
        F.sum("s.m").alias("n"),
        F.sum(F.when(F.col("is_good"), F.col("s.m")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("s.m")).otherwise(0)).alias("toxic"),
    )


def _steps() -> list[tuple[str, int, int, int]]:
    """Every step of every order: the order, the step, the filters before it, its own filter."""
    found = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << FILTERS.index(letter)
            found.append((order, step, before, own))
            before |= own
    return found


def every_order(counts: DataFrame) -> DataFrame:
    """What each filter does at each step of each order, from the counts of ``failure_counts``."""
    steps = fixed_table(counts.sparkSession, _steps(), "filter_order string, step int, before int, own int")
    here = counts.select("*", F.explode(F.lit([1 << k for k in range(len(FILTERS))])).alias("own")).join(F.broadcast(steps), "own")  # 600 steps
    fails, before, own = F.col("fails"), F.col("before"), F.col("own")
    earlier, failing = fails.bitwiseAND(before) != 0, fails.bitwiseAND(own) != 0

    def total(condition: Column, value: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(0)).cast("bigint")

    orders = sum(1 for _ in permutations(FILTERS))
    return here.groupBy("part", "filter_order", "step").agg(
        total(~earlier & ~failing).alias("kept"),
        total(failing & ~earlier).alias("removed"),
        total(failing & earlier).alias("redundant"),
        total(fails == own).alias("unique_fails"),
        total(failing & ~earlier, "good").alias("good_lost"),
        total(failing & ~earlier, "toxic").alias("toxic_lost"),
        # in the orders, each of a row's failures comes first equally often
        F.sum(F.when(failing, F.col("n") * F.floor(F.lit(orders) / F.bit_count("fails"))).otherwise(0)).cast("bigint").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """For each part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    matrix = Matrix(docs, id, text, part)
    copies = Stage(copies_of_texts(matrix.row_flags(), labels, id), "copies")
    matrix.drop()
    counts = Stage(failure_counts(copies.df), "failures")
    copies.drop()
    return every_order(counts.df)
