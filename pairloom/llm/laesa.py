"""Vector codes by product quantisation in exact integers, with LAESA pivots to spare distance evaluations.

Components become integers, vectors are cut into ``PARTS`` equal parts, and every part position has a code book of ``ENTRIES``
entries that ``ROUNDS`` rounds refine. All arithmetic that decides a result is integer arithmetic, so codes, errors and code books do
not depend on how the rows are dealt.

Search. Of each first code book ``PIVOTS`` entries that lie far apart are fixed as pivots. The distance of every part to its pivots is
computed once and kept beside the part. In a round only the pivots' distances to the current entries are new; the greatest
difference |d(part, pivot) - d(entry, pivot)| bounds d(part, entry) from below. A part's entries are evaluated in the order of their
bounds, exactly, until the next bound exceeds the best distance found. Bounds are floating point and are lowered by
``_SLACK`` before they may rule out an entry; ties go to the lower index, so an entry that could tie is evaluated as well.

A round is one pass over a written table. A task adds up its parts per entry and returns one small row per entry and component; code
books are PARTS * ENTRIES rows and all that the driver ever holds.

Left out: vectors that are null or hold null or non-finite components. Vectors whose length is not a multiple of ``PARTS``, or shorter
than the longest, count as filled up with zeros at the end; an empty vector is all zeros. Rows without an id are coded too, but start a code book
only if there are fewer than ENTRIES rows with one; among equal ids the smaller vector comes first. With fewer vectors than entries a
code book is that much shorter. Scaled components are held to +-2^62 and errors to the largest long. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.stages import Stage
from pairloom.operators.lookup import lookup_join

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
PIVOTS = 4
_SLACK = 1e-5  # over the error of a pivot distance kept in single precision
_LARGEST = 1 << 62
_LONG = (1 << 63) - 1


class Compressed(NamedTuple):
    """``rows``: id, label, code, error, label_error; ``books``: the entries, part by part, as lists of integers."""

    rows: DataFrame
    books: list[list[list[int]]]

    def digest(self) -> str:
        flat = (str(x) for book in self.books for entry in book for x in entry)
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of a matrix, filled up with zeros."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), flat.dtype)
    out[np.arange(width) < size[:, None]] = flat
    return out


def scaled(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), held to a range that a long can hold."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * float(scale)), -_LARGEST, _LARGEST).astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray, wide: bool) -> np.ndarray:
    """Squared distances along the last axis; Python's integers where 64 bits could overflow."""
    gap = a.astype(object) - b.astype(object) if wide else a - b
    return (gap * gap).sum(axis=-1)


def far_apart(entries: np.ndarray, many: int) -> np.ndarray:
    """Pivots: the first entry, then always the one that is farthest from those chosen."""
    points = entries.astype(float)
    chosen = [0]
    while len(chosen) < min(many, len(points)):
        gap = ((points[:, None] - points[chosen]) ** 2).sum(axis=-1).min(axis=1)
        chosen.append(int(gap.argmax()))
    return entries[chosen]


def nearest(parts: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray, wide: bool = False) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of the nearest entry of each part, its squared distance, and how many distances were evaluated."""
    rows = np.arange(len(parts))
    between = np.sqrt(squared(pivots[:, None], entries[None], wide).astype(float))
    bound = np.abs(to_pivots[:, :, None] - between[None]).max(axis=1)
    reach = _SLACK * (to_pivots.max(axis=1)[:, None] + between.max(axis=0)[None])
    bound = np.maximum(bound - reach, 0)
    order = np.argsort(bound, axis=1, kind="stable")
    best = order[:, 0].copy()
    least = squared(parts, entries[best], wide)
    evaluated, left = len(parts), rows
    for k in range(1, len(entries)):
        candidate = order[left, k]
        possible = bound[left, candidate] ** 2 <= least[left].astype(float) * (1 + _SLACK)
        left, candidate = left[possible], candidate[possible]
        if not len(left):
            break
        found = squared(parts[left], entries[candidate], wide)
        evaluated += len(left)
        better = (found < least[left]) | ((found == least[left]) & (candidate < best[left]))
        best[left[better]], least[left[better]] = candidate[better], found[better]
    return best, least, evaluated


def _with_pivots(pivots: list[np.ndarray], width: int, scale: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = scaled(_matrix(batch.column("vector"), width * len(pivots)).astype(float), scale)
            parts = whole.reshape(len(whole), len(pivots), width)
            away = [np.sqrt(squared(parts[:, j, None], p[None], wide).astype(float)) for j, p in enumerate(pivots)]
            away = np.concatenate(away, axis=1).astype(np.float32)
            lists = [pa.ListArray.from_arrays(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1], m.ravel()) for m in (whole, away)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), *lists], ["id", "label", "whole", "away"])

    return run


def _assigned(batch: pa.RecordBatch, books: list[np.ndarray], pivots: list[np.ndarray], wide: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part position: the parts, their entries, their squared distances."""
    count, width, many = batch.num_rows, books[0].shape[1], len(pivots[0])
    whole = batch.column("whole").flatten().to_numpy().reshape(count, len(books), width)
    away = batch.column("away").flatten().to_numpy().astype(float).reshape(count, len(books), many)
    for j, (book, pivot) in enumerate(zip(books, pivots)):
        best, least, _ = nearest(whole[:, j], away[:, j], book, pivot, wide)
        yield whole[:, j], best, least


def _sums(books: list[np.ndarray], pivots: list[np.ndarray], wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, width = len(books[0]), books[0].shape[1]
        total = np.zeros((len(books), size, width), object)
        count = np.zeros((len(books), size), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            for j, (parts, best, _) in enumerate(_assigned(batch, books, pivots, wide)):
                here = np.zeros((size, width), object if wide else np.int64)
                np.add.at(here, best, parts.astype(here.dtype))
                total[j] += here
                count[j] += np.bincount(best, minlength=size)
        part, entry, place = (a.ravel() for a in np.indices(total.shape))
        used = count[part, entry] > 0
        part, entry, place = part[used], entry[used], place[used]
        sums = [str(x) for x in total[part, entry, place]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(place, pa.int32()), pa.array(sums, pa.string()), pa.array(count[part, entry], pa.int64())],
            ["part", "entry", "place", "total", "n"],
        )

    return run


def _codes(books: list[np.ndarray], pivots: list[np.ndarray], wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            best, least = zip(*[(b, d) for _, b, d in _assigned(batch, books, pivots, wide)])
            code = np.stack(best, axis=1).astype(np.uint8)
            error = [min(int(e), _LONG) for e in sum(d.astype(object) for d in least)]
            columns = [batch.column("id"), batch.column("label"), pa.array([row.tobytes().hex() for row in code]), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code", "error"])

    return run


def _refined(book: list[np.ndarray], rows: list) -> list[np.ndarray]:
    """Every used entry becomes the floor of its parts' mean."""
    out = [b.copy() for b in book]
    for r in rows:
        out[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return out


def compress(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Compressed:
    """Codes of all vectors and the code books; ``label_error`` is the sum of ``error`` over equal labels (nulls are equal)."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index must fit two hex digits")
    given = vectors.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = given.where(F.col("vector").isNotNull() & sound)
    longest, largest = kept.agg(F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x))))).first()
    width = max(1, -(-(longest or 0) // parts))
    largest = min(int(min((largest or 0.0) * scale, float(_LARGEST))) + 1, _LARGEST)
    wide = width * (2 * largest) ** 2 > _LONG
    first = kept.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()
    start = np.zeros((len(first), width * parts))
    for k, row in enumerate(first):
        start[k, : len(row["vector"])] = row["vector"]
    books = list(scaled(start, scale).reshape(len(first), parts, width).transpose(1, 0, 2))
    pivots = [far_apart(b, PIVOTS) for b in books] if len(first) else books

    types = {c: kept.schema[c].dataType.simpleString() for c in ("id", "label")}
    carried = f"id {types['id']}, label {types['label']}"
    measured = Stage(kept.mapInArrow(_with_pivots(pivots, width, scale, wide), f"{carried}, whole array<bigint>, away array<float>"), "pivots")
    for _ in range(rounds if len(first) else 0):
        partial = measured.df.mapInArrow(_sums(books, pivots, wide), "part int, entry int, place int, total string, n bigint")
        summed = partial.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        books = _refined(books, summed.collect())  # parts * entries * width rows
    coded = Stage(measured.df.mapInArrow(_codes(books, pivots, wide), f"{carried}, code string, error bigint"), "codes")
    measured.drop()

    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).alias("_label")
    by_label = coded.df.groupBy(key).agg(F.sum("error").alias("label_error"))
    rows = lookup_join(coded.df.select("*", key), by_label, ["_label"], "left", ["code", "error"]).drop("_label")
    return Compressed(rows, [[[int(x) for x in entry] for entry in book] for book in books])
