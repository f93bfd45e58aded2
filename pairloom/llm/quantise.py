"""Near-duplicate vectors by product quantisation with residual codes and an exact rerank.

Index. Vectors are scaled to length 1. A coarse quantiser (k-means on a sample of about ``SAMPLE`` vectors chosen by hash) puts every vector
into the cell of its nearest centroid, an inverted list; there are twice the square root of the vectors, ``MOST_CELLS`` at most. The residual is
cut into ``SUBSPACES`` parts, each coded by the nearest of ``CODES`` learned parts. The distance between a vector and its decoded form is kept
beside its code.

Search. Every vector is a query to the cells of its nearest centroids. A pair is found if either of the two looks into the other's cell. How many
probes suffice is measured on the sample: each sampled vector gets a partner at exactly the least cosine, in a random direction, and the number is
the least that finds ``RECALL`` of these pairs; closer pairs need fewer. In a cell the distances from the query to the decoded vectors come from one
table per subspace; a pair whose distance exceeds the limit by more than the decoding error cannot be a link. The others are reranked by the
cosine of the vectors themselves, in double precision: no link is ever below the limit.

Equal vectors are one class, so no copy is ever missed. A cell's vectors and its queries are dealt into blocks of about ``BLOCK``, and every pair of
blocks is one group, so no group grows with the data. A group returns counts, and a spanning forest of its links instead of the links.

Vectors that are null, empty, zero or hold a null or a non-finite number are linked with nothing; n_links is 0, the component their own id.
Vectors of different lengths are not linked; each length has a quantiser of its own. Rows without an id are linked with nothing and have no
component. Rows that repeat an id are one vector to the links: the sum of n_links is that of the id. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.graph import components
from pairloom.llm.stages import Stage

SAMPLE = 20_000
SUBSPACES = 8
CODES = 256
MOST_CELLS = 4096
BLOCK = 2048
COSINE = 0.95
RECALL = 0.999


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), np.int64)
    norm = (centres**2).sum(axis=1)
    for at in range(0, len(points), 4096):
        out[at : at + 4096] = (norm - 2 * points[at : at + 4096] @ centres.T).argmin(axis=1)
    return out


def k_means(points: np.ndarray, many: int, seed: int, rounds: int = 8) -> np.ndarray:
    random = np.random.Generator(np.random.PCG64(seed))
    centres = points[random.permutation(len(points))[:many]].copy()
    for _ in range(rounds):
        own = _nearest(points, centres)
        count = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, points)
        filled = count > 0
        centres[filled] = total[filled] / count[filled, None]
    return centres


class Quantiser:
    """Coarse centroids, the code book of each subspace, and how many cells a query looks into. Cells are numbered from ``first``."""

    def __init__(self, sample: np.ndarray, cells: int, cosine: float, first: int = 0) -> None:
        self.first = first
        self.centres = k_means(sample, min(cells, len(sample)), seed=1)
        residual = sample - self.centres[_nearest(sample, self.centres)]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.books = [k_means(residual[:, p], min(CODES, len(sample)), seed=2 + j) for j, p in enumerate(self.parts)]
        self.many = self._sufficient(sample[:4096], cosine)

    def _sufficient(self, points: np.ndarray, cosine: float) -> int:
        """The least number of probes by which ``RECALL`` of the pairs of points at this cosine find each other."""
        aside = np.random.Generator(np.random.PCG64(7)).normal(size=points.shape)
        aside -= (aside * points).sum(axis=1, keepdims=True) * points
        aside /= np.maximum(np.sqrt((aside**2).sum(axis=1, keepdims=True)), 1e-12)
        partners = cosine * points + np.sqrt(1 - cosine**2) * aside
        one, other = self._to_centres(points), self._to_centres(partners)
        row = np.arange(len(points))
        rank = lambda near, far: (near < near[row, far.argmin(axis=1)][:, None]).sum(axis=1) + 1
        return int(np.quantile(np.minimum(rank(one, other), rank(other, one)), RECALL, method="higher"))

    def _to_centres(self, unit: np.ndarray) -> np.ndarray:
        return (self.centres**2).sum(axis=1) - 2 * unit @ self.centres.T

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, code and decoding error of each vector."""
        cell = _nearest(unit, self.centres)
        residual = unit - self.centres[cell]
        code = np.stack([_nearest(residual[:, p], b) for p, b in zip(self.parts, self.books)], axis=1).astype(np.uint8)
        decoded = np.concatenate([b[code[:, j]] for j, b in enumerate(self.books)], axis=1)
        return cell, code, np.sqrt(((residual - decoded) ** 2).sum(axis=1))

    def probes(self, unit: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """The cells of the nearest centroids, a vector's own first."""
        away = self._to_centres(unit)
        away[np.arange(len(unit)), cell] = -np.inf
        return np.argpartition(away, self.many - 1, axis=1)[:, : self.many] if self.many < away.shape[1] else np.tile(np.arange(away.shape[1]), (len(unit), 1))

    def distances(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of queries to decoded vectors of a cell, by one table per subspace."""
        residual = queries - self.centres[cell]
        total = np.zeros((len(queries), len(codes)))
        for j, (p, book) in enumerate(zip(self.parts, self.books)):
            own = residual[:, p]
            table = (own**2).sum(axis=1)[:, None] + (book**2).sum(axis=1)[None] - 2 * own @ book.T
            total += table[:, codes[:, j]]
        return total


def _sound(kind: type):
    """id, vec -> id, length and bytes of the vectors that can be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            values = lists.values
            flat = values.to_numpy(zero_copy_only=False).astype(kind)  # a null becomes a NaN
            edge = lists.offsets.to_numpy()
            good = np.append(0, np.cumsum(np.isfinite(flat)))
            full = np.append(0, np.cumsum(flat != 0))
            width = np.diff(edge)
            whole = (good[edge[1:]] - good[edge[:-1]] == width) & (full[edge[1:]] > full[edge[:-1]])
            kept = np.flatnonzero(whole & ~np.asarray(batch.column(0).is_null()) & ~np.asarray(lists.is_null()))
            data = [flat[edge[k] : edge[k + 1]].tobytes() for k in kept]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept)), pa.array(width[kept].astype(np.int32)), pa.array(data, pa.binary())], names=["id", "width", "vec"])

    return run


def _matrix(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """Vectors of one length, scaled to length 1; by the largest component first, so that no square overflows."""
    rows = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1).astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


def _place(quantisers: dict[int, Quantiser], kind: type):
    """id, times, width, vec -> id, times, vec and cell, code, error, probes beside them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column(2).to_numpy()
            for width in np.unique(widths).tolist():
                members = np.flatnonzero(widths == width)
                for at in range(0, len(members), BLOCK):
                    part = batch.take(pa.array(members[at : at + BLOCK]))
                    quantiser = quantisers[width]
                    unit = _matrix(part.column(3), kind)
                    cell, code, error = quantiser.encode(unit)
                    probes = quantiser.probes(unit, cell)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0),
                            part.column(1),
                            part.column(3),
                            pa.array((cell + quantiser.first).astype(np.int32)),
                            pa.array([c.tobytes() for c in code], pa.binary()),
                            pa.array(error),
                            pa.array((probes + quantiser.first).astype(np.int32).tolist(), pa.list_(pa.int32())),
                        ],
                        names=["id", "times", "vec", "cell", "code", "error", "probes"],
                    )

    return run


def _search(quantisers: dict[int, Quantiser], cosine: float, kind: type):
    """One block of queries against one block of a cell -> links per vector, and each vector's root in the block's forest.

    A pair whose ends look into each other's cells meets twice; it counts where the smaller id asks.
    """
    reach = np.sqrt(2 - 2 * cosine)
    by_first = sorted(quantisers.values(), key=lambda x: x.first)
    begins = [x.first for x in by_first]

    def run(key: tuple, asking: pa.Table, listed: pa.Table) -> pa.Table:
        empty = pa.table({"id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        if not asking.num_rows or not listed.num_rows:
            return empty
        cell = key[0].as_py()
        quantiser = by_first[bisect_right(begins, cell) - 1]
        queries, vectors = _matrix(asking.column("vec"), kind), _matrix(listed.column("vec"), kind)
        ids, names = asking.column("id").to_numpy(), listed.column("id").to_numpy()
        own = asking.column("own").to_numpy()
        asked = np.sort(np.array(listed.column("probes").to_pylist(), np.int64), axis=1)
        codes = np.frombuffer(b"".join(listed.column("code").to_pylist()), np.uint8).reshape(len(names), -1)
        limit = (reach + listed.column("error").to_numpy()) ** 2 + 1e-6
        found_q, found_v = [], []
        for at in range(0, len(ids), 512):
            q, v = np.nonzero(quantiser.distances(queries[at : at + 512], cell - quantiser.first, codes) <= limit)
            q = q + at
            for b in range(0, len(q), 1 << 15):
                i, j = q[b : b + (1 << 15)], v[b : b + (1 << 15)]
                once = (ids[i] < names[j]) | ((ids[i] > names[j]) & ~(asked[j] == own[i][:, None]).any(axis=1))
                i, j = i[once], j[once]
                linked = (queries[i] * vectors[j]).sum(axis=1) >= cosine
                found_q.append(i[linked])
                found_v.append(j[linked])
        q, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_q, found_v))
        if not len(q):
            return empty
        nodes, which = np.unique(np.concatenate([ids, names]), return_inverse=True)
        a, b = which[: len(ids)][q], which[len(ids) :][v]
        links = np.bincount(a, weights=listed.column("times").to_numpy()[v], minlength=len(nodes))
        links += np.bincount(b, weights=asking.column("times").to_numpy()[q], minlength=len(nodes))
        root = np.arange(len(nodes))
        while True:  # least label along links, then along labels
            new = root.copy()
            np.minimum.at(new, a, root[b])
            np.minimum.at(new, b, root[a])
            new = new[new]
            if (new == root).all():
                break
            root = new
        has = np.flatnonzero(links)
        return pa.table({"id": pa.array(nodes[has]), "links": pa.array(links[has].astype(np.int64)), "root": pa.array(nodes[root[has]])})

    return run


def _train(classes: DataFrame, cosine: float, kind: type) -> dict[int, Quantiser]:
    """A quantiser for each length of vectors, from a sample of ``SAMPLE`` in all; a length that the sample leaves out has one cell."""
    sizes = {r[0]: r[1] for r in classes.groupBy("width").count().collect()}  # one row per length
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for w, n in sizes.items() for x in (w, min(1.0, SAMPLE / len(sizes) / n))])
    place = F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) / float(1 << 30)
    sample = classes.where(place < share[F.col("width")]).select("width", "vec").toArrow()
    widths = sample.column("width").to_numpy()
    out, first = {}, 0
    for width in sorted(sizes):
        own = sample.column("vec").filter(pa.array(widths == width))
        points = _matrix(own, kind) if len(own) else np.zeros((1, width))
        out[width] = Quantiser(points, max(1, min(MOST_CELLS, int(2 * sizes[width] ** 0.5))), cosine, first)
        first += len(out[width].centres)
    return out


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """Per row of ``vectors``: id, n_links, component (smallest id that links reach), kept."""
    small = vectors.schema[vector_column].dataType.simpleString() == "array<float>"
    kind, type_name = (np.float32, "array<float>") if small else (np.float64, "array<double>")
    every = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast(type_name).alias("vec"))
    rows = Stage(every.mapInArrow(_sound(kind), "id bigint, width int, vec binary").distinct(), "vectors")
    classes = Stage(rows.df.groupBy("width", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("times")), "classes")
    quantisers = _train(classes.df, cosine, kind)
    if not quantisers:
        rows.drop()
        classes.drop()
        return _alone(every)
    schema = "id bigint, times bigint, vec binary, cell int, code binary, error double, probes array<int>"
    placed = Stage(classes.df.select(F.col("rep").alias("id"), "times", "width", "vec").mapInArrow(_place(quantisers, kind), schema), "codes")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    held = placed.df.groupBy("cell").agg(F.count("*").alias("held"))
    asked = placed.df.select(F.explode("probes").alias("cell")).groupBy("cell").agg(F.count("*").alias("asked"))
    # One row per cell, MOST_CELLS at most for each length.
    counts = F.broadcast(held.join(asked, "cell").select("cell", blocks("held").alias("held"), blocks("asked").alias("asked")))
    steps = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    part = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    asking = placed.df.select("id", "times", "vec", F.col("cell").alias("own"), F.explode("probes").alias("cell")).join(counts, "cell")
    asking = asking.select("cell", part("asked").alias("q"), steps("held").alias("v"), "id", "times", "own", "vec")
    listed = placed.df.join(counts, "cell").select("cell", steps("asked").alias("q"), part("held").alias("v"), "id", "vec", "times", "code", "error", "probes")
    listed = listed.select(*[F.col(c).alias(c) for c in listed.columns])  # columns of its own, as both sides come from one table
    keys = ("cell", "q", "v")
    found = Stage(asking.groupBy(*keys).cogroup(listed.groupBy(*keys)).applyInArrow(_search(quantisers, cosine, kind), "id bigint, links bigint, root bigint"), "found")
    placed.drop()
    linked = components(found.df.select(F.col("id").alias("a"), F.col("root").alias("b")).where("a <> b"))
    links = found.df.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("links"))
    known = (
        classes.df.join(links, "rep", "left")
        .join(linked.df.withColumnRenamed("id", "rep"), "rep", "left")
        .select("width", "vec", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    )
    by_id = rows.df.join(known, ["width", "vec"]).groupBy("id").agg(F.sum("links").alias("links"), F.min("component").alias("component"))
    return _result(every.select("id").join(by_id, "id", "left"))


def _alone(every: DataFrame) -> DataFrame:
    return _result(every.select("id", F.lit(None).cast("bigint").alias("links"), F.lit(None).cast("bigint").alias("component")))


def _result(rows: DataFrame) -> DataFrame:
    component = F.coalesce("component", "id")
    return rows.select("id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
