"""Repeatable shuffles, splits, merges and batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.operators.numbering import number_rows


def shuffle_key(keys: Sequence[str], seed: int) -> Column:
    """A hash that orders rows at random but always alike; ties are broken by the keys themselves."""
    return F.struct(
        F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))).alias("_hash"),
        *[F.col(k) for k in keys],
    )


PREFIX = 3  # hex digits by which the n-th hash is narrowed down at a time: 4096 groups
FEW = 4096  # rows of one hash group that may be sorted together


def _hash_edge(df: DataFrame, keys: Sequence[str], seed: int, n: int) -> DataFrame | None:
    """One row: the n-th smallest shuffle key, or the largest one if there are fewer; None for an empty table.

    Rows are counted by the first digits of their hash (partial counts, one small row per group), the group that holds the
    n-th place is counted by its next digits, and so on until few rows are left. No task gets more than these.
    """
    ranks = df.select(shuffle_key(keys, seed).alias("r"))
    prefix, left = "", max(n, 1)
    while True:
        size = len(prefix) + PREFIX
        group = F.substring("r._hash", 1, size).alias("g")
        inside = ranks.where(F.col("r._hash").startswith(prefix)) if prefix else ranks
        counted = sorted((r["g"], r["n"]) for r in inside.groupBy(group).agg(F.count(F.lit(1)).alias("n")).collect())
        if not counted:
            return None
        left = min(left, sum(rows for _, rows in counted))
        for prefix, rows in counted:
            if left <= rows:
                break
            left -= rows
        if rows <= FEW or size >= 32:
            return ranks.where(F.col("r._hash").startswith(prefix)).orderBy("r").limit(left).agg(F.max("r").alias("edge"))


SAMPLED = 4096  # ranks by which a range is narrowed down at a time
MOST_SORTED = 1 << 18  # ranks that one task may sort


def _literal(df: DataFrame, rank) -> Column:
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(rank, df.schema["r"].dataType)])


def _in_range(df: DataFrame, low, high) -> DataFrame:
    if low is not None:
        df = df.where(F.col("r") > _literal(df, low))
    return df if high is None else df.where(F.col("r") <= _literal(df, high))


def _order_edge(df: DataFrame, order: Sequence[str], n: int, last: bool = False, rows: int | None = None) -> DataFrame | None:
    """One row: the n-th smallest rank (or the n-th largest), or the outermost one if there are fewer; None for an empty table.

    A selection, not a sort. Ranks chosen by hash show about where the n-th place lies; the rows below and inside that range are counted,
    and the range is narrowed down the same way until one task can sort it. The counts are exact, so the sample decides only how many rounds it
    takes: each leaves a few hundredths of the rows.
    """
    ranks = df.select(F.struct(*order).alias("r"))
    inside = ranks.count() if rows is None else rows
    if not inside:
        return None
    left = min(max(n, 1), inside)
    left = inside - left + 1 if last else left  # the place, counted from the smallest rank in the range
    low = high = None
    while inside > MOST_SORTED:
        share = -(-SAMPLED * 2**32 // inside)
        drawn = _in_range(ranks, low, high).where(F.pmod(F.xxhash64("r"), F.lit(2**32)) < share).distinct().orderBy("r").collect()
        sample = [x["r"] for x in drawn]
        place = left / inside * len(sample)
        margin = 4 * (place * max(1 - left / inside, 0)) ** 0.5 + 2
        before, after = int(place - margin), int(place + margin)
        lower = sample[before] if 0 <= before < len(sample) else low
        upper = sample[after] if after < len(sample) else high
        now = _in_range(ranks, low, high)
        below = F.count_if(F.col("r") <= _literal(now, lower)) if lower is not None else F.lit(0)
        within = F.count_if(F.col("r") <= _literal(now, upper)) if upper is not None else F.count(F.lit(1))
        below, within = now.agg(below.alias("a"), within.alias("b")).first()
        if left <= below:
            change, high, inside = inside - below, lower, below
        elif left <= within:
            change, low, high, inside, left = inside - within + below, lower, upper, within - below, left - below
        else:
            change, low, inside, left = within, upper, inside - within, left - within
        if not change:  # the rest of the range is one rank, or nearly so
            break
    close = _in_range(ranks, low, high)
    if left <= inside - left + 1:
        return close.orderBy("r").limit(left).agg(F.max("r").alias("edge"))
    return close.orderBy(F.desc("r")).limit(inside - left + 1).agg(F.min("r").alias("edge"))


def shuffle_split(df: DataFrame, keys: Sequence[str], n_val: int = 200, seed: int = 1, name: str = "split") -> DataFrame:
    """The first ``n_val`` rows of the shuffle are val, the rest train. ``keys`` must tell the rows apart."""
    edge = _hash_edge(df, keys, seed, n_val)
    val = F.lit(False) if edge is None else shuffle_key(keys, seed) <= edge.scalar()
    return df.withColumn(name, F.when(val, F.lit("val")).otherwise(F.lit("train")))


def debug_split(df: DataFrame, keys: Sequence[str], n: int = 40, seed: int = 1) -> DataFrame:
    """``n`` rows of the shuffle, used as train and as val. ``keys`` must tell the rows apart."""
    edge = _hash_edge(df, keys, seed, n)
    picked = df.where(F.lit(False) if edge is None else shuffle_key(keys, seed) <= edge.scalar())
    return picked.withColumn("split", F.explode(F.array(F.lit("train"), F.lit("val"))))


def tail_split(df: DataFrame, order: Sequence[str], n_test: int = 1805, n_dev: int = 1000, name: str = "split") -> DataFrame:
    """In input order: the last ``n_test`` rows are test, the ``n_dev`` before them dev, the rest train.

    ``order`` must tell the rows apart; rows that tie with an edge go with it.
    """
    rank, rows = F.struct(*order), df.count()
    if not rows:
        return df.withColumn(name, F.lit("train"))
    edges = [_order_edge(df, order, n, last=True, rows=rows) for n in (n_test, n_test + n_dev)]
    test, dev = (rank >= e.scalar() if n else F.lit(False) for e, n in zip(edges, (n_test, n_test + n_dev)))
    return df.withColumn(name, F.when(test, F.lit("test")).when(dev, F.lit("dev")).otherwise(F.lit("train")))


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows by their source order. ``order`` must tell the rows apart; rows that tie with the last one come too."""
    edge = _order_edge(df, order, n) if n > 0 else None
    return df.where(F.lit(False) if edge is None else F.struct(*order) <= edge.scalar())


def row_at(df: DataFrame, order: Sequence[str], position: int) -> DataFrame:
    """The row at a position counted from 0; none when the table is shorter."""
    rows = df.count()
    if not 0 <= position < rows:
        return df.where(F.lit(False))
    return df.where(F.struct(*order) == _order_edge(df, order, position + 1, rows=rows).scalar())


def stack(parts: dict[str, DataFrame], origin: str = "origin") -> DataFrame:
    """Rows of all parts, each with the name of the part it came from."""
    named = [df.withColumn(origin, F.lit(name)) for name, df in parts.items()]
    stacked = named[0]
    for df in named[1:]:
        stacked = stacked.unionByName(df)
    return stacked


def assign_batches(df: DataFrame, keys: Sequence[str], length: Column, batch_size: int = 16, seed: int = 1) -> DataFrame:
    """Shuffled batches, the last one short; inside a batch the longest row comes first.

    Only keys and lengths are sorted across the cluster. A window then holds one batch.
    """
    slim = df.select(*keys, length.cast("bigint").alias("_length"))
    ranked = number_rows(slim, [shuffle_key(keys, seed)], "_rank", start=0)
    placed = ranked.withColumn("batch_id", F.floor(F.col("_rank") / batch_size).cast("bigint"))
    inside = Window.partitionBy("batch_id").orderBy(F.desc("_length"), "_rank")
    return (
        placed.withColumn("pos_in_batch", (F.row_number().over(inside) - 1).cast("bigint"))
        .withColumn("batch_longest", F.max("_length").over(Window.partitionBy("batch_id")))
        .select(*keys, "batch_id", "pos_in_batch", F.col("_length").alias("length"), "batch_longest")
    )
