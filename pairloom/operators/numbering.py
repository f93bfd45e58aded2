"""Row numbers and running values over any amount of rows, also when one group holds most of them.

A window without (or with a hot) partition key would pull its rows into one task. Here rows are range
partitioned by their full order, so a hot group is cut into several chunks; chunk number and place in
the chunk are written down once. A number or running value is then the value inside the chunk plus
what the chunks before it carry in, which is one small row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.operators.lookup import lookup_join
from pairloom.session import materialize

CHUNK, PLACE = "_chunk", "_place"
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the place inside the partition in the low bits


def range_chunks(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """The rows sorted by ``order`` across the cluster, each with its chunk and place, in a stage table.

    ``order`` should tell all rows apart: then ties cannot pile up in one chunk and numbers are repeatable.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = ranged.withColumn("_mark", F.monotonically_increasing_id())
    return materialize(
        marked.withColumn(CHUNK, F.shiftright("_mark", _LOCAL_BITS).cast("int"))
        .withColumn(PLACE, F.col("_mark").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
        .drop("_mark"),
        "chunks",
    )


def _offsets(chunks: DataFrame, keys: Sequence[str], place: str) -> DataFrame:
    """Rows before each chunk, one row per chunk (a partition or file split)."""
    counted = chunks.groupBy(*keys).agg(F.min(place).alias("low"), F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(Window.orderBy(*keys)) - F.col("n")  # over a row per chunk, not over data rows
    return counted.select(*keys, (running - F.col("low")).alias("_before"))


def number_chunked(chunks: DataFrame, name: str, start: int = 1, keys: Sequence[str] = (CHUNK,), place: str = PLACE) -> DataFrame:
    """Consecutive numbers for a written table that already has chunk keys and places."""
    own = [f"_own{i}" for i in range(len(keys))]  # a key may be null: a file whose name has no part number
    marked = chunks.select("*", *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(o) for k, o in zip(keys, own)])
    before = materialize(_offsets(chunks, keys, place), "offsets")
    offsets = before.select(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(o) for k, o in zip(keys, own)], "_before")
    numbered = lookup_join(marked, offsets, own, "inner", [place]).drop(*own)
    return numbered.withColumn(name, F.col("_before") + F.col(place) + F.lit(start)).drop("_before", place, *keys)


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str = "row_no", start: int = 1) -> DataFrame:
    """Global row number by ``order``, counted from ``start``."""
    chunks = range_chunks(df, order)
    before = F.broadcast(_offsets(chunks, [CHUNK], PLACE))  # a row per range partition, however many rows there are
    return chunks.join(before, CHUNK).withColumn(name, F.col("_before") + F.col(PLACE) + F.lit(start)).drop("_before", PLACE, CHUNK)


class Running(NamedTuple):
    """A running value: ``kind`` is sum or max; an exclusive one leaves the row itself out."""

    name: str
    kind: str
    value: Column
    inclusive: bool = True


def running(chunks: DataFrame, group: Sequence[str], values: Sequence[Running]) -> DataFrame:
    """Running sums and maxima per group, in the order of ``range_chunks`` (which starts with the group)."""
    fold = {"sum": F.sum, "max": F.max}
    here = Window.partitionBy(CHUNK, *group).orderBy(PLACE)
    inclusive = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exclusive = here.rowsBetween(Window.unboundedPreceding, -1)

    # Only the first group of a chunk can have rows in chunks before it: at most one such pair per chunk.
    openers = chunks.where(F.col(PLACE) == 0).select(*group).distinct()
    totals = (
        chunks.join(F.broadcast(openers), list(group), "left_semi")
        .groupBy(*group, CHUNK)
        .agg(*[fold[v.kind](v.value).alias(f"_carry_{v.name}") for v in values])
    )
    earlier = Window.partitionBy(*group).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *group, CHUNK, *[fold[v.kind](f"_carry_{v.name}").over(earlier).alias(f"_carry_{v.name}") for v in values]
    )

    local = chunks.select("*", *[fold[v.kind](v.value).over(inclusive if v.inclusive else exclusive).alias(v.name) for v in values])
    joined = local.join(F.broadcast(carry), [*group, CHUNK], "left")

    def combined(v: Running) -> Column:
        inner, before = F.col(v.name), F.col(f"_carry_{v.name}")
        if v.kind == "max":
            return F.greatest(inner, before)  # skips nulls
        return F.coalesce(inner, F.lit(0)) + F.coalesce(before, F.lit(0))

    return joined.select(*chunks.columns, *[combined(v).alias(v.name) for v in values])


def number_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str = "row_no") -> DataFrame:
    """Row number inside each group; a hot group is spread over many tasks."""
    chunks = range_chunks(df, [*group, *order])
    return running(chunks, group, [Running(name, "sum", F.lit(1).cast("bigint"))]).drop(CHUNK, PLACE)
