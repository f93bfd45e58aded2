"""Joins against a dimension table, and look-ups of whole lists without taking them apart.

A small table is broadcast. Beside a large one both sides are shuffled; a sketch of the big side's keys then finds those that fill more than
a piece of a task, and only these are salted, each by as many pieces as it needs, while the small side's rows are repeated for them alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.operators.blocks import recode_blocks
from pairloom.session import fixed_table, materialize

BROADCAST_LIMIT = 256 << 20  # bytes in memory
IN_MEMORY = 4  # bytes in a hash table for each byte of text, with a margin
PIECES = 16  # a key with more rows than this part of an even task is spread
PER_SLOT = 4  # pairs in a slot of a table that is looked up in the row
IN_ROW_LIMIT = 64 << 20  # bytes in memory of a table that every task gets with its plan


def measured(df: DataFrame) -> tuple[int, int]:
    """What a broadcast of the table would hold at most (its values as text, and IN_MEMORY times that in a hash table), and its rows."""
    size, rows = df.select(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.count(F.lit(1))).first()
    return IN_MEMORY * (size or 0), rows


def byte_size(df: DataFrame) -> int:
    return measured(df)[0]


def hot_keys(big: DataFrame, on: Sequence[str], pieces: int = PIECES) -> DataFrame:
    """_hash, _salts: keys with more rows than an even task's share in ``pieces``, and over how many salts to spread them.

    One pass with a frequent-items sketch, whose size follows the number of tasks and not the data; it may count a key a little too high,
    which only makes its salts more.
    """
    spark = big.sparkSession
    most = pieces * int(spark.conf.get("spark.sql.shuffle.partitions"))  # no more keys can have that many rows
    sketch = F.expr(f"approx_top_k(_hash, {most}, {4 * most})").alias("top")
    rows, top = big.select(F.xxhash64(*on).alias("_hash")).agg(F.count(F.lit(1)), sketch).first()
    even = max(rows // most, 1)
    hot = [(x["item"], -(-x["count"] // even)) for x in top or [] if x["count"] > even]
    return fixed_table(spark, hot, "_hash bigint, _salts bigint")


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread: Sequence[str] | None = None,
    limit: int = BROADCAST_LIMIT,
    salts: int | None = None,
) -> DataFrame:
    """Join ``big`` with ``small`` on ``on``; ``how`` is inner, left, left_semi or left_anti.

    Under the limit ``small`` is broadcast and ``big`` stays where it is. Over it both are shuffled; rows of ``big`` with a hot key are
    dealt out by a hash of ``spread`` (columns that differ inside a hot key). ``big`` and ``small`` are read twice and should be stage tables or
    otherwise cheap. With ``salts`` nothing is measured and every key is spread over that many.
    """
    if byte_size(small) <= limit:
        return big.join(F.broadcast(small), list(on), how)
    spread = list(spread or [c for c in big.columns if c not in on])
    if salts:
        sides = [df.withColumn("_salts", F.lit(salts)) for df in (big, small)]
    else:
        hot = F.broadcast(hot_keys(big, on))  # at most PIECES rows for each task
        sides = [df.withColumn("_hash", F.xxhash64(*on)).join(hot, "_hash", "left").drop("_hash") for df in (big, small)]
    many = F.coalesce("_salts", F.lit(1)).cast("bigint")
    salted = sides[0].withColumn("_salt", F.pmod(F.xxhash64(*spread), many)).drop("_salts")
    repeated = sides[1].withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), many - 1))).drop("_salts")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def balanced(df: DataFrame) -> DataFrame:
    """Spread the rows of a small scan over all cores, by turns and not by a key, so that later plans are those of a large scan."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _slots(small: DataFrame, key: str, value: str, many: int) -> DataFrame:
    """One row, one list: slot h holds the pairs of the keys whose hash is h. Written once."""
    pairs = small.select(_slot(F.col(key), many).alias("slot"), F.struct(key, value).alias("pair"))
    every = small.sparkSession.range(many).select(F.col("id").cast("int").alias("slot"), F.lit(None).cast(pairs.schema["pair"].dataType).alias("pair"))
    filled = pairs.union(every).groupBy("slot").agg(F.collect_list("pair").alias("pairs"))  # leaves nulls out
    listed = filled.agg(F.sort_array(F.collect_list(F.struct("slot", "pairs"))).alias("listed"))
    return materialize(listed.select(F.transform("listed", lambda x: F.map_from_entries(x["pairs"])).alias("slots")), "slots")


def _slot(item: Column, many: int) -> Column:
    return F.pmod(F.xxhash64(item), F.lit(many)).cast("int")


def look_up_lists(
    df: DataFrame, lists: str, small: DataFrame, key: str, value: str, keep: Sequence[str], limit: int = IN_ROW_LIMIT
) -> DataFrame:
    """Columns ``keep`` and ``lists`` with every item replaced by the ``value`` that ``small`` has for it, null if it has none.

    ``small`` has one row per ``key``. Under the limit it becomes a hash table in one value that all tasks hold, and every item is looked up
    in its row: nothing is exploded, shuffled or sorted. Over it each block of rows has its distinct items looked up once
    (``blocks``). A null list stays null, an empty one empty; a null item has no value.
    """
    size, rows = measured(small.select(key, value))
    if size > limit:
        return recode_blocks(df, lists, small, key, value, keep, lookup_join)
    many = 1 << (rows // PER_SLOT).bit_length()
    table = _slots(small, key, value, many)

    def found(item: Column) -> Column:
        return F.get("_slots", _slot(item, many))[item]

    return df.withColumn("_slots", table.scalar()).select(*keep, F.transform(lists, found).alias(lists))
