"""Counts of tokens and windows, lengths, quantiles, overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType

from pairloom.functions.arrays import shared_distinct
from pairloom.functions.slots import without_slot_names
from pairloom.operators.rows import open_list
from pairloom.operators.windows import count_windows


def token_rows(df: DataFrame, tokens: str, *keep: str, token: str = "token", pos: str = "pos") -> DataFrame:
    """One row per token with its position from 0."""
    return open_list(df, tokens, *keep, item=token, pos=pos)


def token_counts(df: DataFrame, tokens: str) -> DataFrame:
    return open_list(df, tokens).groupBy("token").agg(F.count(F.lit(1)).alias("freq"))


def first_seen(df: DataFrame, tokens: str, order: Sequence[str]) -> DataFrame:
    """Per token its frequency and the first (row, position) it was seen at."""
    return first_seen_rows(token_rows(df, tokens, *order), order)


def first_seen_rows(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``first`` only serves as an order.

    With one whole-number row key it is packed with the position into a decimal, which a hash
    aggregate can keep in place; a struct would make Spark sort every token row instead. Row keys of 31 bits are
    compared as a long with the position, and become a decimal once per token.
    """
    if len(order) == 1 and isinstance(rows.schema[order[0]].dataType, LongType | IntegerType):
        key = F.col(order[0]).cast("bigint")
        short = key.between(0, (1 << 31) - 1)
        low = F.min(F.when(short, F.shiftleft(key, 32) + F.col("pos")))
        high = F.min(F.when(~short, _place(key, F.col("pos"))))
        seen = rows.groupBy("token").agg(F.count(F.lit(1)).alias("freq"), low.alias("_low"), high.alias("_high"))
        first = F.least("_high", _place(F.shiftright("_low", 32), F.col("_low").bitwiseAND(F.lit((1 << 32) - 1))))
        return seen.select("token", "freq", first.alias("first"))
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("freq"), F.min(F.struct(*order, "pos")).alias("first"))


def _place(row: Column, pos: Column) -> Column:
    packed = (row.cast("decimal(19,0)") * F.lit(10**10).cast("decimal(11,0)")).cast("decimal(38,0)")
    return (packed + pos.cast("decimal(10,0)")).cast("decimal(38,0)")


def vocabulary_stats(counts: DataFrame, cutoff: int) -> DataFrame:
    below = F.col("freq") < cutoff
    return counts.agg(
        F.count(F.lit(1)).alias("types"),
        F.count_if(F.col("freq") > 1).alias("repeated_types"),
        F.count_if(F.col("freq") == 1).alias("singletons"),
        F.coalesce(F.sum("freq"), F.lit(0)).alias("tokens"),
        F.count_if(below).alias("types_below"),
        F.coalesce(F.sum(F.when(below, F.col("freq"))), F.lit(0)).alias("tokens_below"),
    )


def length_stats(df: DataFrame, length: Column) -> DataFrame:
    return df.agg(
        F.count(length).alias("n"),
        F.max(length).alias("longest"),
        F.round(F.avg(length), 9).alias("mean"),
        F.round(F.var_pop(length), 9).alias("variance"),
    )


def length_quantiles(df: DataFrame, length: Column, shares: Sequence[float] = (0.5, 0.7, 0.8, 0.9, 0.95)) -> DataFrame:
    """Exact quantiles, interpolated. Lengths are counted first, so only distinct lengths meet in one task."""
    counted = df.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("n"))
    marks = counted.agg(F.percentile("length", list(shares), F.col("n")).alias("q"))
    pairs = F.arrays_zip(F.array(*[F.lit(float(s)) for s in shares]).alias("share"), F.col("q"))
    return marks.select(F.inline(pairs).alias("share", "length"))


def threshold_counts(df: DataFrame, length: Column, limits: Sequence[int] = (100, 200, 300, 1000)) -> DataFrame:
    return df.agg(*[F.count_if(length > n).alias(f"over_{n}") for n in limits])


def ngram_counts(df: DataFrame, tokens: str, width: int, include_last: bool = False) -> DataFrame:
    """Frequency of each window of ``width`` words; the last window of a sequence only on request."""
    return count_windows(df, tokens, width, include_last)


def gram_text(width: int, gram: str = "gram") -> Column:
    return F.concat_ws(" ", *[F.col(gram).getField(str(i)) for i in range(width)])


def frequency_of_frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy("freq").agg(F.count(F.lit(1)).alias("grams"))


def independent(counts: DataFrame, at_least: int = 3) -> DataFrame:
    return counts.agg(F.count(F.lit(1)).alias("distinct_grams"), F.count_if(F.col("freq") >= at_least).alias("frequent_grams"))


def overlap_total(df: DataFrame, a: str, b: str) -> DataFrame:
    """Shared distinct tokens summed over rows, without the names of slots, and all tokens of the first side."""
    return df.agg(
        F.coalesce(F.sum(F.size(without_slot_names(shared_distinct(a, b)))), F.lit(0)).alias("shared"),
        F.coalesce(F.sum(F.size(a)), F.lit(0)).alias("tokens"),
    )


def overlap_types(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct tokens that some row shares between its two sides, without the names of slots."""
    return open_list(df, without_slot_names(shared_distinct(a, b))).select("token").distinct()
