"""Vocabularies: build, merge, encode, decode."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.operators.counts import first_seen_rows, token_rows
from pairloom.operators.lookup import IN_ROW_LIMIT, look_up_lists, lookup_join
from pairloom.operators.numbering import number_rows
from pairloom.session import fixed_table

# The first ids, in order, and the word that closes a run of primitives.
SPECIALS = ("[PAD]", "<s>", "</s>", "<unk>")
CLOSER = "Reduce_primitif"
PAD_ID, UNKNOWN_ID = 0, 3
SUBWORD_UNKNOWN_ID = 100  # the unknown id of a subword vocabulary


def vocabulary(df: DataFrame, tokens: str, order: Sequence[str], cutoff: int = 1) -> DataFrame:
    """Vocabulary of a column of token lists; row ``order`` must be unique per row of ``df``."""
    return vocabulary_of_rows(token_rows(df, tokens, *order), order, cutoff)


def vocabulary_of_rows(rows: DataFrame, order: Sequence[str], cutoff: int = 1) -> DataFrame:
    """word, id, freq of token rows (order columns, pos, token), read from a stage table.

    Specials first, then words by falling frequency (ties by first appearance), then the closing word
    unless it was ranked.
    """
    spark = rows.sparkSession
    seen = first_seen_rows(rows, order).where((F.col("freq") >= cutoff) & ~F.col("token").isin(*SPECIALS))
    ranked = number_rows(seen, [F.desc("freq"), F.asc("first")], "id", start=len(SPECIALS)).select(
        F.col("token").alias("word"), F.col("id").cast("bigint").alias("id"), "freq"
    )
    fixed = fixed_table(spark, [(word, i, 0) for i, word in enumerate(SPECIALS)], "word string, id bigint, freq bigint")
    end = ranked.agg(F.coalesce(F.max("id"), F.lit(len(SPECIALS) - 1)).alias("last"), F.count_if(F.col("word") == CLOSER).alias("closed"))
    closer = end.where("closed = 0").select(F.lit(CLOSER).alias("word"), (F.col("last") + 1).alias("id"), F.lit(0).cast("bigint").alias("freq"))
    return fixed.unionByName(ranked).unionByName(closer)


def merge_vocabulary(vocab: DataFrame, other: DataFrame) -> DataFrame:
    """``vocab`` followed by the words only ``other`` has, in the order of their ids there."""
    fresh = other.select("word", F.col("id").alias("other_id"), "freq").join(vocab.select("word"), "word", "left_anti")
    top = vocab.agg(F.max("id").alias("top"))
    added = number_rows(fresh, ["other_id"], "n").select(
        "word", (F.col("n") + F.coalesce(top.scalar(), F.lit(-1))).cast("bigint").alias("id"), "freq"
    )
    return vocab.select("word", "id", "freq").unionByName(added)


def category_codes(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Distinct categories in sorted order, numbered from 0."""
    return number_rows(df.select(column).distinct(), [column], name, start=0)


def lookup_ids(
    rows: DataFrame,
    vocab: DataFrame,
    unknown: int = UNKNOWN_ID,
    spread: Sequence[str] | None = None,
    token: str = "token",
    name: str = "id",
) -> DataFrame:
    """Token rows with the id of each token as ``name``, ``unknown`` when the vocabulary lacks it."""
    table = vocab.select(F.col("word").alias(token), F.col("id").alias("_found"))
    found = lookup_join(rows, table, [token], "left", spread)
    return found.withColumn(name, F.coalesce("_found", F.lit(unknown))).drop("_found")


def encode(df: DataFrame, tokens: str, vocab: DataFrame, key: Sequence[str], unknown: int = UNKNOWN_ID, limit: int = IN_ROW_LIMIT) -> DataFrame:
    """key, ids: each token list as a list of ids, in order. Empty and missing lists are empty lists.

    A vocabulary under ``limit`` is looked up in the row; a larger one once per block of rows and distinct token.
    """
    coded = look_up_lists(df, tokens, vocab, "word", "id", key, limit)
    return coded.select(*key, _each(tokens, lambda i: F.coalesce(i, F.lit(unknown).cast("bigint"))).alias("ids"))


def _each(lists: str, change: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.transform(lists, change), F.array())


def decode(df: DataFrame, ids: str, vocab: DataFrame, key: Sequence[str], limit: int = IN_ROW_LIMIT) -> DataFrame:
    """key, tokens: each id list as a list of words, in order; ids the vocabulary lacks are an error."""
    worded = look_up_lists(df.withColumn("_ids", F.col(ids)), ids, vocab, "id", "word", [*key, "_ids"], limit)

    def missing(i: Column) -> Column:
        return F.raise_error(F.concat(F.lit("no word has id "), F.coalesce(F.get("_ids", i).cast("string"), F.lit("null")))).cast("string")

    return worded.select(*key, F.coalesce(F.transform(ids, lambda w, i: F.coalesce(w, missing(i))), F.array()).alias("tokens"))


def unknown_rows(df: DataFrame, tokens: str, vocab: DataFrame, *keep: str) -> DataFrame:
    words = vocab.select(F.col("word").alias("token"))
    return lookup_join(token_rows(df, tokens, *keep), words, ["token"], "left_anti", [*keep, "pos"])


def known_rows(df: DataFrame, tokens: str, vocab: DataFrame, *keep: str) -> DataFrame:
    words = vocab.select(F.col("word").alias("token"))
    return lookup_join(token_rows(df, tokens, *keep), words, ["token"], "left_semi", [*keep, "pos"])


def fixed_vocabulary(df: DataFrame, column: str) -> DataFrame:
    """word, id, freq of a closed set of words (such as grammar actions): specials, then words in sorted order."""
    words = df.select(F.col(column).alias("word")).where(~F.col("word").isin(*SPECIALS)).distinct()
    numbered = number_rows(words, ["word"], "id", start=len(SPECIALS)).select(
        "word", F.col("id").cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("freq")
    )
    fixed = [(word, i, 0) for i, word in enumerate(SPECIALS)]
    return fixed_table(df.sparkSession, fixed, "word string, id bigint, freq bigint").unionByName(numbered)


def bundle(**vocabularies: DataFrame) -> DataFrame:
    """Several vocabularies as one table, told apart by ``vocab_name``."""
    named = [df.select(F.lit(name).alias("vocab_name"), "word", "id", "freq") for name, df in vocabularies.items()]
    return reduce(DataFrame.unionByName, named)
