"""Jobs over a code column: validity, depth, actions, comments, docstrings, slots, preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions.syntax import code_facts
from pairloom.functions.text import strip, tokenize_code, wrap_fragment
from pairloom.operators.rows import open_structs

LENGTH_LIMIT = 150  # fixed value: longest request, code or action list that is kept


def with_facts(df: DataFrame, code: str, *want: str, wrap: bool = False, slots: Column | None = None) -> DataFrame:
    """Adds the wanted facts as columns; ``wrap`` completes loose lines first."""
    source = wrap_fragment(strip(code)) if wrap else F.col(code)
    facts = df.withColumn("_facts", code_facts(source, *want, slots=slots))
    names = dict.fromkeys(("status", *want))
    return facts.select(*df.columns, *[F.col(f"_facts.{n}").alias(n) for n in names])


def action_rows(df: DataFrame, *keep: str) -> DataFrame:
    """One row per action, with its step from 0."""
    return open_structs(df, "actions", *keep, pos="step")


def action_words(actions: str = "actions") -> Column:
    return F.transform(F.col(actions), lambda a: a["action"])


def length_status(limits: dict[str, Column], limit: int = LENGTH_LIMIT) -> Column:
    """kept, or the first of the named lengths that is over the limit."""
    status = F.lit("kept")
    for name, length in reversed(limits.items()):
        status = F.when(length > limit, F.lit(f"long_{name}")).otherwise(status)
    return status


def prepare_pairs(df: DataFrame, intent: Column, code: str, limit: int = LENGTH_LIMIT) -> DataFrame:
    """Every row with its tokens, actions and a ``status``: kept, too long, or why it could not be parsed.

    Nothing is dropped: ``where(status = 'kept')`` is the corpus, the rest is the quarantine.
    """
    parsed = with_facts(df, code, "actions", wrap=True)
    tokenized = parsed.withColumn("intent_tokens", intent).withColumn("snippet_tokens", tokenize_code(code))
    lengths = length_status(
        {
            "actions": F.size("actions"),
            "intent": F.size("intent_tokens"),
            "code": F.size("snippet_tokens"),
        },
        limit,
    )
    return tokenized.withColumn("status", F.when(F.col("status") == "ok", lengths).otherwise(F.col("status")))


def status_counts(df: DataFrame, *also: str) -> DataFrame:
    return df.groupBy("status", *also).agg(F.count(F.lit(1)).alias("n"))
