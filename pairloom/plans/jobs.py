"""The three whole jobs: prepare a corpus, make the training feed, score predictions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from pairloom.functions.arrays import sort_by_length
from pairloom.functions.slots import fake_list_entries, fake_list_text, literal_slots, query_text, slot_entries, slot_text
from pairloom.functions.syntax import childless_nodes, grammar_rows
from pairloom.functions.text import SENTENCE_MARKERS, break_dotted, percent_s_fix, strip, tokenize_code, tokenize_ws, wrap_fragment, wrap_markers
from pairloom.operators import batching, code, metrics, splits, vocab
from pairloom.operators.rows import open_list
from pairloom.session import fixed_table, materialize
from pairloom.sources import formats


class Prepared(NamedTuple):
    """``kept`` is the corpus; ``rejected`` has every other row with its reason."""

    kept: DataFrame
    rejected: DataFrame


def grammar_names() -> list[str]:
    """The closed set of grammar actions, sorted."""
    fixed = ["Reduce", "Num", "Str", "Bytes", "NameConstant", "Ellipsis", "Index", "ExtSlice"]
    return sorted({row[0] for row in grammar_rows()} | set(childless_nodes()) | set(fixed))


def grammar_actions(spark) -> DataFrame:
    """The closed set of grammar actions, one ``token`` per row."""
    return fixed_table(spark, [(n,) for n in grammar_names()], "token string")


def prepare(df: DataFrame, keys: Sequence[str], intent: str, snippet: str, limit: int = code.LENGTH_LIMIT) -> Prepared:
    """Pairs to slots, tokens and actions; rows that fail a step or are too long are set apart.

    The request's quoted terms become slots in the request and in the code; list literals it quotes
    become bracketed slots. Tokens of the code come from the code as it was.
    """
    entries = F.col("slots")
    slotted = df.select(*keys, intent, snippet).withColumn("slots", slot_entries(intent))
    source = slotted.withColumn("_code", wrap_fragment(strip(snippet)))
    canonical = code.with_facts(source, "_code", "slotted", slots=entries).withColumnRenamed("status", "_first")
    filled = canonical.withColumn("_fakes", fake_list_entries(entries)).withColumn(
        "_code", fake_list_text("slotted", F.col("_fakes"))
    )
    parsed = code.with_facts(filled, "_code", "actions")
    rows = parsed.select(
        *keys,
        wrap_markers(tokenize_ws(F.lower(slot_text(intent, entries))), SENTENCE_MARKERS).alias("intent_tokens"),
        tokenize_code(snippet).alias("snippet_tokens"),
        code.action_words().alias("snippet_actions"),
        F.col("actions"),
        F.concat("slots", "_fakes").alias("slots"),
        F.when(F.col(intent).isNull(), F.lit("missing_intent"))
        .when(F.col("_first") != "ok", F.col("_first"))
        .otherwise(F.col("status"))
        .alias("_parsed"),
    )
    lengths = code.length_status(
        {"actions": F.size("actions"), "intent": F.size("intent_tokens"), "code": F.size("snippet_tokens")}, limit
    )
    stage = materialize(
        rows.withColumn("status", F.when(F.col("_parsed") == "ok", lengths).otherwise(F.col("_parsed"))).drop("_parsed"),
        "prepared",
    )
    return Prepared(stage.where("status = 'kept'"), stage.where("status <> 'kept'"))


def prepare_lines(
    df: DataFrame, order: Sequence[str], intent: str, snippet: str, variables: str, limit: int = code.LENGTH_LIMIT, n_test: int = 1805, n_dev: int = 1000
) -> Prepared:
    """Numbered line pairs to slots and tokens; the last kept lines are test, those before them dev, the rest train.

    Quoted literals of the request, then the names in ``variables`` (longest first), become slots; dotted names get their parts in brackets. A row
    is rejected without a request or code, or if one of its token lists is longer than ``limit``.
    """
    names = sort_by_length(F.coalesce(variables, F.array().cast("array<string>")))
    asked = df.select(*order, strip(intent).alias("_intent"), strip(snippet).alias("_code"), names.alias("_names"))
    slotted = asked.withColumn("slots", literal_slots("_intent", F.col("_names")))
    words = break_dotted(tokenize_ws(query_text("_intent", F.col("slots"), F.col("_names"))))
    rows = slotted.select(
        *order, tokenize_ws(percent_s_fix(F.array_join(words, " "))).alias("intent_tokens"), tokenize_code("_code").alias("snippet_tokens"), "slots"
    )
    lengths = code.length_status({"intent": F.size("intent_tokens"), "code": F.size("snippet_tokens")}, limit)
    missing = F.when(F.coalesce(F.size("intent_tokens"), F.lit(0)) < 1, F.lit("missing_intent")).when(
        F.coalesce(F.size("snippet_tokens"), F.lit(0)) < 1, F.lit("missing_code")
    )
    stage = materialize(rows.withColumn("status", F.coalesce(missing, lengths)), "lines")
    kept = splits.tail_split(stage.where("status = 'kept'"), order, n_test, n_dev)
    return Prepared(kept, stage.where("status <> 'kept'"))


def merged(annotated: DataFrame, mined: DataFrame, order: Sequence[str], n_mined: int) -> DataFrame:
    """Annotated rows plus the first ``n_mined`` mined ones."""
    return splits.stack({"annotated": annotated, "mined": splits.first_rows(mined, order, n_mined)})


class Feed(NamedTuple):
    """What training reads: the vocabularies, the batches with padded source ids and masks, the target steps."""

    vocabularies: DataFrame
    batches: DataFrame
    targets: DataFrame


def training_feed(
    kept: DataFrame, keys: Sequence[str], batch_size: int = 16, len_max: int = code.LENGTH_LIMIT, word_freq: int = 1, seed: int = 1
) -> Feed:
    """Vocabularies come from all kept rows; those over ``len_max`` are left out of batches and targets only."""
    train = kept.where(F.size("snippet_actions") <= len_max)
    spark = kept.sparkSession
    actions = vocab.fixed_vocabulary(grammar_actions(spark), "token")
    rules = materialize(actions.where(F.col("id") >= len(vocab.SPECIALS)).select(F.col("word").alias("token"), F.col("id").alias("rule_id")), "rules")
    primitive_rows = open_list(kept, "snippet_actions", *keys).join(F.broadcast(rules), "token", "left_anti")  # a closed set
    source = vocab.vocabulary(kept, "intent_tokens", keys, word_freq)
    primitive = vocab.vocabulary_of_rows(primitive_rows, keys, word_freq)

    placed = materialize(splits.assign_batches(train, keys, F.size("intent_tokens"), batch_size, seed), "batches")
    batches = batching.pad_batches(vocab.encode(train, "intent_tokens", source, keys), batching.mask_batches(placed), keys, "length", "mask")
    targets = batching.target_features(train, "intent_tokens", "snippet_actions", rules, primitive, *keys)
    return Feed(vocab.bundle(source=source, primitive=primitive, code=actions), batches, batching.primitive_mask(targets))


def score(truth: DataFrame, predictions: DataFrame, keys: Sequence[str], run: dict[str, str], path: str, metric: str = "BLEU") -> DataFrame:
    """Scores of a run; its error table goes to ``path`` in a folder named by the run and the score.

    ``truth`` has keys, intent and truth tokens; ``predictions`` keys and prediction tokens.
    """
    joined = materialize(metrics.join_predictions(truth, predictions, keys), "scored")
    report = materialize(metrics.evaluation(joined, "prediction", "truth", metric), "report")
    label = report.select(F.format_string(f"{metric}=%.4f", "value").alias("score"))
    errors = metrics.error_table(joined, "prediction", "truth", "intent")
    named = errors.select("*", *[F.lit(v).alias(k) for k, v in run.items()], label.scalar().alias("score"))
    formats.write_results(named, path, (*run, "score"))
    return report
