"""Scores of predictions against truths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions.arrays import clipped_matches, joinable

MAX_WIDTH = 4


def join_predictions(truth: DataFrame, predictions: DataFrame, keys: Sequence[str], prediction: str = "prediction") -> DataFrame:
    """Every truth row with its prediction, by key; a missing prediction is an empty list."""
    joined = truth.join(predictions, list(keys), "left")
    return joined.withColumn(prediction, F.coalesce(prediction, F.array().cast("array<string>")))


def scorable(df: DataFrame, candidate: str, target: str, *keep: str) -> DataFrame:
    """keep, candidate, target with tokens made joinable once, ahead of all window widths."""
    return df.select(*keep, joinable(candidate).alias("candidate"), joinable(target).alias("target"))


def bleu_columns() -> list[Column]:
    """Sums that corpus BLEU needs over ``scorable`` rows: matches and windows per width, and both lengths."""
    candidate, target = "candidate", "target"
    sums = []
    for width in range(1, MAX_WIDTH + 1):
        sums.append(F.sum(clipped_matches(candidate, target, width)).alias(f"match_{width}"))
        sums.append(F.sum(F.greatest(F.size(candidate) - (width - 1), F.lit(0))).alias(f"total_{width}"))
    return [*sums, F.sum(F.size(candidate)).alias("candidate_length"), F.sum(F.size(target)).alias("target_length")]


def bleu_value() -> Column:
    """Corpus BLEU from the sums of ``bleu_columns``: 0 as soon as one width has no match."""
    logs = F.lit(0.0)
    matched = F.lit(True)
    for width in range(1, MAX_WIDTH + 1):
        matched = matched & (F.coalesce(F.col(f"match_{width}"), F.lit(0)) > 0)
        logs = logs + F.log(F.col(f"match_{width}") / F.col(f"total_{width}")) / MAX_WIDTH
    brevity = F.least(F.lit(1.0) - F.col("target_length") / F.col("candidate_length"), F.lit(0.0))
    return F.when(matched, F.exp(logs) * F.exp(brevity)).otherwise(F.lit(0.0))


def corpus_bleu(df: DataFrame, candidate: str, target: str, *by: str) -> DataFrame:
    """Unsmoothed corpus BLEU-4 with one target per row; nothing but the sums of each task is shuffled."""
    sums = scorable(df, candidate, target, *by).groupBy(*by).agg(*bleu_columns())
    return sums.select(*by, bleu_value().alias("bleu"))


def exact_match(df: DataFrame, candidate: str, target: str) -> DataFrame:
    return df.agg(F.avg((F.col(candidate) == F.col(target)).cast("double")).alias("accuracy"))


def evaluation(df: DataFrame, candidate: str, target: str, metric: str = "BLEU") -> DataFrame:
    """Both scores times 100 in one pass, the chosen one first."""
    if metric not in ("BLEU", "accuracy"):
        raise ValueError(f"unknown metric {metric!r}")
    hits = F.avg((F.col("candidate") == F.col("target")).cast("double")).alias("accuracy")
    scores = scorable(df, candidate, target).agg(*bleu_columns(), hits).select(
        (bleu_value() * 100).alias("BLEU"), (F.col("accuracy") * 100).alias("accuracy")
    )
    other = "accuracy" if metric == "BLEU" else "BLEU"
    return scores.select(F.lit(metric).alias("metric"), F.col(metric).alias("value"), F.col(other).alias("other_value"))


def error_table(df: DataFrame, candidate: str, target: str, *keep: Column | str) -> DataFrame:
    """Rows whose prediction is not the truth, both as text."""
    return df.where(F.col(candidate) != F.col(target)).select(
        *keep, F.array_join(target, " ").alias("truth"), F.array_join(candidate, " ").alias("prediction")
    )
