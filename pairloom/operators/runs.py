"""Run grids and metric logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.operators.numbering import CHUNK, PLACE, Running, range_chunks, running
from pairloom.session import materialize

START_METRIC = -0.1  # fixed value: the metric to beat before the first epoch


def expand_grid(configs: DataFrame) -> DataFrame:
    """One row per run: every list parameter of a configuration is opened, scalars are repeated.

    Opens lists inside each row; configurations never meet each other.
    """
    runs = configs
    for field in configs.schema:
        if field.dataType.typeName() == "array":
            runs = runs.withColumn(field.name, F.explode(field.name))
    return runs


def epoch_loss(batches: DataFrame, keys: Sequence[str] = ("run", "epoch")) -> DataFrame:
    """Loss per example of each epoch, from per-batch sums."""
    return batches.groupBy(*keys).agg((F.sum("loss") / F.sum("examples")).alias("loss"))


def metric_log(df: DataFrame, run: str, order: Sequence[str], value: str) -> DataFrame:
    """Chunked log (run, epoch, metric, best_before, is_better) as a stage table.

    ``is_better``: the metric beats every one before it, and the starting value.
    """
    slim = df.select(F.col(run).alias("run"), *order, F.col(value).alias("metric"))
    chunks = range_chunks(slim, ["run", *order])
    first = running(
        chunks,
        ["run"],
        [
            Running("epoch", "sum", F.lit(1).cast("bigint")),
            Running("_before", "max", F.col("metric"), inclusive=False),
        ],
    )
    best_before = F.greatest(F.coalesce("_before", F.lit(START_METRIC)), F.lit(START_METRIC))
    return materialize(
        first.select("run", "epoch", "metric", best_before.alias("best_before"), CHUNK, PLACE).withColumn(
            "is_better", F.col("metric") > F.col("best_before")
        ),
        "metric-log",
    )


def running_best(log: DataFrame) -> DataFrame:
    best = F.greatest("metric", "best_before")
    return log.select("run", "epoch", "metric", best.alias("best"), "is_better")


def patience_trials(log: DataFrame, patience: int, from_epoch: int, max_trials: int | None = None) -> DataFrame:
    """Stalls since the last better epoch, and the trials so far.

    From ``from_epoch`` on every epoch that is not better is a stall; each ``patience``-th stall is a
    trial and starts the count again. The log ends at trial ``max_trials``.
    """
    stalled = ~F.col("is_better") & (F.col("epoch") >= from_epoch)
    counted = materialize(running(log, ["run"], [Running("_stalls", "sum", stalled.cast("bigint"))]), "stalls")
    reset = F.when(F.col("is_better"), F.col("_stalls"))
    based = running(counted, ["run"], [Running("_base", "max", reset)])
    since = F.col("_stalls") - F.coalesce("_base", F.lit(0))
    marked = based.withColumn("_since", since).withColumn(
        "is_trial", stalled & (F.col("_since") % patience == 0) & (F.col("_since") > 0)
    )
    hits = materialize(marked, "trials")
    tried = running(hits, ["run"], [Running("trials", "sum", F.col("is_trial").cast("bigint"))])
    ended = tried
    if max_trials is not None:
        ended = tried.where((F.col("trials") < max_trials) | ((F.col("trials") == max_trials) & F.col("is_trial")))
    left = F.when(F.col("is_trial"), F.lit(0)).otherwise(F.col("_since") % patience).cast("bigint")
    return ended.select("run", "epoch", "metric", "is_better", left.alias("stalls"), "is_trial", "trials")


def best_per_group(df: DataFrame, group: Sequence[str], score: Column, *payload: str) -> DataFrame:
    """The payload of the highest score per group; partial maxima travel, not rows. Ties: the larger payload."""
    best = F.max_by(F.struct(*payload, score.alias("score")), F.struct(score, *payload))
    return df.groupBy(*group).agg(best.alias("b")).select(*group, "b.*")


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: Column | int, k_max: int | None = None) -> DataFrame:
    """The best ``k`` rows per group, ranked from 1; ``k`` may differ per group up to ``k_max``.

    The fixed bound lets each task drop all but ``k_max`` rows per group before the shuffle, so a hot
    group is never gathered. A larger ``k`` is an error, not a shorter answer.
    """
    if isinstance(k, int):
        bound, wanted = k, F.lit(k)
    else:
        if k_max is None:
            raise ValueError("a k that differs per group needs k_max")
        bound = k_max
        wanted = F.when(k <= k_max, k).otherwise(F.raise_error(F.lit(f"k is over {k_max}")).cast("int"))
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("rank") <= bound).where(F.col("rank") <= wanted)
