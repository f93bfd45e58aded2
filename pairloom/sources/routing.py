"""Rows sorted into kept and rejected ones in a single pass, with counts taken on the way."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F

from pairloom.session import fixed_table, fresh_path

BROKEN = "broken"


class Routed(NamedTuple):
    """``kept`` has the rows without a reason; ``rejects`` the raw record and the reason of all others; ``counts`` the rows per status."""

    kept: DataFrame
    rejects: DataFrame
    counts: DataFrame


def first_reason(reasons: dict[str, Column]) -> Column:
    """The name of the first condition that holds, or null."""
    named = F.lit(None).cast("string")
    for name, holds in reversed(reasons.items()):
        named = F.when(holds, F.lit(name)).otherwise(named)
    return named


def route(df: DataFrame, reasons: dict[str, Column], kept: Sequence[str], record: str, label: str = "routed") -> Routed:
    """Each row goes to one of two folders of one table, by the first of the named reasons that applies to it.

    The input is read once: a write that is partitioned by the side, while an observation counts rows and reasons. Both sides are read
    from the written table, so a second look at the rejects costs nothing of the scan. ``counts`` has a row for ``before``, ``kept`` and every
    reason, also those that no row has. A condition that is null does not hold.
    """
    spark = df.sparkSession
    marked = df.select(*kept, F.col(record).alias("_record"), first_reason(reasons).alias("_reason"))
    marked = marked.withColumn("_record", F.when(F.col("_reason").isNotNull(), F.col("_record"))).withColumn("_rejected", F.col("_reason").isNotNull())
    seen = Observation(label)
    tallies = [F.count_if(F.coalesce(F.col("_reason") == name, F.lit(False))).alias(f"r{k}") for k, name in enumerate(reasons)]
    path = fresh_path(spark, label)
    marked.observe(seen, F.count(F.lit(1)).alias("before"), *tallies).write.partitionBy("_rejected").parquet(path)
    found = seen.get
    each = [(name, found[f"r{k}"]) for k, name in enumerate(reasons)]
    rows = [("before", found["before"]), ("kept", found["before"] - sum(n for _, n in each)), *each]
    back = spark.read.schema(marked.schema).parquet(path)
    return Routed(
        back.where(~F.col("_rejected")).select(*kept),
        back.where("_rejected").select(F.col("_record").alias("record"), F.col("_reason").alias("reason")),
        fixed_table(spark, rows, "status string, n bigint"),
    )
