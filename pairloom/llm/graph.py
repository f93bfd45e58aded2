"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.llm.stages import Stage


def _state(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> Stage:
    """``id, component`` for every id with a link: the smallest id that links reach.

    Large and small stars in turn until nothing changes, each round a written table. A round takes a
    minimum per id (combined before the shuffle) and joins it back, so a hub with very many links is
    never gathered; its rows are split by the engine's skew handling. Links with a null end and links of an id
    with itself are left out.
    """
    begin = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where(f"{a} <> {b}").distinct()
    now = Stage(begin, "links")
    state = _state(now.df)
    while state[0]:
        both = now.df.select(F.col("hi").alias("node"), F.col("lo").alias("other")).union(now.df.select("lo", "hi"))
        least = both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))
        large = (
            both.where("other > node").join(least, "node").select(F.col("other").alias("hi"), F.col("least").alias("lo")).distinct()
        )
        lowest = large.groupBy("hi").agg(F.min("lo").alias("lowest"))
        small = large.join(lowest, "hi").select(
            F.explode(F.array(F.struct("hi", F.col("lowest").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("lowest").alias("lo")))).alias("link")
        )
        then = Stage(small.select("link.*").where("hi <> lo").distinct(), "links")
        now.drop()
        before, now, state = state, then, _state(then.df)
        if state == before:
            break
    ids = now.df.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(now.df.select("lo", "lo").distinct())
    result = Stage(ids, "components")
    now.drop()
    return result
