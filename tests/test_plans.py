"""Plans that would not hold at scale are failures."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry  # noqa: F401  (registers the queries)
from pairloom.operators import runs, splits
from pairloom.plans.registry import PLANS
from pairloom.sources import formats
from pairloom.sources.tables import table


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_products_and_no_global_windows(spark, folder, name):
    df = PLANS[name](spark, folder)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # only partial aggregates may meet in one task
            below = " ".join(lines[i + 1 : i + 4])
            assert "partial_" in below or "HashAggregate" in below, plan
    if not name.startswith(("code_", "action_", "quarantine")):
        assert "ArrowEvalPython" not in plan and "MapInPandas" not in plan and "BatchEvalPython" not in plan


def test_filters_and_columns_reach_the_scan(spark, folder):
    df = table(spark, folder, "lineitem").where(F.col("l_quantity") > 40).select("l_orderkey")
    plan = plan_of(df)
    assert "GreaterThan(l_quantity,40.0)" in plan and "l_comment" not in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_top_k_is_cut_before_the_shuffle(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_extendedprice")
    df = runs.top_per_group(rows, ["l_orderkey"], [F.desc("l_extendedprice")], F.lit(2), k_max=3)
    plan = plan_of(df)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_split_does_not_sort_everything(spark, folder):
    df = splits.shuffle_split(table(spark, folder, "events").select("event_id"), ["event_id"], 200)
    assert "rangepartitioning" not in plan_of(df)


def test_split_of_many_rows_is_exact(spark, monkeypatch):
    monkeypatch.setattr(splits, "FEW", 64)
    df = splits.shuffle_split(spark.range(150_000), ["id"], n_val=120_000)
    assert df.where("split = 'val'").count() == 120_000


def test_unknown_corpus_kind(spark):
    with pytest.raises(ValueError, match="unknown corpus kind"):
        formats.read_corpus(spark, "nothing")
