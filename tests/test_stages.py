"""Stage tables: bucketed ones, reused ones, and results by run."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry  # noqa: F401  (registers the queries)
from pairloom.operators import batching
from pairloom.plans.registry import PLANS
from pairloom.session import _file_system, bucketed, fingerprint, fixed_table, fresh_path, materialize_once, shared_folder
from pairloom.sources import formats


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_meet_without_an_exchange(spark):
    left = bucketed(spark.range(500).select((F.col("id") % 50).alias("a"), (F.col("id") * 7).alias("b"), F.array("id").alias("ids")), ["a", "b"])
    right = bucketed(
        spark.range(500).select((F.col("id") % 50).alias("a"), (F.col("id") * 7).alias("b"), F.lit(0).alias("batch_id"), F.col("id").alias("pos_in_batch"), F.lit(2).alias("batch_longest")), ["a", "b"]
    )
    padded = batching.pad_batches(left, right, ["a", "b"])
    assert "Exchange" not in plan_of(padded) and "SortMergeJoin" in plan_of(padded)
    assert padded.count() == 500 and padded.where("ids[0] = pos_in_batch and ids[1] = 0").count() == 500


def test_padding_shuffles_no_pairs(spark, folder):
    assert "Exchange" not in plan_of(PLANS["pad_batch"](spark, folder)).split("Subquery")[0]


def test_copy_spots_are_linear_in_a_row(spark):
    many = 20_000
    rows = spark.range(1).select("id", F.array_repeat(F.lit("x"), many).alias("s"), F.concat(F.array_repeat(F.lit("x"), many), F.array(F.lit("y"))).alias("t"))
    (spot,) = batching.copy_spots(rows, "s", "t", "id").collect()
    assert spot["token"] == "x" and spot["positions"] == spot["steps"] == list(range(many))


def test_short_and_long_copy_forms_agree(spark):
    rows = spark.createDataFrame([(1, list("abcab"), list("bzab")), (2, [], ["a"]), (3, ["a"], []), (4, None, ["a"])], "id int, s array<string>, t array<string>")
    opened = batching.copy_spots(rows, "s", "t", "id").select("id", F.explode("steps").alias("step"), "token", "positions")
    steps = batching.copy_positions(rows, "s", "t", "id")
    assert opened.exceptAll(steps).count() == 0 and steps.exceptAll(opened).count() == 0 and steps.count() == 3


@pytest.fixture
def source(spark):
    path = fresh_path(spark, "source")
    spark.range(10).write.parquet(path)
    return path


def computed(spark, source, factor=2):
    return spark.read.parquet(source).select((F.col("id") * factor).alias("v"))


def stages(spark) -> list[str]:
    where, system = _file_system(spark, f"{shared_folder(spark)}/pairloom/reused")
    return sorted(f.getPath().getName() for f in system.listStatus(where)) if system.exists(where) else []


def test_a_second_run_reads_the_stage(spark, source):
    before = stages(spark)
    first = materialize_once(computed(spark, source), "doubled")
    assert sorted(r["v"] for r in first.collect()) == list(range(0, 20, 2))
    (name,) = set(stages(spark)) - set(before)
    path = f"{shared_folder(spark)}/pairloom/reused/{name}"
    written = spark.read.parquet(path).inputFiles()
    again = materialize_once(computed(spark, source), "doubled")
    assert again.inputFiles() == written and set(stages(spark)) - set(before) == {name}


def test_another_plan_or_other_files_are_another_stage(spark, source):
    first = fingerprint(computed(spark, source))
    assert fingerprint(computed(spark, source)) == first
    assert fingerprint(computed(spark, source, 3)) != first
    spark.range(5).write.mode("append").parquet(source)
    assert fingerprint(computed(spark, source)) != first
    assert materialize_once(computed(spark, source), "doubled").count() == 15
    assert fingerprint(fixed_table(spark, [(1,)], "a int")) != fingerprint(fixed_table(spark, [(2,)], "a int"))


def test_a_half_written_stage_is_not_taken(spark, source):
    df = computed(spark, source)
    path = f"{shared_folder(spark)}/pairloom/reused/halved-{fingerprint(df)}"
    df.limit(3).write.parquet(path)
    where, system = _file_system(spark, f"{path}/_SUCCESS")
    system.delete(where, False)
    assert materialize_once(df, "halved").count() == 10 and system.exists(where)
    assert not [n for n in stages(spark) if n.startswith("halved") and len(n) > len(path.rsplit("/", 1)[1])]


def test_a_run_replaces_its_own_results(spark):
    path = fresh_path(spark, "results")

    def errors(model, *rows):
        return spark.createDataFrame([(r, "d", model, 1) for r in rows], "intent string, dataset string, model string, beam int")

    formats.write_results(errors("a", "x", "y"), path)
    formats.write_results(errors("b", "z"), path)
    formats.write_results(errors("a", "x", "w", "v"), path)
    found = {(r["model"], r["intent"]) for r in spark.read.parquet(path).collect()}
    assert found == {("a", "x"), ("a", "w"), ("a", "v"), ("b", "z")} and spark.read.parquet(path).count() == 4
