"""Edges of ordered splits: found by counting ranges, without sorting the table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pairloom.operators import splits
from pairloom.session import materialize


@pytest.fixture(params=[splits.MOST_SORTED, 50])
def narrow(request, monkeypatch):
    """The second time ranges are narrowed down in many rounds, with few sampled ranks."""
    monkeypatch.setattr(splits, "MOST_SORTED", request.param)
    if request.param == 50:
        monkeypatch.setattr(splits, "SAMPLED", 40)


@pytest.fixture(scope="module")
def rows(spark):
    """3,000 rows whose order is two columns of different kinds, dealt at random."""
    keyed = spark.range(3000).select(F.floor(F.col("id") / 7).cast("string").alias("k"), (F.col("id") % 7 - 3).alias("p"), "id")
    return materialize(keyed.orderBy(F.xxhash64("id")).repartition(5))


def ordered(rows):
    return [r["id"] for r in sorted(rows.collect(), key=lambda r: (r["k"], r["p"]))]


@pytest.mark.parametrize("n", [1, 2, 333, 2999, 3000, 5000])
def test_first_rows(spark, rows, narrow, n):
    found = splits.first_rows(rows, ["k", "p"], n)
    assert sorted(r["id"] for r in found.collect()) == sorted(ordered(rows)[:n])


def test_row_at(spark, rows, narrow):
    every = ordered(rows)
    for position in (0, 1, 1500, 2999):
        assert [r["id"] for r in splits.row_at(rows, ["k", "p"], position).collect()] == [every[position]]
    assert splits.row_at(rows, ["k", "p"], 3000).count() == 0 and splits.row_at(rows, ["k", "p"], -1).count() == 0


@pytest.mark.parametrize("sizes", [(500, 300), (1, 0), (0, 5), (2990, 100), (4000, 10)])
def test_tail_split(spark, rows, narrow, sizes):
    test, dev = sizes
    every = ordered(rows)[::-1]
    expected = {i: "test" if k < test else "dev" if k < test + dev else "train" for k, i in enumerate(every)}
    assert {r["id"]: r["split"] for r in splits.tail_split(rows, ["k", "p"], test, dev).collect()} == expected


def test_missing_and_equal_ranks(spark, narrow):
    rows = spark.createDataFrame([(None,)] * 3 + [(5,)] * 400 + [(k,) for k in range(200)], "k bigint").repartition(4)
    assert splits.first_rows(rows, ["k"], 2).count() == 3
    assert splits.first_rows(rows, ["k"], 10).agg(F.max("k")).first()[0] == 5  # rows that tie with the last one come too
    assert splits.first_rows(rows, ["k"], 0).count() == 0
    assert splits.first_rows(rows.limit(0), ["k"], 3).count() == 0 and splits.tail_split(rows.limit(0), ["k"]).columns == ["k", "split"]


def test_no_sort_of_the_table(spark, rows):
    for df in (splits.tail_split(rows, ["k", "p"], 50, 30), splits.first_rows(rows, ["k", "p"], 10), splits.row_at(rows, ["k", "p"], 10)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "Window" not in plan
