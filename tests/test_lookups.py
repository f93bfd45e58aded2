"""Look-ups: in the row, by blocks, and by salted joins, all with the same answers."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.operators import blocks, lookup, vocab
from pairloom.operators.blocks import recode_blocks
from pairloom.session import batches_of, fixed_table, materialize

LISTS = [
    (1, ["a", "b", "a", None, "zz"]),
    (2, []),
    (3, None),
    (3, ["b"] * 300),
    (None, ["", "é", "a"]),
]
IDS = {"a": 4, "b": 5, "": 6, "é": 7}


@pytest.fixture(scope="module")
def lists(spark):
    return spark.createDataFrame(LISTS, "id bigint, tokens array<string>")


@pytest.fixture(scope="module")
def words(spark):
    return fixed_table(spark, [(w, i) for w, i in IDS.items()] + [(f"w{k}", 100 + k) for k in range(50)], "word string, id bigint")


@pytest.mark.parametrize("limit", [lookup.IN_ROW_LIMIT, 0])
def test_lists_are_looked_up_item_by_item(spark, lists, words, limit):
    found = lookup.look_up_lists(lists, "tokens", words, "word", "id", ["id"], limit).collect()
    expected = [(i, None if t is None else [IDS.get(x) for x in t]) for i, t in LISTS]
    assert sorted(((r["id"], r["tokens"]) for r in found), key=str) == sorted(expected, key=str)
    none = lookup.look_up_lists(lists, "tokens", words.limit(0), "word", "id", ["id"], limit).collect()
    assert all(x is None for r in none for x in r["tokens"] or [])
    assert lookup.look_up_lists(lists.limit(0), "tokens", words, "word", "id", ["id"], limit).count() == 0


@pytest.mark.parametrize("limit", [lookup.IN_ROW_LIMIT, 0])
def test_encode_and_decode(spark, lists, words, limit):
    coded = vocab.encode(lists, "tokens", words, ["id"], limit=limit)
    assert sorted(((r["id"], r["ids"]) for r in coded.collect()), key=str) == sorted(((i, [IDS.get(x, 3) for x in t or []]) for i, t in LISTS), key=str)
    known = lists.where("id is null or (id = 3 and tokens is not null)")
    back = vocab.decode(vocab.encode(known, "tokens", words, ["id"], limit=limit), "ids", words, ["id"], limit=limit)
    assert sorted((r["tokens"] for r in back.collect()), key=str) == sorted([["b"] * 300, ["", "é", "a"]], key=str)
    with pytest.raises(Exception, match="no word has id 999"):
        vocab.decode(fixed_table(spark, [(1, [4, 999])], "id bigint, ids array<bigint>"), "ids", words, ["id"], limit=limit).collect()


def test_small_blocks(spark, lists, words):
    found = recode_blocks(lists.repartition(3), "tokens", words, "word", "id", ["id"], lookup.lookup_join, items=2)
    assert sorted(((r["id"], r["tokens"]) for r in found.collect()), key=str) == sorted(((i, None if t is None else [IDS.get(x) for x in t]) for i, t in LISTS), key=str)


def test_blocks_need_little_python(spark, lists, words):
    """One worker for each task, for the numbering alone, without pandas and on small batches; F2."""
    coded = vocab.encode(lists, "tokens", words, ["id"], limit=0)
    plan = vocab.decode(coded, "ids", words, ["id"], limit=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("zip_with(") == 1

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    wide = spark.range(40, numPartitions=1).select(F.array_repeat("id", 1 << 17).alias("tokens"))
    with batches_of(spark, blocks.BATCH):
        sent = materialize(wide.mapInArrow(sizes, "n bigint"))
        with batches_of(spark, 2 * blocks.BATCH):
            assert spark.conf.get(key) == str(blocks.BATCH)
    assert spark.conf.get(key) == before and blocks.BATCH <= 16 << 20
    assert sent.agg(F.max("n")).first()[0] <= blocks.BATCH + (2 << 20) and sent.count() > 1


def test_numbering_does_without_pandas():
    code = """
import sys, pyarrow as pa, pairloom.operators.blocks as b
b.TaskContext.get = staticmethod(lambda: type("", (), {"partitionId": lambda self: 1})())
o = pa.Array.from_buffers(pa.int32(), 4, [None, pa.py_buffer(bytes([0, 0, 0, 0, 2, 0, 0, 0, 2, 0, 0, 0, 3, 0, 0, 0]))])
l = pa.ListArray.from_arrays(o, pa.Array.from_buffers(pa.int8(), 3, [None, pa.py_buffer(bytes([7, 7, 9]))]))
batch = pa.RecordBatch.from_arrays([l.value_lengths(), l], ["keep", "lists"])
made = list(b._encoded(2)(iter([batch])))
assert "pandas" not in sys.modules
print([(x["block"][0], x["codes"][0], x["items"][0]) for m in made for x in [m.to_pydict()]] == [(1 << 33, [[0, 0], []], [7]), ((1 << 33) + 1, [[0]], [9])])
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, capture_output=True, text=True)
    assert done.stdout == "True\n", done.stderr


def test_encoding_needs_no_shuffle(spark, lists, words):
    plan = vocab.encode(materialize(lists), "tokens", words, ["id"])._jdf.queryExecution().executedPlan().toString()
    rows = plan.split("Subquery")[0]
    assert "Exchange" not in plan and "Generate" not in plan and "Sort" not in plan and rows.count("Project") == 1


@pytest.fixture
def skewed(spark, many_chunks):
    """A token in a third of all rows; the others are about as frequent as each other."""
    rows = spark.range(90_000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, F.lit("the")).otherwise(F.concat(F.lit("w"), F.col("id") % 5000)).alias("token"))
    return materialize(rows, "skewed")


def test_only_hot_keys_are_salted(spark, skewed):
    hot = {r["_hash"]: r["_salts"] for r in lookup.hot_keys(skewed, ["token"]).collect()}
    the = spark.range(1).select(F.xxhash64(F.lit("the"))).first()[0]
    assert list(hot) == [the] and 40 <= hot[the] <= 60


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_hot_key_is_spread(spark, skewed, how):
    table = fixed_table(spark, [("the", 1), *((f"w{k}", k) for k in range(0, 5000, 2))], "token string, id bigint")
    joined = lookup.lookup_join(skewed, table, ["token"], how, ["row"], limit=0)
    plain = skewed.join(table, "token", how)
    assert joined.columns == plain.columns and joined.exceptAll(plain).count() == 0 and plain.exceptAll(joined).count() == 0
    if how in ("inner", "left"):
        tasks = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert tasks[-1] < 2 * tasks[len(tasks) // 2]


def test_missing_keys_are_spread_too(spark, skewed):
    big = skewed.withColumn("token", F.when(F.col("token") != "the", F.col("token")))
    table = fixed_table(spark, [("w1", 1), (None, 2)], "token string, id bigint")
    joined = lookup.lookup_join(big, table, ["token"], "left", ["row"], limit=0)
    assert joined.count() == 90_000 and joined.where("id = 2").count() == 0
