"""Kept and rejected rows of scans, and their counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairloom.session import fresh_path
from pairloom.sources import formats
from pairloom.sources.routing import route


def lines(spark, path, texts, compression="none"):
    formats.write_lines(spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1), path, compression)


def test_json_lines(spark):
    good = ['{"id":1,"name":"a","value":2}', '{"id":2}', ' {"id":3,"other":[1]} ']
    bad = ['{"id":4,"name":"a', "[1]", "null", "x", '{"id":"seven"}', '{"name":"no id"}', "{}"]
    for compression in ("none", "gzip"):
        path = fresh_path(spark, "lines")
        lines(spark, path, [*good, "", "  ", *bad], compression)
        found = formats.scan_json_lines(spark, path, "id bigint, name string, value int", ["id"])
        assert sorted(tuple(r) for r in found.kept.collect()) == [(1, "a", 2), (2, None, None), (3, None, None)]
        rejects = {r["record"]: r["reason"] for r in found.rejects.collect()}
        assert set(rejects) == set(bad) and rejects["{}"] == rejects['{"name":"no id"}'] == "missing_id"
        assert {rejects[b] for b in bad[:1] + bad[2:5]} == {"broken"}
        assert {r["status"]: r["n"] for r in found.counts.collect()} == {"before": 10, "kept": 3, **{s: sum(x == s for x in rejects.values()) for s in ("broken", "missing_id")}}


def test_nothing_kept_or_rejected_or_there(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    every = route(rows, {"bad": F.col("id") > 0}, ["id"], "t")
    assert every.kept.count() == 0 and every.kept.columns == ["id"] and every.rejects.count() == 2
    assert route(rows, {"bad": F.col("id") > 5}, ["id"], "t").rejects.count() == 0
    none = route(rows.limit(0), {"bad": F.col("id") > 5}, ["id"], "t")
    assert none.kept.count() == 0 and [r["n"] for r in none.counts.collect()] == [0, 0, 0]


def test_the_first_reason_counts_and_null_is_no_reason(spark):
    rows = spark.createDataFrame([(None, "x"), (5, "y"), (9, "z")], "id int, t string")
    found = route(rows, {"over_4": F.col("id") > 4, "over_8": F.col("id") > 8}, ["id"], "t")
    assert [r["id"] for r in found.kept.collect()] == [None]
    assert {r["status"]: r["n"] for r in found.counts.collect()} == {"before": 3, "kept": 1, "over_4": 2, "over_8": 0}


def test_one_pass(spark):
    """Every row is worked out once, though it may go to either side and is counted."""
    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return x

    rows = spark.range(100).select("id", F.udf(counted, "bigint")("id").alias("t"))
    found = route(rows, {"odd": F.col("id") % 2 == 1}, ["id"], "t")
    assert found.kept.count() == found.rejects.count() == 50 and seen.value <= 100


def test_csv_rejects(spark):
    path = fresh_path(spark, "csv")
    head, rows = "id,tokens,price", ['1,"[""a"",""b""]",2.5', "x,[],1.0", '2,"[""a""",1.0', "3,[],much", "4,[]", "5,[],1.0,9", "6,,"]
    lines(spark, path, [head, *rows])
    found = formats.scan_csv(spark, path, "id bigint, tokens array<string>, price double")
    assert sorted((r["id"], r["tokens"], r["price"]) for r in found.kept.collect()) == [(1, ["a", "b"], 2.5), (6, None, None)]
    reasons = {r["record"]: r["reason"] for r in found.rejects.collect()}
    assert sorted(reasons.values()) == ["bad_id", "bad_price", "bad_tokens", "broken", "broken"] and "5,[],1.0,9" in reasons


def test_csv_keeps_every_character(spark):
    texts = ["a\x00b", "\x00", "\\0", "\\\x00\\n\n\r\\", "", None, "\\\\", "a\\", '"', " b ", ","]
    path = fresh_path(spark, "csv")
    formats.write_csv(spark.createDataFrame(list(enumerate(texts)), "id int, t string"), path)
    for rows in (formats.read_csv(spark, path, "id int, t string"), formats.scan_csv(spark, path, "id int, t string").kept):
        assert [t for _, t in sorted((r["id"], r["t"]) for r in rows.collect())] == texts
