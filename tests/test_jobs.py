"""The whole jobs on a corpus small enough to follow."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from pairloom.plans import jobs
from pairloom.session import fresh_path
from pairloom.sources import formats

CORPUS = [
    {"question_id": 1, "intent": "open it", "rewritten_intent": "open file `name` as 'r'", "snippet": "f = open(name, 'r')"},
    {"question_id": 2, "intent": "sum `[1, 2]` into `total`", "rewritten_intent": None, "snippet": "total = sum([1, 2])"},
    {"question_id": 3, "intent": "broken", "rewritten_intent": "", "snippet": "return foo("},
    {"question_id": 4, "intent": "loop over xs", "rewritten_intent": None, "snippet": "for x in xs:"},
    {"question_id": 5, "intent": "long", "rewritten_intent": None, "snippet": "print(" + ", ".join(["x"] * 60) + ")"},
]
SCHEMA = "question_id bigint, intent string, rewritten_intent string, snippet string"


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus") / "train.json"
    path.write_text(json.dumps(CORPUS))
    corpus = formats.read_corpus(spark, "json_array", str(path), SCHEMA)
    pairs = corpus.select("question_id", F.coalesce("rewritten_intent", "intent").alias("intent"), "snippet")
    return jobs.prepare(pairs, ["question_id"], "intent", "snippet")


def test_prepare(prepared):
    kept = {r["question_id"]: r for r in prepared.kept.collect()}
    rejected = {r["question_id"]: r["status"] for r in prepared.rejected.collect()}
    assert rejected == {3: "SyntaxError", 5: "long_actions"}
    assert kept[1]["intent_tokens"] == ["<s>", "open", "file", "var_0", "as", "str_0", "</s>"]
    assert kept[1]["snippet_actions"] == (
        "Assign Name f Store Reduce Call Name open Load Name var_0 Load Str str_0 Reduce Reduce".split()
    )
    assert kept[2]["snippet_actions"] == (
        "Assign Name var_0 Store Reduce Call Name sum Load List Name str_0 Load Reduce Load Reduce Reduce".split()
    )
    assert {e["slot"]: e["value"] for e in kept[2]["slots"]} == {"str_0": "[1, 2]", "var_0": "total", "[str_0]": "[1, 2]"}
    assert kept[4]["snippet_actions"] == "For Name x Store Name xs Load Pass Reduce Reduce".split()


def test_training_feed(prepared):
    feed = jobs.training_feed(prepared.kept, ["question_id"], batch_size=2)
    words = {(r["vocab_name"], r["word"]): r["id"] for r in feed.vocabularies.collect()}
    assert words["code", "[PAD]"] == words["source", "[PAD]"] == words["primitive", "[PAD]"] == 0
    assert words["source", "<s>"] == 1 and ("primitive", "Assign") not in words and ("code", "Assign") in words
    rows = feed.batches.collect()
    assert sorted(r["question_id"] for r in rows) == [1, 2, 4]
    for row in rows:
        assert len(row["ids"]) == len(row["mask"]) and row["ids"].count(0) == sum(row["mask"])
    steps = {(r["question_id"], r["step"]): r for r in feed.targets.collect()}
    assert steps[1, 0]["rule_mask"] == 1 and steps[1, 0]["rule_id"] == words["code", "Assign"]
    copied = steps[1, 10]
    assert (copied["token"], copied["copy_mask"], copied["gen_mask"], copied["primitive_mask"]) == ("var_0", 1, 1, 1)
    assert copied["token_id"] == words["primitive", "var_0"]


def test_score(spark, prepared):
    truth = prepared.kept.select("question_id", F.array_join("intent_tokens", " ").alias("intent"), F.col("snippet_tokens").alias("truth"))
    made = truth.where("question_id = 1").select("question_id", F.col("truth").alias("prediction"))
    path = fresh_path(spark, "results")
    report = jobs.score(truth, made, ["question_id"], {"dataset": "tiny", "model": "copy", "beam": "1"}, path)
    row = report.first()
    assert row["metric"] == "BLEU" and 0 < row["value"] < 100 and row["other_value"] == pytest.approx(100 / 3)
    errors = spark.read.parquet(path)
    assert errors.count() == 2 and {r["prediction"] for r in errors.collect()} == {""}
    assert errors.columns[-4:] == ["dataset", "model", "beam", "score"]
