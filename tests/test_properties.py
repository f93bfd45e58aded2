"""Properties over given tables and made-up rows, checked against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pairloom.functions import arrays, slots, text
from pairloom.operators import batching, counts, lookup, metrics, numbering, runs, splits, vocab
from pairloom.sources import views


def python_tokens(line: str) -> list[str]:
    spaced = re.sub(r"([^A-Za-z0-9_])", r" \1 ", line)
    spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", spaced)
    return [t for t in re.sub(r"\s+", " ", spaced).replace('"', "`").replace("'", "`").split(" ") if t]


def test_tokenizing_is_as_in_python(spark):
    rng = random.Random(3)
    alphabet = "abzABZ019_.,'\"` \t\n\x0b\x1c\x1f\x85\xa0 　​é漢😀-"
    lines = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, t string").select(
        "i", text.tokenize_code("t").alias("code"), text.tokenize_ws("t").alias("ws"), text.strip("t").alias("s")
    )
    for row in df.collect():
        line = lines[row["i"]]
        assert row["code"] == python_tokens(line)
        assert row["ws"] == line.split()
        assert row["s"] == line.strip()


def test_a_very_long_word_is_tokenized(spark):
    df = spark.createDataFrame([("aB1_" * 50_000,)], "t string")
    assert df.select(F.size(text.tokenize_code("t")).alias("n")).first()["n"] == 50_001


def test_group_positions(spark):
    rng = random.Random(5)
    lists = [[rng.choice("abcdé") for _ in range(rng.randrange(30))] for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, t array<string>")
    for row in df.select("i", arrays.group_positions("t").alias("g")).collect():
        expected = defaultdict(list)
        for pos, item in enumerate(lists[row["i"]]):
            expected[item].append(pos)
        assert {g["item"]: g["positions"] for g in row["g"]} == dict(expected)


@pytest.mark.parametrize("width", [1, 2, 4])
def test_clipped_matches(spark, width):
    rng = random.Random(width)
    words = ["a", "b", "\\", "\x1f", "\\s", "a\x1fb"]
    rows = [(i, *[[rng.choice(words) for _ in range(rng.randrange(25))] for _ in range(2)]) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, c array<string>, t array<string>")
    ready = df.select("i", arrays.joinable("c").alias("c"), arrays.joinable("t").alias("t"))

    def grams(items):
        return Counter(tuple(items[k : k + width]) for k in range(len(items) - width + 1))

    for row in ready.select("i", arrays.clipped_matches("c", "t", width).alias("m")).collect():
        _, candidate, target = rows[row["i"]]
        assert row["m"] == (grams(candidate) & grams(target)).total()


def test_slots_round_trip(spark, folder):
    rows = views.quoted_requests(spark, folder).withColumn("e", slots.slot_entries("intent"))
    back = slots.unslot_words(slots.slot_text("intent", F.col("e")), slots.entry_map(F.col("e"), "slot", "value"))
    plain = F.regexp_replace("intent", "[`'\"]", "")
    assert rows.where(back != plain).count() == 0


def test_splits_are_whole_and_apart(spark, folder):
    pairs = views.pairs(spark, folder).select("conv_id", "turn")
    total = pairs.count()
    split = splits.shuffle_split(pairs, ["conv_id", "turn"], n_val=7)
    assert split.count() == total and split.where("split = 'val'").count() == 7
    again = splits.shuffle_split(pairs.repartition(5), ["conv_id", "turn"], n_val=7)
    assert split.where("split = 'val'").exceptAll(again.where("split = 'val'")).count() == 0


def test_splits_by_order_use_numbering(spark, many_chunks):
    df = splits.tail_split(spark.range(500), ["id"], n_test=120, n_dev=50)
    found = {r["split"]: r["n"] for r in df.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert found == {"train": 330, "dev": 50, "test": 120}
    assert [r["id"] for r in splits.row_at(spark.range(500), ["id"], 321).collect()] == [321]


def test_window_counts_add_up(spark, folder):
    docs = views.docs(spark, folder)
    for last, short in ((False, 3), (True, 2)):
        grams = counts.ngram_counts(docs, "tokens", 3, include_last=last).agg(F.sum("freq").alias("n")).first()["n"]
        assert grams == docs.agg(F.sum(F.greatest(F.size("tokens") - short, F.lit(0))).alias("n")).first()["n"]


def test_decode_undoes_encode(spark, folder):
    docs = views.docs(spark, folder)
    words = vocab.vocabulary(docs, "tokens", ["doc_id"])
    back = vocab.decode(vocab.encode(docs, "tokens", words, ["doc_id"]), "ids", words, ["doc_id"])
    assert docs.join(back.withColumnRenamed("tokens", "back"), "doc_id").where("tokens <> back").count() == 0
    size, top = words.agg(F.count_distinct("id"), F.max("id")).first()
    assert size == top + 1


def test_bleu_of_a_corpus_with_itself(spark, folder):
    pairs = views.token_pairs(spark, folder).where(F.size("snippet_tokens") >= 4)
    assert metrics.corpus_bleu(pairs, "snippet_tokens", "snippet_tokens").first()["bleu"] == pytest.approx(1.0)


def hot_rows(n=4000):
    """A third of all rows in one group."""
    rng = random.Random(11)
    return [(0 if rng.random() < 0.34 else rng.randrange(1, 40), i, rng.randrange(1000)) for i in range(n)]


def test_numbers_over_many_chunks(spark, many_chunks):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "g int, at int, v int")
    chunks = numbering.range_chunks(df, ["g", "at"])
    assert chunks.where("g = 0").select(numbering.CHUNK).distinct().count() > 1
    numbered = numbering.number_chunked(chunks, "n").collect()
    assert [(r["g"], r["at"]) for r in sorted(numbered, key=lambda r: r["n"])] == sorted((g, a) for g, a, _ in rows)
    inside = numbering.number_in_group(df, ["g"], ["at"], "n").collect()
    seen = defaultdict(list)
    for r in sorted(inside, key=lambda r: r["at"]):
        seen[r["g"]].append(r["n"])
    assert all(numbers == list(range(1, len(numbers) + 1)) for numbers in seen.values())


def test_metric_log_over_many_chunks(spark, many_chunks):
    rows = hot_rows()
    patience, from_epoch = 3, 5
    expected = {}
    by_run = defaultdict(list)
    for run, at, value in rows:
        by_run[run].append((at, value))
    for run, log in by_run.items():
        best, stalls, trials = -0.1, 0, 0
        for epoch, (_, value) in enumerate(sorted(log), start=1):
            better = value > best
            best = max(best, value)
            if better:
                stalls = 0
            elif epoch >= from_epoch:
                stalls += 1
            hit = stalls >= patience
            if hit:
                trials, stalls = trials + 1, 0
            expected[run, epoch] = (value, best, better, stalls, hit, trials)
    log = runs.metric_log(spark.createDataFrame(rows, "g int, at int, v int"), "g", ["at"], "v")
    best = {(r["run"], r["epoch"]): (r["metric"], r["best"], r["is_better"]) for r in runs.running_best(log).collect()}
    assert best == {k: v[:3] for k, v in expected.items()}
    tried = runs.patience_trials(log, patience, from_epoch).collect()
    assert {(r["run"], r["epoch"]): (r["stalls"], r["is_trial"], r["trials"]) for r in tried} == {k: v[3:] for k, v in expected.items()}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_lookup_is_the_plain_join(spark, how):
    big = spark.createDataFrame([("hot" if i % 3 else f"k{i % 7}", i) for i in range(600)], "k string, i int")
    small = spark.createDataFrame([("hot", 1), ("k1", 2), ("k5", 3)], "k string, v int")
    salted = lookup.lookup_join(big, small, ["k"], how, limit=0, salts=4)
    plain = big.join(small, "k", how)
    assert salted.exceptAll(plain).count() == 0 and salted.count() == plain.count()


def test_batches(spark, many_chunks, folder):
    pairs = views.token_pairs(spark, folder)
    rows = splits.assign_batches(pairs, ["conv_id", "turn"], F.size("intent_tokens"), 4).collect()
    assert len(rows) == pairs.count()
    batches = defaultdict(list)
    for r in rows:
        batches[r["batch_id"]].append(r)
    assert sorted(batches) == list(range(len(batches)))
    sizes = [len(batches[b]) for b in sorted(batches)]
    assert set(sizes[:-1]) == {4} and 1 <= sizes[-1] <= 4
    for members in batches.values():
        lengths = [r["length"] for r in sorted(members, key=lambda r: r["pos_in_batch"])]
        assert lengths == sorted(lengths, reverse=True) and {r["batch_longest"] for r in members} == {lengths[0]}


def test_marginal_weights(spark):
    df = spark.createDataFrame([(1, ["a", "u", "v", "u", "a"], [0.1, 0.2, 0.3, 0.2, 0.4])], "k int, t array<string>, w array<double>")
    words = spark.createDataFrame([("a", 4, 1)], "word string, id bigint, freq bigint")
    rows = {r["id"]: (r["token"], round(r["weight"], 9)) for r in batching.marginal_weights(df, "t", "w", words, "k").collect()}
    assert rows == {4: ("a", 0.5), 3: ("u", 0.4)}


def test_marginal_weights_of_repeated_and_missing_keys_are_worked_out_once(spark):
    rows = [(1, ["u", "a", "u"], [0.1, 0.5, 0.2]), (1, ["v", "a"], [0.4, 0.25]), (None, ["x", "y"], [0.2, 0.2]), (3, [], []), (4, None, None), (5, ["a"], [0.5])]
    df = spark.createDataFrame(rows, "k int, t array<string>, w array<double>")
    words = spark.createDataFrame([("a", 4, 1)], "word string, id bigint, freq bigint")
    found = batching.marginal_weights(df, "t", "w", words, "k")
    got = sorted(((r["k"] or 0, r["id"], r["token"], round(r["weight"], 9)) for r in found.collect()))
    # The unknown tokens of both rows with key 1 meet; every row keeps its own sum of a known one.
    assert got == [(0, 3, "x", 0.2), (1, 3, "v", 0.4), (1, 4, "a", 0.25), (1, 4, "a", 0.5), (5, 4, "a", 0.5)]
    assert "sort_array" not in found._jdf.queryExecution().optimizedPlan().toString()
