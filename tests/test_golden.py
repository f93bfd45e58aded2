"""Small cases worked by hand."""

from __future__ import annotations

import ast
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairloom.functions import arrays, slots, syntax, text, values
from pairloom.operators import batching, code, counts, metrics, runs, splits, vocab, windows


def one(spark, column, **row):
    """The value of a column over a single row."""
    return spark.createDataFrame([tuple(row.values())], list(row)).select(column.alias("v")).first()["v"]


def test_tokenize_code(spark):
    assert one(spark, text.tokenize_code("c"), c='os.path.joinPath("a")') == ["os", ".", "path", ".", "join", "Path", "(", "`", "a", "`", ")"]


@pytest.mark.parametrize(
    ("intent", "slotted", "entries"),
    [
        ("rename `foo` to 'bar baz'", "rename var_0 to str_0", [("var_0", "foo"), ("str_0", "bar baz")]),
        ("use `9x`", "use str_0", [("str_0", "9x")]),
        ("a `x` b `x`", "a var_0 b var_0", [("var_0", "x"), ("var_1", "x")]),
        ("nothing here", "nothing here", []),
        ("set `été` and ` x `", "set var_0 and str_0", [("var_0", "été"), ("str_0", "x")]),
    ],
)
def test_slots_intent(spark, intent, slotted, entries):
    found = one(spark, slots.slot_entries("c"), c=intent)
    assert [(e["slot"], e["value"]) for e in found] == entries
    assert one(spark, slots.slot_text("c", slots.slot_entries("c")), c=intent) == slotted


@pytest.mark.parametrize(("value", "expected"), [("[1, 2]", True), ("[1)", True), ("[]", False), ("(a\nb}", True), ("a]", False)])
def test_is_enumerable(spark, value, expected):
    assert one(spark, slots.is_enumerable("c"), c=value) is expected


def test_slots_query(spark):
    query = "print 'a' and \"a\" but '%s'"
    assert one(spark, slots.query_text("c", slots.literal_slots("c")), c=query) == "print str_0 and str_0 but '%s'"
    escaped = r"say 'it\'s' now"
    assert one(spark, slots.query_text("c", slots.literal_slots("c")), c=escaped) == "say str_0 now"


def test_unslot_keeps_longer_names(spark):
    entries = F.array(*[F.struct(F.lit(f"var_{i}").alias("slot"), F.lit(v).alias("value")) for i, v in ((1, "a"), (10, "b"))])
    assert one(spark, slots.unslot_words("c", slots.entry_map(entries, "slot", "value")), c="f(var_10, var_1)") == "f(b, a)"


def test_break_dotted(spark):
    assert one(spark, text.break_dotted("t"), t=["a.b", "x.", "."]) == ["a.b", "[", "a", ".", "b", "]", "x.", "."]


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("try:", "try:pass\nexcept: pass"),
        ("elif x:", "if True: pass\nelif x:pass"),
        ("else:", "if True: pass\nelse:pass"),
        ("except E:", "try: pass\nexcept E:pass"),
        ("finally:", "try: pass\nfinally:pass"),
        ("@dec", "@dec\ndef dummy(): pass"),
        ("x = 1", "x = 1"),
        ("", ""),
    ],
)
def test_wrap_fragment(spark, line, expected):
    assert one(spark, text.wrap_fragment("c"), c=line) == expected


@pytest.mark.parametrize(
    ("literal", "expected"),
    [
        ("1.5", ("long", 1, None, None)),
        ("-1.5", ("long", -1, None, None)),
        ("1e3", ("long", 1000, None, None)),
        ("1_000", ("long", 1000, None, None)),
        (" 7 ", ("long", 7, None, None)),
        ("1e300", ("double", None, 1e300, None)),
        ("inf", ("double", None, math.inf, None)),
        ("abc", ("string", None, None, "abc")),
        ("1f", ("string", None, None, "1f")),
        ("'a b'", ("string", None, None, "a b")),
        ("True", ("bool", 1, None, None)),
        ("None", ("none", None, None, None)),
        ("[1, 2]", ("string", None, None, "[1, 2]")),
    ],
)
def test_literal_value(spark, literal, expected):
    assert tuple(one(spark, values.literal_value("c"), c=literal)) == expected


def test_literal_value_special(spark):
    assert math.isnan(one(spark, values.literal_value("c"), c="nan")["double"])
    assert tuple(one(spark, values.literal_value("c", keep_fraction=True), c="1.5")) == ("double", None, 1.5, None)


def test_mark_terms(spark):
    doc = "Adds x to xs. :param x: one. :param xs: many."
    assert one(spark, text.mark_terms("c", text.param_terms("c")), c=doc) == "Adds `x` to `x`s. :param `x`: one. :param `x`s: many."
    assert one(spark, text.mark_terms("c", text.param_terms("c")), c="none") == "none"


def test_elapsed(spark):
    minutes, seconds = values.elapsed(F.col("s"))
    assert (one(spark, minutes, s=125.9), one(spark, seconds, s=125.9)) == (2, 5)


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],), (["a"],), ([],)], "t array<string>")

    def found(**options):
        rows = counts.ngram_counts(df, "t", 2, **options).select(counts.gram_text(2).alias("g"), "freq").collect()
        return {r["g"]: r["freq"] for r in rows}

    assert found() == {"a b": 1, "b c": 1}
    assert found(include_last=True) == {"a b": 1, "b c": 1, "c d": 1}


def test_frequency_of_frequency(spark):
    df = spark.createDataFrame([("a", 2), ("b", 2), ("c", 1)], "gram string, freq bigint")
    assert sorted(map(tuple, counts.frequency_of_frequency(df).collect())) == [(1, 1), (2, 2)]


SENTENCES = [(1, ["b", "a"]), (2, ["a", "c"])]


def sentences(spark):
    return spark.createDataFrame(SENTENCES, "id bigint, tokens array<string>")


def test_vocabulary(spark):
    specials = {"[PAD]": 0, "<s>": 1, "</s>": 2, "<unk>": 3}
    found = {r["word"]: r["id"] for r in vocab.vocabulary(sentences(spark), "tokens", ["id"]).collect()}
    assert found == specials | {"a": 4, "b": 5, "c": 6, "Reduce_primitif": 7}
    found = {r["word"]: r["id"] for r in vocab.vocabulary(sentences(spark), "tokens", ["id"], cutoff=2).collect()}
    assert found == specials | {"a": 4, "Reduce_primitif": 5}


def test_vocabulary_ranks_its_closing_word_and_keeps_special_ids(spark):
    df = spark.createDataFrame([(1, ["Reduce_primitif", "<s>", "x", "Reduce_primitif"])], "id bigint, tokens array<string>")
    found = {r["word"]: r["id"] for r in vocab.vocabulary(df, "tokens", ["id"]).collect()}
    assert found == {"[PAD]": 0, "<s>": 1, "</s>": 2, "<unk>": 3, "Reduce_primitif": 4, "x": 5}
    empty = vocab.vocabulary(df.where("id = 0"), "tokens", ["id"])
    assert {r["word"]: r["id"] for r in empty.collect()}["Reduce_primitif"] == 4


def test_encode(spark):
    words = vocab.vocabulary(sentences(spark), "tokens", ["id"])
    df = spark.createDataFrame([(7, ["a", "z"]), (8, [])], "id bigint, tokens array<string>")
    assert {r["id"]: r["ids"] for r in vocab.encode(df, "tokens", words, ["id"]).collect()} == {7: [4, 3], 8: []}


def test_tail_split(spark):
    df = splits.tail_split(spark.range(3000), ["id"])
    found = {r["split"]: (r["lo"], r["hi"]) for r in df.groupBy("split").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).collect()}
    assert found == {"train": (0, 194), "dev": (195, 1194), "test": (1195, 2999)}


def test_padding_and_masks(spark):
    coded = spark.createDataFrame([(1, [4, 5]), (2, [6])], "k bigint, ids array<bigint>")
    batches = spark.createDataFrame([(1, 0, 0, 2, 2), (2, 0, 1, 1, 2)], "k bigint, batch_id bigint, pos_in_batch bigint, length bigint, batch_longest bigint")
    padded = batching.pad_batches(coded, batches, ["k"])
    assert {r["k"]: r["ids"] for r in padded.collect()} == {1: [4, 5], 2: [6, 0]}
    assert {r["step"]: r["ids"] for r in batching.transpose_batches(padded).collect()} == {0: [4, 6], 1: [5, 0]}
    assert {r["k"]: r["mask"] for r in batching.mask_batches(batches).collect()} == {1: [0, 0], 2: [0, 1]}
    assert {r["k"]: r["mask"] for r in batching.mask_batches(batches, valid_is_one=True).collect()} == {1: [1, 1], 2: [1, 0]}


def test_target_features(spark):
    df = spark.createDataFrame([(1, ["x", "q"], ["x", "q", "y", "R"])], "k bigint, s array<string>, t array<string>")
    words = spark.createDataFrame([("x", 4, 1)], "word string, id bigint, freq bigint")
    rules = spark.createDataFrame([("R", 9)], "token string, rule_id bigint")
    rows = batching.target_features(df, "s", "t", rules, words, "k").orderBy("step").collect()
    assert [(r["gen_mask"], r["copy_mask"]) for r in rows] == [(1, 1), (0, 1), (1, 0), (0, 0)]
    assert [(r["rule_id"], r["rule_mask"], r["token_id"]) for r in rows] == [(0, 0, 4), (0, 0, 3), (0, 0, 3), (9, 1, 0)]
    spots = batching.copy_positions(df, "s", "t", "k").orderBy("step").collect()
    assert [(r["token"], r["positions"]) for r in spots] == [("x", [0]), ("q", [1])]


def test_grid(spark):
    df = spark.createDataFrame([([1, 2], 5, ["x", "y"])], "a array<int>, b int, c array<string>")
    assert sorted(map(tuple, runs.expand_grid(df).collect())) == [(1, 5, "x"), (1, 5, "y"), (2, 5, "x"), (2, 5, "y")]


def test_overlap(spark):
    df = spark.createDataFrame([(["a", "a", "b"], ["a", "c"])], "a array<string>, b array<string>")
    assert tuple(counts.overlap_total(df, "a", "b").first()) == (1, 3)


def test_quoted_singles(spark):
    assert len(one(spark, arrays.quoted_singles("t"), t=["`", "a", "`", "`", "b", "c", "`"])) == 1
    assert len(one(spark, arrays.quoted_singles("t"), t=["`", "a", "`", "`"])) == 1
    assert one(spark, arrays.quoted_singles("t"), t=["a"]) == []


def bleu(spark, candidate, target):
    df = spark.createDataFrame([(candidate, target)], "c array<string>, t array<string>")
    return metrics.corpus_bleu(df, "c", "t").first()["bleu"]


def test_bleu(spark):
    assert bleu(spark, list("abcde"), list("abcde")) == pytest.approx(1.0)
    assert bleu(spark, list("abcde"), list("abcxe")) == 0.0
    assert bleu(spark, [], list("abcde")) == 0.0
    assert bleu(spark, list("abcd"), list("abcde")) == pytest.approx(math.exp(1 - 5 / 4))


def log_frame(spark, rows):
    return spark.createDataFrame([(1, i, float(m)) for i, m in enumerate(rows)], "run bigint, at bigint, metric double")


def test_patience(spark):
    log = runs.metric_log(log_frame(spark, [5, 4, 4, 4, 4]), "run", ["at"], "metric")
    rows = runs.patience_trials(log, patience=2, from_epoch=1).orderBy("epoch").collect()
    assert [r["epoch"] for r in rows if r["is_trial"]] == [3, 5]
    ended = runs.patience_trials(log, patience=2, from_epoch=1, max_trials=1)
    assert ended.count() == 3


def test_top_per_group_refuses_a_wide_k(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0)], "g bigint, s double")
    assert runs.top_per_group(df, ["g"], [F.desc("s")], F.lit(2), k_max=2).count() == 2
    with pytest.raises(Exception, match="over 1"):
        runs.top_per_group(df, ["g"], [F.desc("s")], F.lit(2), k_max=1).collect()


def test_row_at(spark):
    df = spark.range(5)
    assert [r["id"] for r in splits.row_at(df, ["id"], 3).collect()] == [3]
    assert splits.row_at(df, ["id"], 5).collect() == []


def test_actions_know_their_places():
    tree = ast.parse("x[0] = f(*a)").body[0]
    assert syntax.actions_of(tree) == [
        ("Assign", "-", None, None, None),
        ("Subscript", "+", "expr", "targets", "+"),
        ("Name", "-", "expr", "value", "-"),
        ("x", "-", "identifier", "id", "-"),
        ("Load", "-", "expr_context", "ctx", "-"),
        ("Index", "-", "slice", "slice", "-"),
        ("Num", "-", "expr", "value", "-"),
        ("0", "-", "object", "n", "-"),
        ("Store", "-", "expr_context", "ctx", "-"),
        ("Reduce", "-", "expr", "targets", "+"),
        ("Call", "-", "expr", "value", "-"),
        ("Name", "-", "expr", "func", "-"),
        ("f", "-", "identifier", "id", "-"),
        ("Load", "-", "expr_context", "ctx", "-"),
        ("Starred", "+", "expr", "args", "+"),
        ("Name", "-", "expr", "value", "-"),
        ("a", "-", "identifier", "id", "-"),
        ("Load", "-", "expr_context", "ctx", "-"),
        ("Load", "-", "expr_context", "ctx", "-"),
        ("Reduce", "-", "expr", "args", "+"),
        ("Reduce", "+", "keyword", "keywords", "+"),
    ]


def test_actions_close_missing_words():
    labels = [a[:2] for a in syntax.actions_of(ast.parse("import a").body[0])]
    assert labels == [("Import", "-"), ("alias", "+"), ("a", "-"), ("Reduce_primitif", "?"), ("Reduce", "-")]


def test_code_facts(spark):
    codes = ["x = foo(3)", "def f(a, b=1):\n    \"\"\"doc\"\"\"\n    return a + b  # note", "", "return foo(", None, "(" * 5000]
    df = spark.createDataFrame(list(enumerate(codes)), "k int, code string")
    rows = {r["k"]: r for r in code.with_facts(df, "code", "depth", "nodes", "comments", "stripped").collect()}
    assert [rows[k]["status"] for k in range(4)] == ["ok", "ok", "empty", "SyntaxError"] and rows[4]["status"] == "missing"
    assert rows[5]["status"] in ("SyntaxError", "MemoryError", "RecursionError")
    assert (rows[0]["depth"], rows[0]["nodes"], rows[1]["depth"], rows[1]["nodes"]) == (5, 8, 6, 15)
    assert rows[1]["comments"] == ["# note"] and "doc" not in rows[1]["stripped"]


def test_actions_of_a_batch_with_missing_and_broken_code(spark):
    df = spark.createDataFrame([(1, "x = 1"), (2, None), (3, "x ="), (4, ""), (5, "pass")], "k int, c string").coalesce(1)
    rows = {r["k"]: r for r in code.with_facts(df, "c", "actions", "comments", "depth").collect()}
    assert [rows[k]["status"] for k in range(1, 6)] == ["ok", "missing", "SyntaxError", "empty", "ok"]
    assert [rows[k]["actions"] for k in (2, 3, 4)] == [None] * 3 and rows[2]["comments"] is None
    assert [tuple(a) for a in rows[5]["actions"]] == [("Pass", "-", None, None, None)]
    assert [a["action"] for a in rows[1]["actions"]] == ["Assign", "Name", "x", "Store", "Reduce", "Num", "1"]
    # The grammar is read once per class, not once per node.
    assert syntax._declared(ast.Name) is syntax._declared(ast.Name)


def test_tokenize_code_takes_every_character_as_the_first_pattern_did(spark):
    """Each character of the Basic Multilingual Plane between words, and pairs of surrogates, against the pattern as it stands in the checks."""
    old = F.regexp_extract_all(
        F.regexp_replace(F.translate("c", "\"'", "``"), "([a-z])([A-Z])", "$1 $2"), F.lit(f"[A-Za-z0-9_]+|[^A-Za-z0-9_{text.BLANKS}]"), F.lit(0)
    )
    chars = [chr(i) for i in [*range(1, 0xD800), *range(0xE000, 0x10000), 0x1F600, 0x10FFFF]]
    lines = ["aB" + "x_1".join(chars[k : k + 256]) + chars[k] for k in range(0, len(chars), 256)]
    df = spark.createDataFrame([(line,) for line in [*lines, "", "a'b\"c"]], "c string")
    rows = df.select(old.alias("old"), text.tokenize_code("c").alias("new"), F.col("c")).collect()
    assert all(r["old"] == r["new"] for r in rows)
    assert "translate(" not in str(text.tokenize_code("c"))  # it takes a string for each character


@pytest.mark.parametrize("width", [1, 2, 3, 7])
@pytest.mark.parametrize("last", [False, True])
def test_window_counts_of_odd_items(spark, width, last):
    """Against windows opened one by one: nulls, empty items, separators inside items, repeats, short, empty and missing lists."""
    rng = random.Random(width)
    odd = ["a", "b", "", None, "\x1f", "\x1e", "\x1d", "\x1dn", "\x1di", "a b", "é"]
    lists = [[rng.choice(odd) for _ in range(rng.randrange(30))] for _ in range(300)] + [None, [], ["a"] * 50, ["a"] * 50]
    short = width - 1 if last else width
    expected = Counter(tuple(x[i : i + width]) for x in lists if x for i in range(len(x) - short))
    df = spark.createDataFrame([(x,) for x in lists], "t array<string>").repartition(3)
    for items in (50, windows.ITEMS):
        rows = windows.count_windows(df, "t", width, last, items).collect()
        assert len(rows) == len(expected) and {tuple(r["gram"]): r["freq"] for r in rows} == expected


def test_windows_are_not_shuffled_one_by_one(spark):
    df = spark.createDataFrame([([str(i) for i in range(5000)],)], "t array<string>")
    plan = counts.ngram_counts(df, "t", 7)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan
