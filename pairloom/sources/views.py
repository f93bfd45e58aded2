"""Views of the given tables in the shapes the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.functions.text import tokenize_code
from pairloom.operators.lookup import balanced
from pairloom.sources.tables import table


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    wanted = list(dict.fromkeys(["doc_id", "text", *columns]))
    return balanced(table(spark, folder, "documents").select(*wanted))


def docs(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """doc_id, the asked-for columns, and the tokens of the text."""
    return documents(spark, folder, *columns).select("doc_id", *columns, tokenize_code("text").alias("tokens"))


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """A user turn (intent) with the assistant turn right after it (snippet).

    An equi-join on (conversation, turn), so that a conversation with most of the turns stays spread.
    """
    turns = balanced(table(spark, folder, "conversations"))
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("intent"))
    answered = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("snippet")
    )
    return asked.join(answered, ["conv_id", "turn"])


def token_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return pairs(spark, folder).select(
        "conv_id", "turn", tokenize_code("intent").alias("intent_tokens"), tokenize_code("snippet").alias("snippet_tokens")
    )


def slotted_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Token pairs in which the slot var_0 stands for every `` the ``."""
    slot = [F.replace(c, F.lit(" the "), F.lit(" var_0 ")) for c in ("intent", "snippet")]
    return pairs(spark, folder).select(
        "conv_id", "turn", tokenize_code(slot[0]).alias("intent_tokens"), tokenize_code(slot[1]).alias("snippet_tokens")
    )


def action_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs ready for training; stops and commas play the part of two grammar actions."""
    action = F.create_map(F.lit("."), F.lit("Reduce"), F.lit(","), F.lit("Call"))
    actions = F.transform("snippet_tokens", lambda t: F.coalesce(action[t], t))
    return token_pairs(spark, folder).select("conv_id", "turn", "intent_tokens", actions.alias("snippet_actions"))


def line_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """One numbered line per part with a dotted name, a variable and a literal; every fiftieth is too long."""
    text = F.concat(
        F.lit("call mod.f"), F.col("size"), F.lit(" of "), F.col("name"), F.lit(" with '"), F.col("type"), F.lit("' or '%s' at end"),
        F.when(F.col("p_partkey") % 50 == 0, F.repeat(F.lit(" x"), 200)).otherwise(F.lit("")),
    )
    return quoted_requests(spark, folder).select(
        "p_partkey", text.alias("intent"), F.concat(F.lit(" f("), F.col("size"), F.lit(") ")).alias("snippet"), F.array("name").alias("variables")
    )


def annotated(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs whose rewritten intent is missing in every seventh."""
    rewritten = F.when((F.col("conv_id") + F.col("turn")) % 7 != 0, F.upper("intent"))
    return pairs(spark, folder).withColumn("rewritten_intent", rewritten)


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Truth tokens of the snippet, and a prediction that gets every `` the `` wrong."""
    edited = F.replace("snippet", F.lit(" the "), F.lit(" a "))
    return pairs(spark, folder).select(
        "conv_id", "turn", "intent", tokenize_code("snippet").alias("truth"), tokenize_code(edited).alias("prediction")
    )


def quoted_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per part, with names, sizes and types between the three kinds of quotes."""
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    size = F.col("p_size").cast("string")
    request = F.concat(
        F.lit("set `"), name, F.lit('` of "'), F.col("p_name"), F.lit('" to `'), size,
        F.lit("` and '"), F.col("p_type"), F.lit("' not `"), name, F.lit("`"),
    )
    return table(spark, folder, "part").select(
        "p_partkey", request.alias("intent"), name.alias("name"), F.col("p_name").alias("phrase"), size.alias("size"), F.col("p_type").alias("type")
    )


# Code by template number; {n} is the part's size.
CODE_TEMPLATES = (
    "x = foo({n})",
    'def f(a, b=1):\n    """doc {n}"""\n    return a + b  # note',
    "for i in range({n}):\n    print(i)",
    "if x == {n}: pass",
    "[y for y in z if y > {n}]",
    "elif x:",
    "@dec",
    "return foo(",
)


def code_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One code snippet per part, by template."""
    kind = (F.col("p_partkey") % len(CODE_TEMPLATES)).cast("int")
    template = F.element_at(F.array(*[F.lit(t) for t in CODE_TEMPLATES]), kind + 1)
    size = F.col("p_size").cast("string")
    return balanced(table(spark, folder, "part").select("p_partkey", "p_size")).select(
        "p_partkey", kind.alias("template"), size.alias("size"), F.replace(template, F.lit("{n}"), size).alias("code")
    )


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Ranked candidates per order: score and length of each line."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.col("l_extendedprice").alias("score"),
        F.col("l_quantity").alias("length"),
        F.col("l_linenumber").cast("bigint").alias("tie"),
    )


def run_configs(spark: SparkSession, folder: str) -> DataFrame:
    """One run configuration per part: list parameters from its size, scalars from its other columns."""
    size = F.col("p_size").cast("bigint")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.array(size, size + 1).alias("hidden_size"),
        F.col("p_type").alias("model"),
        F.array(size * 8, size * 16).alias("nl_embed_size"),
        F.array(F.lit("0.0"), F.lit("0.3")).alias("dropout_encoder"),
        F.col("p_brand").alias("dataset"),
    )


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON lines, some of them broken: cut off, with a text for a number, or without the event's type."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", "props")
    number = F.col("event_id").cast("string")
    cut = F.concat(F.lit('{"event_id":'), number, F.lit(',"event_type":"'), F.col("event_type"))
    wrong = F.concat(F.lit('{"event_id":"x'), number, F.lit('","event_type":"'), F.col("event_type"), F.lit('"}'))
    untyped = F.concat(F.lit('{"event_id":'), number, F.lit("}"))
    line = F.when(F.col("event_id") % 97 == 0, cut).when(F.col("event_id") % 89 == 0, wrong).when(F.col("event_id") % 83 == 0, untyped)
    return events.select(line.otherwise(F.to_json(F.struct("*"))).alias("value"))
