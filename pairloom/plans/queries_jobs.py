"""The whole jobs: preparing numbered lines, the training feed, scoring a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.functions.slots import entry_map, map_lines
from pairloom.functions.text import array_text
from pairloom.operators.code import LENGTH_LIMIT
from pairloom.operators.vocab import SPECIALS, UNKNOWN_ID
from pairloom.plans import jobs, sql
from pairloom.plans.registry import query
from pairloom.session import fresh_path, materialize
from pairloom.sources import views

KEYS = ["conv_id", "turn"]


@query(
    "prepare_lines",
    f"""with {sql.SLOTS},
    lines as (
      select p_partkey, 'call mod.f' || size || ' [ mod . f' || size || ' ] of var_0 with str_0 or ''%s'' at end'
          || case when p_partkey % 50 = 0 then repeat(' x', 200) else '' end as tokens,
        array_to_string(list_sort([type || '=str_0', name || '=var_0']), chr(10)) as slots,
        case when p_partkey % 50 = 0 then 'long_intent' else 'kept' end as status from slots),
    kept as (select *, row_number() over (order by p_partkey desc) as rn from lines where status = 'kept')
    select p_partkey, tokens, slots, 4::bigint as n_code, status, case when rn <= 50 then 'test' when rn <= 80 then 'dev' else 'train' end as split from kept
    union all select p_partkey, tokens, slots, 4, status, null from lines where status <> 'kept'""",
)
def prepare_lines(spark: SparkSession, folder: str) -> DataFrame:
    done = jobs.prepare_lines(views.line_pairs(spark, folder), ["p_partkey"], "intent", "snippet", "variables", n_test=50, n_dev=30)
    every = done.kept.unionByName(done.rejected.withColumn("split", F.lit(None).cast("string")))
    return every.select(
        "p_partkey",
        array_text("intent_tokens").alias("tokens"),
        map_lines(entry_map(F.col("slots"), "literal", "slot")).alias("slots"),
        F.size("snippet_tokens").cast("bigint").alias("n_code"),
        "status",
        "split",
    )


RULES = ", ".join(f"('{name}', {i}::bigint)" for i, name in enumerate(jobs.grammar_names(), len(SPECIALS)))
FEED = f"""{sql.TPAIRS},
    kept as (
      select conv_id, turn, intent_tokens,
        list_transform(snippet_tokens, lambda t: case t when '.' then 'Reduce' when ',' then 'Call' else t end) as actions from tpairs),
    rules(token, rule_id) as (values {RULES}),
    {sql.exploded('kept', 'intent_tokens', 'src', 'conv_id', 'turn')},
    {sql.exploded('kept', 'actions', 'act', 'conv_id', 'turn')},
    prims as (select * from act where token not in (select token from rules)),
    {sql.vocabulary('src', 1, ('conv_id', 'turn'), 'source')},
    {sql.vocabulary('prims', 1, ('conv_id', 'turn'), 'primitive')},
    train as (select * from kept where len(actions) <= {LENGTH_LIMIT})"""


def feed(spark: SparkSession, folder: str) -> jobs.Feed:
    return jobs.training_feed(materialize(views.action_pairs(spark, folder), "pairs"), KEYS)


@query(
    "feed_vocabularies",
    f"""with {FEED}
    select 'source' as vocab_name, word, id, freq from source union all select 'primitive', word, id, freq from primitive
    union all select 'code', token, rule_id, 0 from rules
    union all select 'code', word, cast(i as bigint), 0 from (values {", ".join(f"('{w}', {i})" for i, w in enumerate(SPECIALS))}) s(word, i)""",
)
def feed_vocabularies(spark: SparkSession, folder: str) -> DataFrame:
    return feed(spark, folder).vocabularies


@query(
    "feed_batches",
    f"""with {FEED},
    shuffled as (select *, row_number() over (order by md5(conv_id || ':' || turn || ':' || 1), conv_id, turn) - 1 as rn from train),
    batches as (
      select *, rn // 16 as batch_id, row_number() over (partition by rn // 16 order by len(intent_tokens) desc, rn) - 1 as pos_in_batch,
        max(len(intent_tokens)) over (partition by rn // 16) as longest from shuffled),
    ids as (select conv_id, turn, list(coalesce(id, {UNKNOWN_ID}) order by pos) as ids from src left join source on token = word group by conv_id, turn)
    select conv_id, turn, batch_id, pos_in_batch, cast(len(intent_tokens) as bigint) as length,
      {sql.joined("list_transform(range(1, longest + 1), lambda i: coalesce(ids[i], 0))")} as ids,
      repeat('0', len(intent_tokens)) || repeat('1', longest - len(intent_tokens)) as mask
    from batches left join ids using (conv_id, turn)""",
)
def feed_batches(spark: SparkSession, folder: str) -> DataFrame:
    text = [array_text(F.col("ids").cast("array<string>")).alias("ids"), F.array_join(F.col("mask").cast("array<string>"), "").alias("mask")]
    return feed(spark, folder).batches.select(*KEYS, "batch_id", "pos_in_batch", "length", *text)


@query(
    "feed_targets",
    f"""with {FEED},
    steps as (
      select act.conv_id, act.turn, act.pos as step, act.token, rule_id, coalesce(id, {UNKNOWN_ID}) as id,
        exists (select 1 from src where src.conv_id = act.conv_id and src.turn = act.turn and src.token = act.token) as seen
      from act join train using (conv_id, turn) left join rules on rules.token = act.token left join primitive on primitive.word = act.token),
    masks as (
      select conv_id, turn, step, token, coalesce(rule_id, 0) as rule_id, cast(rule_id is not null as int) as rule_mask,
        cast(case when rule_id is null then id else 0 end as bigint) as token_id,
        cast(rule_id is null and (not seen or id <> {UNKNOWN_ID}) as int) as gen_mask, cast(rule_id is null and seen as int) as copy_mask from steps)
    select *, greatest(gen_mask, copy_mask) as primitive_mask from masks""",
)
def feed_targets(spark: SparkSession, folder: str) -> DataFrame:
    return feed(spark, folder).targets.withColumn("step", F.col("step").cast("bigint"))


@query(
    "score_run",
    f"""with {sql.PREDS}, {sql.bleu('preds', 'prediction', 'truth')},
    hits as (select avg((truth = prediction)::int) as accuracy, count(*) filter (where truth <> prediction) as n_errors from preds)
    select 'BLEU' as metric, round(bleu * 100, 7) as value, round(accuracy * 100, 7) as other_value, n_errors,
      printf('BLEU=%.4f', bleu * 100) as folder from score, hits""",
)
def score_run(spark: SparkSession, folder: str) -> DataFrame:
    rows = materialize(views.predictions(spark, folder), "predictions")
    path = fresh_path(spark, "results")
    report = jobs.score(rows.select(*KEYS, "intent", "truth"), rows.select(*KEYS, "prediction"), KEYS, {"dataset": "pairs", "model": "edit", "beam": "1"}, path)
    errors = spark.read.parquet(path).groupBy(F.col("score").alias("folder")).agg(F.count(F.lit(1)).alias("n_errors"))
    named = report.withColumn("folder", F.format_string("BLEU=%.4f", "value"))
    found = named.join(F.broadcast(errors), "folder", "left")  # one row for the run
    return found.select(
        "metric", F.round("value", 7).alias("value"), F.round("other_value", 7).alias("other_value"), F.coalesce("n_errors", F.lit(0)).alias("n_errors"), "folder"
    )
