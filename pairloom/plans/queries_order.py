"""Vocabularies, splits, batches, rankings and metric logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.functions.arrays import sort_by_length as longest_first
from pairloom.functions.text import array_text, tokenize_ws
from pairloom.operators import batching, counts, runs, splits, vocab
from pairloom.operators.lookup import lookup_join
from pairloom.operators.rows import open_list
from pairloom.plans import sql
from pairloom.plans.queries_rows import docs_vocabulary
from pairloom.plans.registry import query
from pairloom.session import bucketed, materialize
from pairloom.sources import views
from pairloom.sources.tables import table


@query("vocab_build", f"with {sql.DOCS}, {sql.TOKS}, {sql.vocabulary('toks', 1)} select word, id, freq from vocab")
def vocab_build(spark: SparkSession, folder: str) -> DataFrame:
    return docs_vocabulary(views.docs(spark, folder), cutoff=1)


@query(
    "vocab_merge",
    f"""with {sql.DOCS}, {sql.TOKS},
    en as (select toks.* from toks join documents using (doc_id) where lang = 'en'),
    rest as (select toks.* from toks join documents using (doc_id) where lang is distinct from 'en'),
    {sql.vocabulary('en', 2, name='first')}, {sql.vocabulary('rest', 2, name='second')}
    select word, id from first
    union all
    select word, (select max(id) from first) + row_number() over (order by id) from second
    where word not in (select word from first)""",
)
def vocab_merge(spark: SparkSession, folder: str) -> DataFrame:
    docs = views.docs(spark, folder, "lang")
    english = F.col("lang").eqNullSafe("en")
    first, second = (docs_vocabulary(docs.where(part)) for part in (english, ~english))
    return vocab.merge_vocabulary(first, second).select("word", "id")


@query("dict_encode", "select p_type, cast(row_number() over (order by p_type) - 1 as bigint) as code from (select distinct p_type from part)")
def dict_encode(spark: SparkSession, folder: str) -> DataFrame:
    return vocab.category_codes(table(spark, folder, "part"), "p_type")


SHUFFLED = "select *, row_number() over (order by md5(event_id || ':' || 1), event_id) as rn from events"


@query("shuffle_split", f"select event_id, case when rn <= 200 then 'val' else 'train' end as split from ({SHUFFLED})")
def shuffle_split(spark: SparkSession, folder: str) -> DataFrame:
    return splits.shuffle_split(table(spark, folder, "events").select("event_id"), ["event_id"], 200, seed=1)


@query(
    "debug_split",
    f"select event_id, unnest(['train', 'val']) as split from (select * from ({SHUFFLED}) where rn <= 40)",
)
def debug_split(spark: SparkSession, folder: str) -> DataFrame:
    return splits.debug_split(table(spark, folder, "events").select("event_id"), ["event_id"], 40, seed=1)


@query(
    "tail_split",
    """select event_id, case when rn <= 1805 then 'test' when rn <= 2805 then 'dev' else 'train' end as split
    from (select event_id, row_number() over (order by event_id desc) as rn from events)""",
)
def tail_split(spark: SparkSession, folder: str) -> DataFrame:
    return splits.tail_split(table(spark, folder, "events").select("event_id"), ["event_id"])


@query("take_first_n", "select doc_id, text from documents order by doc_id limit 100")
def take_first_n(spark: SparkSession, folder: str) -> DataFrame:
    return splits.first_rows(table(spark, folder, "documents").select("doc_id", "text"), ["doc_id"], 100)


@query("row_at", "select doc_id, text from documents order by doc_id limit 1 offset 10")
def row_at(spark: SparkSession, folder: str) -> DataFrame:
    return splits.row_at(table(spark, folder, "documents").select("doc_id", "text"), ["doc_id"], 10)


KEYS = ["conv_id", "turn"]
BATCHES = f"""{sql.TPAIRS},
    shuffled as (
      select *, row_number() over (order by md5(conv_id || ':' || turn || ':' || 1), conv_id, turn) - 1 as rn from tpairs),
    batches as (
      select *, rn // 16 as batch_id,
        row_number() over (partition by rn // 16 order by len(intent_tokens) desc, rn) - 1 as pos_in_batch,
        max(len(intent_tokens)) over (partition by rn // 16) as longest
      from shuffled)"""


def batched_pairs(pairs: DataFrame) -> DataFrame:
    return splits.assign_batches(pairs, KEYS, F.size("intent_tokens"), 16, seed=1)


@query("batch_assign", f"with {BATCHES} select conv_id, turn, batch_id, pos_in_batch, cast(len(intent_tokens) as bigint) as length from batches")
def batch_assign(spark: SparkSession, folder: str) -> DataFrame:
    return batched_pairs(views.token_pairs(spark, folder)).select(*KEYS, "batch_id", "pos_in_batch", "length")


PADDED = f"""{BATCHES},
    {sql.exploded('tpairs', 'intent_tokens', 'toks', 'conv_id', 'turn')},
    {sql.vocabulary('toks', 2, ('conv_id', 'turn'))},
    ids as (
      select conv_id, turn, list(coalesce(id, 3) order by pos) as ids from toks left join vocab on token = word
      group by conv_id, turn),
    padded as (
      select conv_id, turn, batch_id, pos_in_batch,
        list_transform(range(1, longest + 1), lambda i: coalesce(ids[i], 0)) as ids
      from batches left join ids using (conv_id, turn))"""


def padded_pairs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = bucketed(views.token_pairs(spark, folder), KEYS, "pairs")
    words = materialize(vocab.vocabulary(pairs, "intent_tokens", KEYS, cutoff=2), "vocabulary")
    placed = bucketed(batched_pairs(pairs), KEYS, "batches")
    return batching.pad_batches(vocab.encode(pairs, "intent_tokens", words, KEYS), placed, KEYS)


@query("pad_batch", f"with {PADDED} select conv_id, turn, batch_id, pos_in_batch, {sql.joined('ids')} as ids from padded")
def pad_batch(spark: SparkSession, folder: str) -> DataFrame:
    return padded_pairs(spark, folder).select(
        *KEYS, "batch_id", "pos_in_batch", array_text(F.col("ids").cast("array<string>")).alias("ids")
    )


@query(
    "transpose_batch",
    f"""with {PADDED},
    cells as (select batch_id, pos_in_batch, unnest(ids) as id, generate_subscripts(ids, 1) - 1 as step from padded)
    select batch_id, step, string_agg(cast(id as varchar), ' ' order by pos_in_batch) as ids from cells group by batch_id, step""",
)
def transpose_batch(spark: SparkSession, folder: str) -> DataFrame:
    return batching.transpose_batches(padded_pairs(spark, folder)).select(
        "batch_id", F.col("step").cast("bigint").alias("step"), array_text(F.col("ids").cast("array<string>")).alias("ids")
    )


@query(
    "length_mask",
    f"""with {BATCHES}
    select conv_id, turn, batch_id,
      repeat('0', len(intent_tokens)) || repeat('1', longest - len(intent_tokens)) as mask,
      repeat('1', len(intent_tokens)) || repeat('0', longest - len(intent_tokens)) as inverse from batches""",
)
def length_mask(spark: SparkSession, folder: str) -> DataFrame:
    batches = batched_pairs(views.token_pairs(spark, folder))
    masked = batching.mask_batches(batches).withColumnRenamed("mask", "padding")
    both = batching.mask_batches(masked, valid_is_one=True)
    flat = [F.array_join(F.col(c).cast("array<string>"), "").alias(n) for c, n in (("padding", "mask"), ("mask", "inverse"))]
    return both.select(*KEYS, "batch_id", *flat)


# The rules of the view: tokens without a letter or digit, numbered in sorted order from 1.
FEATURES = f"""{sql.TPAIRS},
    {sql.exploded('tpairs', 'intent_tokens', 'src', 'conv_id', 'turn')},
    {sql.exploded('tpairs', 'snippet_tokens', 'tgt', 'conv_id', 'turn')},
    rules as (
      select token, row_number() over (order by token) as rule_id from (
        select distinct token from tgt where not regexp_matches(token, '[A-Za-z0-9]') and regexp_matches(token, '^[\\x21-\\x7e]$'))),
    words as (select * from tgt where token not in (select token from rules)),
    {sql.vocabulary('words', 2, ('conv_id', 'turn'))},
    flagged as (
      select tgt.conv_id, tgt.turn, tgt.pos as step, tgt.token, rule_id, coalesce(id, 3) as id,
        exists (select 1 from src where src.conv_id = tgt.conv_id and src.turn = tgt.turn and src.token = tgt.token) as seen
      from tgt left join rules on rules.token = tgt.token left join vocab on vocab.word = tgt.token),
    features as (
      select conv_id, turn, step, token, cast(coalesce(rule_id, 0) as bigint) as rule_id,
        cast(rule_id is not null as int) as rule_mask,
        cast(case when rule_id is null then id else 0 end as bigint) as token_id,
        cast(rule_id is null and (not seen or id <> 3) as int) as gen_mask,
        cast(rule_id is null and seen as int) as copy_mask
      from flagged)"""


def pair_features(spark: SparkSession, folder: str) -> DataFrame:
    pairs = materialize(views.token_pairs(spark, folder), "pairs")
    types = open_list(pairs, "snippet_tokens").select("token").where(
        ~F.col("token").rlike("[A-Za-z0-9]") & F.col("token").rlike(r"\A[\x21-\x7e]\z")
    )
    rules = materialize(vocab.category_codes(types, "token", "rule_id").withColumn("rule_id", F.col("rule_id") + 1), "rules")
    tokens = counts.token_rows(pairs, "snippet_tokens", *KEYS)
    words = lookup_join(tokens, rules.select("token"), ["token"], "left_anti", [*KEYS, "pos"])
    primitives = materialize(vocab.vocabulary_of_rows(words, KEYS, cutoff=2), "vocabulary")
    features = batching.target_features(pairs, "intent_tokens", "snippet_tokens", rules, primitives, *KEYS)
    return features.withColumn("step", F.col("step").cast("bigint"))


@query("target_features", f"with {FEATURES} select * from features")
def target_features(spark: SparkSession, folder: str) -> DataFrame:
    return pair_features(spark, folder)


@query("primitive_mask", f"with {FEATURES} select conv_id, turn, step, greatest(gen_mask, copy_mask) as primitive_mask from features")
def primitive_mask(spark: SparkSession, folder: str) -> DataFrame:
    return batching.primitive_mask(pair_features(spark, folder)).select(*KEYS, "step", "primitive_mask")


@query(
    "topk_per_group",
    """with ranked as (
      select l_orderkey, l_extendedprice as score, cast(l_linenumber as bigint) as tie,
        row_number() over (partition by l_orderkey order by l_extendedprice desc, l_linenumber) as rank from lineitem)
    select l_orderkey, score, tie, cast(rank as int) as rank from ranked where rank <= 1 + l_orderkey % 3""",
)
def topk_per_group(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.candidates(spark, folder).select("l_orderkey", "score", "tie")
    width = (1 + F.col("l_orderkey") % 3).cast("int")
    return runs.top_per_group(rows, ["l_orderkey"], [F.desc("score"), F.asc("tie")], width, k_max=3)


@query(
    "best_normalised",
    """with scored as (
      select l_orderkey, cast(l_linenumber as bigint) as tie, l_extendedprice / l_quantity as score from lineitem),
    ranked as (select *, row_number() over (partition by l_orderkey order by score desc, tie desc) as rn from scored)
    select l_orderkey, tie, round(score, 9) as score from ranked where rn = 1""",
)
def best_normalised(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.candidates(spark, folder)
    best = runs.best_per_group(rows, ["l_orderkey"], F.col("score") / F.col("length"), "tie")
    return best.withColumn("score", F.round("score", 9))


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    return runs.metric_log(table(spark, folder, "events"), "user_id", ["ts", "event_id"], "value")


@query("running_best", f"with {sql.LOG} select run, epoch, metric, greatest(metric, best_before) as best, is_better from flagged")
def running_best(spark: SparkSession, folder: str) -> DataFrame:
    return runs.running_best(event_log(spark, folder))


@query(
    "patience_trials",
    f"""with {sql.LOG},
    islands as (select *, sum(is_better::int) over (partition by run order by epoch) as island,
      (not is_better and epoch >= 5)::int as stalled from flagged),
    stalls as (select *, sum(stalled) over (partition by run, island order by epoch) as since from islands),
    hits as (select *, (stalled = 1 and since % 3 = 0) as is_trial from stalls),
    tried as (select *, sum(is_trial::int) over (partition by run order by epoch) as trials from hits)
    select run, epoch, metric, is_better, cast(since % 3 as bigint) as stalls, is_trial, cast(trials as bigint) as trials
    from tried where trials < 5 or (trials = 5 and is_trial)""",
)
def patience_trials(spark: SparkSession, folder: str) -> DataFrame:
    return runs.patience_trials(event_log(spark, folder), patience=3, from_epoch=5, max_trials=5)


@query(
    "sort_by_length",
    f"""with {sql.SLOTS},
    listed as (select p_partkey, {sql.words('intent')} as tokens from slots),
    cells as (select p_partkey, unnest(tokens) as token, generate_subscripts(tokens, 1) as pos from listed)
    select p_partkey, string_agg(token, ' ' order by length(token) desc, pos) as tokens from cells group by p_partkey""",
)
def sort_by_length(spark: SparkSession, folder: str) -> DataFrame:
    return views.quoted_requests(spark, folder).select("p_partkey", array_text(longest_first(tokenize_ws("intent"))).alias("tokens"))
