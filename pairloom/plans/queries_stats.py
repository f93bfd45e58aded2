"""Counts, corpus statistics and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.functions.arrays import quoted_singles
from pairloom.functions.slots import slot_entries
from pairloom.functions.text import array_text, tokenize_code
from pairloom.operators import batching, counts, metrics, runs, vocab
from pairloom.operators.numbering import number_in_group
from pairloom.operators.lookup import lookup_join
from pairloom.plans import sql
from pairloom.plans.queries_rows import VOCAB2, docs_vocabulary
from pairloom.plans.registry import query
from pairloom.session import materialize
from pairloom.sources import views
from pairloom.sources.tables import table

COUNTS_SQL = f"{sql.DOCS}, {sql.TOKS}, counts as (select token, count(*) as freq from toks group by token)"


@query("token_counts", f"with {COUNTS_SQL} select token, freq from counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.token_counts(views.docs(spark, folder), "tokens")


@query(
    "vocab_stats",
    f"""with {COUNTS_SQL}
    select count(*) as types, count(*) filter (freq > 1) as repeated_types, count(*) filter (freq = 1) as singletons,
      cast(sum(freq) as bigint) as tokens, count(*) filter (freq < 3) as types_below,
      cast(coalesce(sum(freq) filter (freq < 3), 0) as bigint) as tokens_below from counts""",
)
def vocab_stats(spark: SparkSession, folder: str) -> DataFrame:
    return counts.vocabulary_stats(counts.token_counts(views.docs(spark, folder), "tokens"), cutoff=3)


@query(
    "unk_token_count",
    f"""with {VOCAB2}
    select count(*) filter (coalesce(id, 3) = 3) as unknown_tokens, count(*) as tokens
    from toks left join vocab on token = word""",
)
def unk_token_count(spark: SparkSession, folder: str) -> DataFrame:
    docs = views.docs(spark, folder)
    coded = vocab.lookup_ids(counts.token_rows(docs, "tokens", "doc_id"), docs_vocabulary(docs))
    return coded.agg(F.count_if(F.col("id") == vocab.UNKNOWN_ID).alias("unknown_tokens"), F.count(F.lit(1)).alias("tokens"))


@query("value_counts", "select lang, count(*) as n from documents group by lang")
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query(
    "length_stats",
    f"""with {sql.DOCS}
    select count(*) as n, cast(max(len(tokens)) as bigint) as longest, round(avg(len(tokens)), 9) as mean,
      round(var_pop(len(tokens)), 9) as variance from docs""",
)
def length_stats(spark: SparkSession, folder: str) -> DataFrame:
    return counts.length_stats(views.docs(spark, folder), F.size("tokens").cast("bigint"))


@query(
    "length_quantiles",
    f"""with {sql.DOCS}, shares as (select unnest([0.5, 0.7, 0.8, 0.9, 0.95])::double as share)
    select share, round(case share when 0.5 then a when 0.7 then b when 0.8 then c when 0.9 then d else e end, 9) as length
    from shares, (select quantile_cont(len(tokens), 0.5) a, quantile_cont(len(tokens), 0.7) b,
      quantile_cont(len(tokens), 0.8) c, quantile_cont(len(tokens), 0.9) d, quantile_cont(len(tokens), 0.95) e from docs)""",
)
def length_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    return counts.length_quantiles(views.docs(spark, folder), F.size("tokens")).withColumn("length", F.round("length", 9))


@query(
    "threshold_counts",
    f"""with {sql.DOCS}
    select count(*) filter (len(tokens) > 100) as over_100, count(*) filter (len(tokens) > 200) as over_200,
      count(*) filter (len(tokens) > 300) as over_300, count(*) filter (len(tokens) > 1000) as over_1000 from docs""",
)
def threshold_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.threshold_counts(views.docs(spark, folder), F.size("tokens"))


def grams_sql(width: int) -> str:
    ahead = ", ".join(f"lead(token, {i}) over w as g{i}" for i in range(width + 1))
    items = ", ".join(f"g{i}" for i in range(width))
    return f"""{sql.DOCS}, {sql.TOKS},
    shifted as (select {ahead} from toks window w as (partition by doc_id order by pos)),
    grams as (
      select {" || ' ' || ".join(f"g{i}" for i in range(width))} as gram, count(*) as freq
      from shifted where g{width} is not null group by {items})"""


@query("ngram_counts", f"with {grams_sql(3)} select gram, freq from grams")
def ngram_counts(spark: SparkSession, folder: str) -> DataFrame:
    grams = counts.ngram_counts(views.docs(spark, folder), "tokens", 3)
    return grams.select(counts.gram_text(3).alias("gram"), "freq")


@query("freq_of_freq", f"with {grams_sql(3)} select freq, count(*) as grams from grams group by freq")
def freq_of_freq(spark: SparkSession, folder: str) -> DataFrame:
    return counts.frequency_of_frequency(counts.ngram_counts(views.docs(spark, folder), "tokens", 3))


@query(
    "independent_ngrams",
    f"with {grams_sql(7)} select count(*) as distinct_grams, count(*) filter (freq >= 3) as frequent_grams from grams",
)
def independent_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    return counts.independent(counts.ngram_counts(views.docs(spark, folder), "tokens", 7))


@query("slot_totals", "select cast(5 * count(*) as bigint) as slots, count(*) as requests from part")
def slot_totals(spark: SparkSession, folder: str) -> DataFrame:
    slots = views.quoted_requests(spark, folder).select(F.size(slot_entries("intent")).alias("n"))
    return slots.agg(F.sum("n").alias("slots"), F.count(F.lit(1)).alias("requests"))


@query(
    "quoted_singletons",
    f"""with {sql.SLOTS},
    terms as (select unnest([name, phrase, size, type, name]) as term from slots)
    select count(*) as singletons from terms where len({sql.tok('term')}) = 1""",
)
def quoted_singletons(spark: SparkSession, folder: str) -> DataFrame:
    tokens = tokenize_code("intent")
    found = views.quoted_requests(spark, folder).select(F.size(quoted_singles(tokens)).alias("n"))
    return found.agg(F.sum("n").alias("singletons"))


SLOTTED = f"""{sql.PAIRS},
    slotted as (
      select conv_id, turn, {sql.tok("replace(intent, ' the ', ' var_0 ')")} as intent_tokens,
        {sql.tok("replace(snippet, ' the ', ' var_0 ')")} as snippet_tokens from pairs),
    common as (
      select *, list_filter(list_intersect(list_distinct(intent_tokens), list_distinct(snippet_tokens)), lambda t: not regexp_matches(t, '^(var|str)_[0-9]+$')) as shared
      from slotted)"""


@query(
    "overlap_count",
    f"with {SLOTTED} select cast(sum(len(shared)) as bigint) as shared, cast(sum(len(intent_tokens)) as bigint) as tokens from common",
)
def overlap_count(spark: SparkSession, folder: str) -> DataFrame:
    return counts.overlap_total(views.slotted_pairs(spark, folder), "intent_tokens", "snippet_tokens")


@query(
    "overlap_distinct",
    f"""with {SLOTTED}
    select (select count(distinct token) from (select unnest(shared) as token from common)) as shared_types,
      (select cast(sum(len(intent_tokens)) as bigint) from common) as tokens""",
)
def overlap_distinct(spark: SparkSession, folder: str) -> DataFrame:
    pairs = views.slotted_pairs(spark, folder)
    total = pairs.agg(F.sum(F.size("intent_tokens")).alias("tokens"))
    types = counts.overlap_types(pairs, "intent_tokens", "snippet_tokens").agg(F.count(F.lit(1)).alias("shared_types"))
    return types.select("shared_types", total.scalar().alias("tokens"))


@query("corpus_bleu", f"with {sql.PREDS}, {sql.bleu('preds', 'prediction', 'truth')} select round(bleu, 9) as bleu from score")
def corpus_bleu(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.corpus_bleu(views.predictions(spark, folder), "prediction", "truth").select(F.round("bleu", 9).alias("bleu"))


@query(
    "copy_bleu",
    f"""with {sql.TPAIRS}, {sql.bleu('tpairs', 'intent_tokens', 'snippet_tokens', 'forth')},
    {sql.bleu('tpairs', 'snippet_tokens', 'intent_tokens', 'back')}
    select 'intent' as candidate, round(bleu, 9) as bleu from forth
    union all select 'snippet', round(bleu, 9) from back""",
)
def copy_bleu(spark: SparkSession, folder: str) -> DataFrame:
    pairs = views.token_pairs(spark, folder)
    sides = F.array(
        F.struct(F.lit("intent").alias("side"), F.col("intent_tokens").alias("c"), F.col("snippet_tokens").alias("t")),
        F.struct(F.lit("snippet").alias("side"), F.col("snippet_tokens").alias("c"), F.col("intent_tokens").alias("t")),
    )
    both = pairs.select(F.inline(sides))
    return metrics.corpus_bleu(both, "c", "t", "side").select(F.col("side").alias("candidate"), F.round("bleu", 9).alias("bleu"))


@query("exact_match", f"with {sql.PREDS} select round(avg((truth = prediction)::int), 9) as accuracy from preds")
def exact_match(spark: SparkSession, folder: str) -> DataFrame:
    scored = metrics.exact_match(views.predictions(spark, folder), "prediction", "truth")
    return scored.select(F.round("accuracy", 9).alias("accuracy"))


@query(
    "eval_report",
    f"""with {sql.PREDS}, {sql.bleu('preds', 'prediction', 'truth')},
    hits as (select avg((truth = prediction)::int) as accuracy from preds)
    select 'BLEU' as metric, round(bleu * 100, 7) as value, round(accuracy * 100, 7) as other_value from score, hits""",
)
def eval_report(spark: SparkSession, folder: str) -> DataFrame:
    report = metrics.evaluation(views.predictions(spark, folder), "prediction", "truth")
    return report.select("metric", F.round("value", 7).alias("value"), F.round("other_value", 7).alias("other_value"))


@query(
    "epoch_loss",
    f"""with log as (
      select user_id as run, (row_number() over (partition by user_id order by ts, event_id) - 1) // 10 + 1 as epoch,
        value as loss, 1 + event_id % 16 as examples from events)
    select run, cast(epoch as bigint) as epoch, round(sum(loss) / sum(examples), 9) as loss from log group by 1, 2""",
)
def epoch_loss(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", "value")
    steps = number_in_group(events, ["user_id"], ["ts", "event_id"], "step")
    batches = steps.select(
        F.col("user_id").alias("run"),
        (F.floor((F.col("step") - 1) / 10) + 1).alias("epoch"),
        F.col("value").alias("loss"),
        (1 + F.col("event_id") % 16).alias("examples"),
    )
    return runs.epoch_loss(batches).withColumn("loss", F.round("loss", 9))


@query(
    "group_index",
    """with members as (select distinct p_type as category, p_brand as member from part)
    select category, row_number() over (partition by category order by member) as member_no, member,
      count(*) over (partition by category) as members from members""",
)
def group_index(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select(F.col("p_type").alias("category"), F.col("p_brand").alias("member"))
    members = materialize(number_in_group(parts.distinct(), ["category"], ["member"], "member_no"), "members")
    sizes = members.groupBy("category").agg(F.count(F.lit(1)).alias("members"))
    return lookup_join(members, sizes, ["category"], "inner").select("category", "member_no", "member", "members")


@query(
    "position_index",
    f"""with {sql.DOCS}, {sql.TOKS}
    select doc_id, token, string_agg(cast(pos as varchar), ' ' order by pos) as positions from toks group by doc_id, token""",
)
def position_index(spark: SparkSession, folder: str) -> DataFrame:
    index = batching.position_index(views.docs(spark, folder), "tokens", "doc_id")
    return index.select("doc_id", "token", array_text(F.col("positions").cast("array<string>")).alias("positions"))


@query(
    "marginal_weight",
    f"""with {VOCAB2},
    weighted as (select doc_id, token, sum(1.0 / (1 + pos % 7))::double as weight, min(pos) as pos from toks group by doc_id, token),
    coded as (select doc_id, token, weight, pos, coalesce(id, 3) as id from weighted left join vocab on token = word),
    ranked as (
      select *, row_number() over (partition by doc_id, id order by round(weight, 9) desc, pos) as rn from coded)
    select doc_id, id, token, round(weight, 6) as weight from ranked where id <> 3 or rn = 1""",
)
def marginal_weight(spark: SparkSession, folder: str) -> DataFrame:
    docs = materialize(views.docs(spark, folder), "tokens")
    # 1 / (1 + position % 7), as a cycle: a lambda costs as much as the sums.
    size, cycle = F.greatest(F.size("tokens"), F.lit(0)), F.array(*[F.lit(1.0 / (1 + i)) for i in range(7)])
    weights = F.slice(F.flatten(F.array_repeat(cycle, F.ceil(size / 7).cast("int"))), F.lit(1), size)
    summed = batching.marginal_weights(docs.withColumn("weights", weights), "tokens", "weights", docs_vocabulary(docs), "doc_id")
    return summed.select("doc_id", "id", "token", F.round("weight", 6).alias("weight"))
