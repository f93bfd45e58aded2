"""Projections, filters, joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.functions.text import array_text, map_other, request, tokenize_ws, without
from pairloom.functions.slots import slot_entries, slot_text, without_slot_names
from pairloom.operators import code, counts, splits, vocab
from pairloom.operators.batching import copy_positions as copy_position_rows, copy_spots as copy_spot_rows, parent_category
from pairloom.operators.metrics import join_predictions as join_by_key
from pairloom.operators.numbering import number_rows
from pairloom.operators.runs import expand_grid
from pairloom.plans import sql
from pairloom.plans.registry import query
from pairloom.session import materialize
from pairloom.sources import formats, views
from pairloom.sources.routing import route
from pairloom.sources.tables import table

LENGTH_LIMIT = code.LENGTH_LIMIT
# Fixed values for the views: tokens that play the part of grammar actions.
ACTION_TOKENS = (".", ",", "Reduce")
ACTION_LIST = ", ".join(f"'{t}'" for t in ACTION_TOKENS)


@query("project_columns", f"with {sql.PAIRS} select conv_id, turn, intent from pairs")
def project_columns(spark: SparkSession, folder: str) -> DataFrame:
    return views.pairs(spark, folder).select("conv_id", "turn", "intent")


@query("coalesce_intent", f"with {sql.ANNOT} select conv_id, turn, coalesce(nullif(rewritten_intent, ''), intent) as intent from annot")
def coalesce_intent(spark: SparkSession, folder: str) -> DataFrame:
    return views.annotated(spark, folder).select("conv_id", "turn", request("rewritten_intent", "intent").alias("intent"))


@query("filter_nonnull", f"with {sql.ANNOT} select conv_id, turn, rewritten_intent from annot where rewritten_intent is not null")
def filter_nonnull(spark: SparkSession, folder: str) -> DataFrame:
    return views.annotated(spark, folder).where(F.col("rewritten_intent").isNotNull()).select("conv_id", "turn", "rewritten_intent")


@query(
    "filter_lengths",
    f"""with {sql.DOCS},
    sized as (
      select doc_id, cast(len(list_filter(tokens, lambda t: t in ({ACTION_LIST}))) as bigint) as n_actions,
        cast(len(tokens) as bigint) as n_code, cast(len({sql.words('text')}) as bigint) as n_query from docs)
    select doc_id, n_actions, n_code, n_query,
      case when n_actions > {LENGTH_LIMIT} then 'long_actions' when n_query > {LENGTH_LIMIT} then 'long_intent'
        when n_code > {LENGTH_LIMIT} then 'long_code' else 'kept' end as status
    from sized""",
)
def filter_lengths(spark: SparkSession, folder: str) -> DataFrame:
    sized = views.docs(spark, folder, "text").select(
        "doc_id",
        F.size(F.filter("tokens", lambda t: t.isin(*ACTION_TOKENS))).cast("bigint").alias("n_actions"),
        F.size("tokens").cast("bigint").alias("n_code"),
        F.size(tokenize_ws("text")).cast("bigint").alias("n_query"),
    )
    lengths = {"actions": F.col("n_actions"), "intent": F.col("n_query"), "code": F.col("n_code")}
    return sized.withColumn("status", code.length_status(lengths))


@query("filter_len_max", f"with {sql.DOCS} select doc_id, {sql.joined('tokens')} as tokens from docs where len(tokens) <= {LENGTH_LIMIT}")
def filter_len_max(spark: SparkSession, folder: str) -> DataFrame:
    return views.docs(spark, folder).where(F.size("tokens") <= LENGTH_LIMIT).select("doc_id", array_text("tokens").alias("tokens"))


@query("filter_len_equals", f"with {sql.DOCS} select doc_id, {sql.joined('tokens')} as tokens from docs where len(tokens) = 135")
def filter_len_equals(spark: SparkSession, folder: str) -> DataFrame:
    return views.docs(spark, folder).where(F.size("tokens") == 135).select("doc_id", array_text("tokens").alias("tokens"))


@query(
    "quarantine",
    f"""with {sql.CODE}
    select case when template < 5 then 'ok' else 'SyntaxError' end as status, template < 5 as good, count(*) as n
    from code group by all""",
)
def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    checked = code.with_facts(views.code_rows(spark, folder), "code")
    sides = route(checked, {"SyntaxError": F.col("status") != "ok"}, ["p_partkey", "code"], "code")
    kept = sides.kept.select(F.lit("ok").alias("status"), F.lit(True).alias("good"))
    return code.status_counts(kept.union(sides.rejects.select("reason", F.lit(False))), "good")


@query(
    "filter_terminals",
    f"""with {sql.DOCS}
    select doc_id, {sql.joined(f"list_filter(tokens, lambda t: t not in ({ACTION_LIST}))")} as primitives from docs""",
)
def filter_terminals(spark: SparkSession, folder: str) -> DataFrame:
    return views.docs(spark, folder).select("doc_id", array_text(without("tokens", ACTION_TOKENS)).alias("primitives"))


@query(
    "filter_slot_names",
    f"""with {sql.SLOTS}
    select p_partkey, 'set of to and not' as tokens, cast(5 as bigint) as n from slots""",
)
def filter_slot_names(spark: SparkSession, folder: str) -> DataFrame:
    requests = views.quoted_requests(spark, folder)
    tokens = tokenize_ws(slot_text("intent", slot_entries("intent")))
    left = requests.select("p_partkey", without_slot_names(tokens).alias("t"))
    return left.select("p_partkey", array_text("t").alias("tokens"), F.size("t").cast("bigint").alias("n"))


@query("filter_min_freq", f"with {sql.DOCS}, {sql.TOKS} select token, count(*) as freq from toks group by token having count(*) >= 5")
def filter_min_freq(spark: SparkSession, folder: str) -> DataFrame:
    return counts.token_counts(views.docs(spark, folder), "tokens").where("freq >= 5")


@query(
    "map_other_to_id",
    f"""with {sql.DOCS}
    select doc_id, '<s> ' || {sql.joined(f"list_transform(tokens, lambda t: case when t in ({ACTION_LIST}) then t else 'id' end)")} || ' </s>' as sentence,
      cast(len(tokens) as bigint) as n from docs""",
)
def map_other_to_id(spark: SparkSession, folder: str) -> DataFrame:
    mapped = views.docs(spark, folder).select("doc_id", map_other("tokens", ACTION_TOKENS).alias("t"))
    return mapped.select("doc_id", formats.sentence_line("t").alias("sentence"), F.size("t").cast("bigint").alias("n"))


@query(
    "zip_positional",
    f"""with {sql.PAIRS}
    select row_number() over (order by conv_id, turn) as line_no, intent, snippet from pairs""",
)
def zip_positional(spark: SparkSession, folder: str) -> DataFrame:
    pairs = views.pairs(spark, folder)
    order = ["conv_id", "turn"]
    left = number_rows(pairs.select(*order, "intent"), order, "line_no").select("line_no", "intent")
    right = number_rows(pairs.select(*order, "snippet"), order, "line_no").select("line_no", "snippet")
    return formats.pair_lines(left, right)


@query(
    "join_predictions",
    f"""with {sql.PREDS}
    select conv_id, turn, {sql.joined('truth')} as truth,
      case when (conv_id + turn) % 11 = 0 then '' else {sql.joined('prediction')} end as prediction from preds""",
)
def join_predictions(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.predictions(spark, folder)
    keys = ["conv_id", "turn"]
    made = rows.where((F.col("conv_id") + F.col("turn")) % 11 != 0).select(*keys, "prediction")
    return join_by_key(rows.select(*keys, "truth"), made, keys).select(
        *keys, array_text("truth").alias("truth"), array_text("prediction").alias("prediction")
    )


VOCAB2 = f"{sql.DOCS}, {sql.TOKS}, {sql.vocabulary('toks', 2)}"


def staged_docs(spark: SparkSession, folder: str) -> DataFrame:
    """The documents' tokens, written once for queries that read them twice."""
    return materialize(views.docs(spark, folder), "tokens")


def docs_vocabulary(docs: DataFrame, cutoff: int = 2) -> DataFrame:
    return materialize(vocab.vocabulary(docs, "tokens", ["doc_id"], cutoff), "vocabulary")


@query(
    "encode_ids",
    f"""with {VOCAB2}
    select doc_id, string_agg(cast(coalesce(id, 3) as varchar), ' ' order by pos) as ids
    from toks left join vocab on token = word group by doc_id
    union all select doc_id, '' from docs where len(tokens) = 0""",
)
def encode_ids(spark: SparkSession, folder: str) -> DataFrame:
    docs = staged_docs(spark, folder)
    coded = vocab.encode(docs, "tokens", docs_vocabulary(docs), ["doc_id"])
    return coded.select("doc_id", array_text(F.col("ids").cast("array<string>")).alias("ids"))


@query(
    "decode_ids",
    f"""with {VOCAB2}
    select doc_id, string_agg(coalesce(word, '<unk>'), ' ' order by pos) as tokens
    from toks left join vocab on token = word group by doc_id
    union all select doc_id, '' from docs where len(tokens) = 0""",
)
def decode_ids(spark: SparkSession, folder: str) -> DataFrame:
    docs = staged_docs(spark, folder)
    words = docs_vocabulary(docs)
    coded = vocab.encode(docs, "tokens", words, ["doc_id"])
    return vocab.decode(coded, "ids", words, ["doc_id"]).select("doc_id", array_text("tokens").alias("tokens"))


@query("is_unk_anti", f"with {VOCAB2} select doc_id, pos, token from toks where token not in (select word from vocab)")
def is_unk_anti(spark: SparkSession, folder: str) -> DataFrame:
    docs = staged_docs(spark, folder)
    return vocab.unknown_rows(docs, "tokens", docs_vocabulary(docs), "doc_id").select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "token"
    )


@query("semi_known", f"with {VOCAB2} select doc_id, count(*) as n_known from toks where token in (select word from vocab) group by doc_id")
def semi_known(spark: SparkSession, folder: str) -> DataFrame:
    docs = staged_docs(spark, folder)
    known = vocab.known_rows(docs, "tokens", docs_vocabulary(docs), "doc_id")
    return known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_known"))


@query(
    "copy_positions",
    f"""with {sql.TPAIRS},
    {sql.exploded('tpairs', 'intent_tokens', 'src', 'conv_id', 'turn')},
    {sql.exploded('tpairs', 'snippet_tokens', 'tgt', 'conv_id', 'turn')}
    select conv_id, turn, tgt.pos as step, token, string_agg(cast(src.pos as varchar), ' ' order by src.pos) as positions
    from tgt join src using (conv_id, turn, token) group by conv_id, turn, tgt.pos, token""",
)
def copy_positions(spark: SparkSession, folder: str) -> DataFrame:
    rows = copy_position_rows(views.token_pairs(spark, folder), "intent_tokens", "snippet_tokens", "conv_id", "turn")
    return rows.select(
        "conv_id", "turn", F.col("step").cast("bigint").alias("step"), "token", array_text(F.col("positions").cast("array<string>")).alias("positions")
    )


@query(
    "copy_spots",
    f"""with {sql.TPAIRS},
    {sql.exploded('tpairs', 'intent_tokens', 'src', 'conv_id', 'turn')},
    {sql.exploded('tpairs', 'snippet_tokens', 'tgt', 'conv_id', 'turn')}
    select conv_id, turn, token, array_to_string(list_sort(list(distinct src.pos)), ' ') as positions,
      array_to_string(list_sort(list(distinct tgt.pos)), ' ') as steps
    from tgt join src using (conv_id, turn, token) group by conv_id, turn, token""",
)
def copy_spots(spark: SparkSession, folder: str) -> DataFrame:
    spots = copy_spot_rows(views.token_pairs(spark, folder), "intent_tokens", "snippet_tokens", "conv_id", "turn")
    texts = [array_text(F.col(c).cast("array<string>")).alias(c) for c in ("positions", "steps")]
    return spots.select("conv_id", "turn", "token", *texts)


@query(
    "fallback_lookup",
    """with steps as (
      select l_orderkey, cast(l_linenumber as bigint) as step, min(l_suppkey) as category from lineitem group by 1, 2)
    select s.l_orderkey, s.step, s.category, coalesce(p.category, 0) as parent_category
    from steps s left join steps p on p.l_orderkey = s.l_orderkey and p.step = s.step - 1""",
)
def fallback_lookup(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("step"), "l_suppkey")
    steps = lines.groupBy("l_orderkey", "step").agg(F.min("l_suppkey").alias("category"))
    return parent_category(steps, ["l_orderkey"], "step", "category")


@query(
    "grid_cross",
    """select p_partkey, p_type as model, p_brand as dataset, h as hidden_size, e as nl_embed_size, d as dropout_encoder
    from (select *, unnest([p_size::bigint, p_size::bigint + 1]) as h from part)
      cross join (values (8), (16)) x(f) cross join (values ('0.0'), ('0.3')) y(d),
      lateral (select p_size::bigint * f as e)""",
)
def grid_cross(spark: SparkSession, folder: str) -> DataFrame:
    return expand_grid(views.run_configs(spark, folder)).select(
        "p_partkey", "model", "dataset", "hidden_size", "nl_embed_size", "dropout_encoder"
    )


SPLIT_SQL = """case when rn <= 50 then 'test' when rn <= 80 then 'dev' else 'train' end"""


@query(
    "union_splits",
    f"""with {sql.PAIRS}, placed as (select *, row_number() over (order by conv_id desc, turn desc) as rn from pairs)
    select conv_id, turn, intent, {SPLIT_SQL} as origin from placed""",
)
def union_splits(spark: SparkSession, folder: str) -> DataFrame:
    whole = splits.tail_split(views.pairs(spark, folder).select("conv_id", "turn", "intent"), ["conv_id", "turn"], 50, 30)
    parts = {name: whole.where(F.col("split") == name).drop("split") for name in ("train", "dev", "test")}
    return splits.stack(parts)


@query(
    "merge_mined",
    f"""with {sql.ANNOT}
    select 'annotated' as origin, conv_id as row_id, coalesce(nullif(rewritten_intent, ''), intent) as intent, snippet from annot
    union all select 'mined', doc_id, source, text from (select * from documents order by doc_id limit 100)""",
)
def merge_mined(spark: SparkSession, folder: str) -> DataFrame:
    annotated = views.annotated(spark, folder).select(
        F.col("conv_id").alias("row_id"), request("rewritten_intent", "intent").alias("intent"), "snippet"
    )
    mined = table(spark, folder, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("source").alias("intent"), F.col("text").alias("snippet")
    )
    return splits.stack({"annotated": annotated, "mined": splits.first_rows(mined, ["row_id"], 100)}).select(
        "origin", "row_id", "intent", "snippet"
    )


@query(
    "array_overlap",
    f"""with {sql.TPAIRS}
    select conv_id, turn, {sql.joined("list_sort(list_intersect(intent_tokens, snippet_tokens))")} as shared from tpairs""",
)
def array_overlap(spark: SparkSession, folder: str) -> DataFrame:
    shared = F.sort_array(counts.shared_distinct("intent_tokens", "snippet_tokens"))
    return views.token_pairs(spark, folder).select("conv_id", "turn", array_text(shared).alias("shared"))


@query(
    "distinct_first_seen",
    f"""with {sql.DOCS}, {sql.TOKS}
    select token, row_number() over (order by min(struct_pack(d := doc_id, p := pos))) as rank from toks group by token""",
)
def distinct_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    seen = counts.first_seen(views.docs(spark, folder), "tokens", ["doc_id"])
    return number_rows(seen.select("token", "first"), ["first"], "rank").select("token", "rank")


@query(
    "except_words",
    f"""with {VOCAB2}
    select token, count(*) as freq from toks where token not in (select word from vocab) group by token""",
)
def except_words(spark: SparkSession, folder: str) -> DataFrame:
    # Counts and vocabulary come from the same documents: what it lacks is what is rarer than its cutoff.
    counted = counts.token_counts(views.docs(spark, folder), "tokens")
    return counted.where((F.col("freq") < 2) & ~F.col("token").isin(*vocab.SPECIALS, vocab.CLOSER))
