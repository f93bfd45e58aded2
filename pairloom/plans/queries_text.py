"""Text, slots, literals and maps: native columns over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairloom.functions import slots as s, text as t, values as v
from pairloom.functions.arrays import sort_by_length
from pairloom.operators.metrics import error_table as errors_of
from pairloom.operators.rows import open_structs
from pairloom.operators.runs import expand_grid
from pairloom.plans import sql
from pairloom.plans.registry import query
from pairloom.sources import views
from pairloom.sources.tables import table


@query("tokenize_code", f"with {sql.DOCS} select doc_id, cast(len(tokens) as bigint) as n, {sql.joined('tokens')} as tokens from docs")
def tokenize_code(spark: SparkSession, folder: str) -> DataFrame:
    return views.docs(spark, folder).select("doc_id", F.size("tokens").cast("bigint").alias("n"), t.array_text("tokens").alias("tokens"))


@query("tokenize_ws", f"select doc_id, cast(len({sql.words('text')}) as bigint) as n, {sql.joined(sql.words('text'))} as tokens from documents")
def tokenize_ws(spark: SparkSession, folder: str) -> DataFrame:
    words = views.documents(spark, folder).select("doc_id", t.tokenize_ws("text").alias("w"))
    return words.select("doc_id", F.size("w").cast("bigint").alias("n"), t.array_text("w").alias("tokens"))


@query("lower_text", f"with {sql.PAIRS} select conv_id, turn, lower(intent) as intent, lower(snippet) as snippet from pairs")
def lower_text(spark: SparkSession, folder: str) -> DataFrame:
    return views.pairs(spark, folder).select("conv_id", "turn", *[t.lower_text(c).alias(c) for c in ("intent", "snippet")])


@query(
    "wrap_markers",
    f"""with {sql.DOCS}
    select doc_id, {sql.joined("list_concat(list_concat(['[CLS]'], tokens), ['[SEP]'])")} as model_text,
      cast(len(tokens) + 2 as bigint) as n from docs""",
)
def wrap_markers(spark: SparkSession, folder: str) -> DataFrame:
    wrapped = views.docs(spark, folder).select("doc_id", t.wrap_markers("tokens", t.MODEL_MARKERS).alias("w"))
    return wrapped.select("doc_id", t.array_text("w").alias("model_text"), F.size("w").cast("bigint").alias("n"))


ENTRY_LINES = "array_to_string(list_sort(['var_0=' || name, 'str_0=' || phrase, 'str_1=' || size, 'str_2=' || type, 'var_1=' || name]), chr(10))"


@query(
    "slots_intent",
    f"""with {sql.SLOTS}
    select p_partkey, 'set var_0 of str_0 to str_1 and str_2 not var_0' as text, {ENTRY_LINES} as slots from slots""",
)
def slots_intent(spark: SparkSession, folder: str) -> DataFrame:
    slotted = views.quoted_requests(spark, folder).select("p_partkey", "intent", s.slot_entries("intent").alias("entries"))
    return slotted.select(
        "p_partkey",
        s.slot_text("intent", F.col("entries")).alias("text"),
        s.map_lines(s.entry_map(F.col("entries"), "slot", "value")).alias("slots"),
    )


@query(
    "slot_type",
    f"""with {sql.SLOTS}
    select p_partkey, x.slot, x.quote, x.type from slots, lateral (
      values ('var_0', '`', 'var'), ('str_0', '"', 'str'), ('str_1', '`', 'str'), ('str_2', '''', 'str'), ('var_1', '`', 'var')
    ) x(slot, quote, type)""",
)
def slot_type(spark: SparkSession, folder: str) -> DataFrame:
    entries = open_structs(views.quoted_requests(spark, folder), s.slot_entries("intent"), "p_partkey")
    return entries.select("p_partkey", "slot", "quote", "type")


@query(
    "is_enumerable",
    f"""with {sql.SLOTS}
    select p_partkey, x.value, x.enumerable from slots, lateral (
      values ('[' || size || ', 1]', true), ('[' || size || ')', true), ('[]', false), (phrase, false), ('{{' || chr(10) || '}}', true)
    ) x(value, enumerable)""",
)
def is_enumerable(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("size")
    values = F.array(
        F.concat(F.lit("["), size, F.lit(", 1]")),
        F.concat(F.lit("["), size, F.lit(")")),
        F.lit("[]"),
        F.col("phrase"),
        F.lit("{\n}"),
    )
    rows = views.quoted_requests(spark, folder).select("p_partkey", F.explode(values).alias("value"))
    return rows.withColumn("enumerable", s.is_enumerable("value"))


@query(
    "fake_list",
    f"""with {sql.SLOTS}
    select p_partkey, name || ' = sum([str_0])' as code,
      '[str_0]=[' || size || ', 1]' || chr(10) || 'str_0=[' || size || ', 1]' || chr(10) || 'var_0=' || name as slots from slots""",
)
def fake_list(spark: SparkSession, folder: str) -> DataFrame:
    listed = F.concat(F.lit("["), F.col("size"), F.lit(", 1]"))
    rows = views.quoted_requests(spark, folder).select(
        "p_partkey",
        F.concat(F.lit("sum `"), listed, F.lit("` into `"), F.col("name"), F.lit("`")).alias("intent"),
        F.concat(F.col("name"), F.lit(" = sum("), listed, F.lit(")")).alias("code"),
    )
    slotted = rows.withColumn("entries", s.slot_entries("intent")).withColumn("fakes", s.fake_list_entries(F.col("entries")))
    return slotted.select(
        "p_partkey",
        s.fake_list_text("code", F.col("fakes")).alias("code"),
        s.map_lines(s.entry_map(F.concat("entries", "fakes"), "slot", "value")).alias("slots"),
    )


def query_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Requests with a repeated literal in two quotes, a skipped %s, and two variables."""
    literal = F.concat(F.lit("'"), F.col("type"), F.lit("'"))
    again = F.concat(F.lit('"'), F.col("type"), F.lit('"'))
    request = F.concat(
        F.lit("call "), F.col("name"), F.lit(" with "), literal, F.lit(" and "), again, F.lit(" or '%s' at "), F.col("size")
    )
    return views.quoted_requests(spark, folder).select(
        "p_partkey", request.alias("intent"), sort_by_length(F.array("size", "name")).alias("variables")
    )


@query(
    "slots_query",
    f"""with {sql.SLOTS}
    select p_partkey,
      replace(replace('call ' || name || ' with str_0 and str_0 or ''%s'' at ' || size, name, 'var_0'), size, 'var_1') as text,
      array_to_string(list_sort([type || '=str_0', name || '=var_0', size || '=var_1']), chr(10)) as slots from slots""",
)
def slots_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = query_rows(spark, folder).withColumn("slots", s.literal_slots("intent", F.col("variables")))
    return rows.select(
        "p_partkey",
        s.query_text("intent", F.col("slots"), F.col("variables")).alias("text"),
        s.map_lines(s.entry_map(F.col("slots"), "literal", "slot")).alias("slots"),
    )


@query(
    "unslot_conala",
    f"with {sql.SLOTS} select p_partkey, 'set ' || name || ' of ' || phrase || ' to ' || size || ' and ' || type || ' not ' || name as text from slots",
)
def unslot_conala(spark: SparkSession, folder: str) -> DataFrame:
    slotted = views.quoted_requests(spark, folder).withColumn("entries", s.slot_entries("intent"))
    mapped = slotted.select(
        "p_partkey",
        s.slot_text("intent", F.col("entries")).alias("text"),
        s.entry_map(F.col("entries"), "slot", "value").alias("slots"),
    )
    return mapped.select("p_partkey", s.unslot_words("text", F.col("slots")).alias("text"))


@query(
    "unslot_django",
    f"""with {sql.SLOTS}
    select p_partkey, 'set `' || name || '` of ' || phrase || ' to `' || size || '` and ' || type || ' not `' || name || '`' as text from slots""",
)
def unslot_django(spark: SparkSession, folder: str) -> DataFrame:
    slotted = views.quoted_requests(spark, folder).withColumn("slots", s.literal_slots("intent"))
    filled = slotted.withColumn("text", s.query_text("intent", F.col("slots")))
    return filled.select("p_partkey", s.unslot_literals("text", F.col("slots")).alias("text"))


BROKEN = f"""flatten(list_transform({sql.words('text')}, lambda w:
      case when instr(w, '.') between 1 and length(w) - 1
        then list_concat(list_concat([w, '['], string_split(replace(w, '.', ' . '), ' ')), [']']) else [w] end))"""


@query("break_dotted", f"select doc_id, {sql.joined(BROKEN)} as tokens from documents")
def break_dotted(spark: SparkSession, folder: str) -> DataFrame:
    broken = t.break_dotted(t.tokenize_ws("text"))
    return views.documents(spark, folder).select("doc_id", t.array_text(broken).alias("tokens"))


@query("percent_s_fix", "select p_partkey, 'use %s or %s for ' || p_name || ' not '' % d ''' as text from part")
def percent_s_fix(spark: SparkSession, folder: str) -> DataFrame:
    spaced = F.concat(F.lit("use ' % s ' or \" % s \" for "), F.col("p_name"), F.lit(" not ' % d '"))
    return table(spark, folder, "part").select("p_partkey", t.percent_s_fix(spaced).alias("text"))


SQL_WORD = r"[\p{L}\p{N}_]+"


@query(
    "extract_identifiers",
    rf"""select doc_id, array_to_string(list_concat(list_concat(
        regexp_extract_all(text, '[a-zA-Z.]*_{SQL_WORD}'), regexp_extract_all(text, '[a-zA-Z.]*\.{SQL_WORD}')),
        regexp_extract_all(text, '[A-Z.]+{SQL_WORD}')), ' ') as names from documents""",
)
def extract_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    return views.documents(spark, folder).select("doc_id", t.array_text(t.extract_identifiers("text")).alias("names"))


@query(
    "wrap_fragment",
    f"""with {sql.CODE}
    select p_partkey, case template when 5 then 'if True: pass' || chr(10) || code || 'pass'
      when 6 then code || chr(10) || 'def dummy(): pass' else code end as code from code""",
)
def wrap_fragment(spark: SparkSession, folder: str) -> DataFrame:
    return views.code_rows(spark, folder).select("p_partkey", t.wrap_fragment("code").alias("code"))


FIRST_WORD = "split_part(p_name, ' ', 1)"


@query(
    "mark_terms",
    f"""select p_partkey, replace(p_name || ' :param ' || {FIRST_WORD} || ':', {FIRST_WORD}, '`' || {FIRST_WORD} || '`') as doc from part""",
)
def mark_terms(spark: SparkSession, folder: str) -> DataFrame:
    first = F.split_part("p_name", F.lit(" "), F.lit(1))
    docs = table(spark, folder, "part").select("p_partkey", F.concat("p_name", F.lit(" :param "), first, F.lit(":")).alias("doc"))
    return docs.select("p_partkey", t.mark_terms("doc", t.param_terms("doc")).alias("doc"))


@query(
    "literal_value",
    """select p_partkey, x.item, x.kind, cast(x.l as bigint) as long, cast(x.d as double) as double, x.s as string from part, lateral (
      values (1, 'long', p_size::bigint, null::double, null::varchar),
        (2, 'long', trunc(p_retailprice)::bigint, null, null),
        (3, 'string', null, null, p_name),
        (4, 'long', p_size::bigint * 1000, null, null),
        (5, 'bool', case when p_size % 2 = 0 then 1 else 0 end, null, null),
        (6, 'string', null, null, p_type),
        (7, 'double', null, case when p_size % 2 = 0 then 'inf'::double else '-inf'::double end, null),
        (8, 'none', null, null, null),
        (9, 'string', null, null, '[' || p_size || ', 1]')
    ) x(item, kind, l, d, s)""",
)
def literal_value(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    even = F.col("p_size") % 2 == 0
    literals = F.array(
        size,
        F.col("p_retailprice").cast("string"),
        F.col("p_name"),
        F.concat(size, F.lit("e3")),
        F.when(even, F.lit("True")).otherwise(F.lit("False")),
        F.concat(F.lit("'"), F.col("p_type"), F.lit("'")),
        F.when(even, F.lit("inf")).otherwise(F.lit("-Infinity")),
        F.lit("None"),
        F.concat(F.lit("["), size, F.lit(", 1]")),
    )
    rows = table(spark, folder, "part").select("p_partkey", F.posexplode(literals).alias("i", "text"))
    read = rows.select("p_partkey", (F.col("i") + 1).alias("item"), v.literal_value("text").alias("v"))
    return read.select("p_partkey", "item", "v.kind", "v.long", "v.double", "v.string")


@query(
    "elapsed",
    """with s as (select event_id, (epoch_us(ts) % 86400000000) / 1000000.0::double as seconds from events)
    select event_id, cast(floor(seconds / 60) as bigint) as minutes,
      cast(floor(seconds - floor(seconds / 60) * 60) as bigint) as seconds from s""",
)
def elapsed(spark: SparkSession, folder: str) -> DataFrame:
    seconds = (F.unix_micros(F.col("ts").cast("timestamp")) % 86_400_000_000) / 1_000_000
    minutes, rest = v.elapsed(F.col("s"))
    events = table(spark, folder, "events").select("event_id", seconds.alias("s"))
    return events.select("event_id", minutes.alias("minutes"), rest.alias("seconds"))


@query(
    "run_path",
    """select p_partkey, './outputs/' || p_type || '.dataset_' || p_brand || '._word_freq_1.nl_embed_' || (p_size * f)
      || '.action_embed_256.att_size_512.hidden_size_' || (p_size + h)
      || '.epochs_60.dropout_enc_' || d || '.dropout_dec_0.3.batch_size16.parent_feeding_type_False'
      || '.parent_feeding_field_False.change_term_name_True.seed_1234/' as path
    from part cross join (values (8), (16)) a(f) cross join (values (0), (1)) b(h) cross join (values ('0.0'), ('0.3')) c(d)""",
)
def run_path(spark: SparkSession, folder: str) -> DataFrame:
    fixed = {
        "word_freq": "1",
        "action_embed_size": "256",
        "att_size": "512",
        "epochs": "60",
        "dropout_decoder": "0.3",
        "batch_size": "16",
        "parent_feeding_type": "False",
        "parent_feeding_field": "False",
        "change_term_name": "True",
        "seed": "1234",
    }

    def parameter(name: str) -> Column:
        return F.lit(fixed[name]) if name in fixed else F.col(name)

    runs = expand_grid(views.run_configs(spark, folder))
    return runs.select("p_partkey", v.run_path([parameter(p) for p in v.RUN_PARAMETERS]).alias("path"))


@query("array_len", f"with {sql.DOCS} select doc_id, cast(len(tokens) as bigint) as n from docs")
def array_len(spark: SparkSession, folder: str) -> DataFrame:
    return views.docs(spark, folder).select("doc_id", F.size("tokens").cast("bigint").alias("n"))


@query("array_text", f"with {sql.PREDS} select conv_id, turn, {sql.joined('prediction')} as text from preds")
def array_text(spark: SparkSession, folder: str) -> DataFrame:
    return views.predictions(spark, folder).select("conv_id", "turn", t.array_text("prediction").alias("text"))


@query(
    "json_cells",
    """select event_id, cast(json_extract(props, '$.k') as bigint) as k, '{"k":' || json_extract(props, '$.k') || '}' as cell from events""",
)
def json_cells(spark: SparkSession, folder: str) -> DataFrame:
    cells = table(spark, folder, "events").select("event_id", F.from_json("props", "k bigint").alias("p"))
    return cells.select("event_id", "p.k", F.to_json("p").alias("cell"))


def slot_maps(spark: SparkSession, folder: str) -> DataFrame:
    requests = views.quoted_requests(spark, folder)
    return requests.select("p_partkey", s.entry_map(s.slot_entries("intent"), "slot", "value").alias("slots"))


@query("map_lookup", f"with {sql.SLOTS} select p_partkey, type as known, 'none' as missing from slots")
def map_lookup(spark: SparkSession, folder: str) -> DataFrame:
    default = F.lit("none")
    return slot_maps(spark, folder).select(
        "p_partkey",
        s.map_lookup("slots", F.lit("str_2"), default).alias("known"),
        s.map_lookup("slots", F.lit("str_9"), default).alias("missing"),
    )


@query(
    "map_invert",
    f"""with {sql.SLOTS}
    select p_partkey, array_to_string(list_sort(
      [name || '=var_1', phrase || '=str_0', size || '=str_1', type || '=str_2']), chr(10)) as slots from slots""",
)
def map_invert(spark: SparkSession, folder: str) -> DataFrame:
    return slot_maps(spark, folder).select("p_partkey", s.map_lines(s.map_invert("slots")).alias("slots"))


@query(
    "error_table",
    f"""with {sql.PREDS}
    select intent, {sql.joined('truth')} as truth, {sql.joined('prediction')} as prediction from preds where truth <> prediction""",
)
def error_table(spark: SparkSession, folder: str) -> DataFrame:
    return errors_of(views.predictions(spark, folder), "prediction", "truth", "intent")
