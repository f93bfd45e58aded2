"""Sources and sinks: every query writes a given table in a format and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.functions.text import array_text, strip, tokenize_code
from pairloom.operators.metrics import corpus_bleu, error_table
from pairloom.plans import sql
from pairloom.plans.registry import query
from pairloom.session import fresh_path, materialize, materialize_once
from pairloom.sources import formats, views
from pairloom.sources.routing import Routed
from pairloom.sources.tables import table

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value", "props"]
EVENT_FIELDS = "event_id bigint, user_id bigint, event_type string, value double, props string, ts string"


# The lines of the view that are no records, and why.
EVENT_STATUS = """status as (
      select *, case when event_id % 97 = 0 or event_id % 89 = 0 then 'broken' when event_id % 83 = 0 then 'missing_event_type' else 'kept' end as status,
        case when event_id % 97 = 0 then '{"event_id":' || event_id || ',"event_type":"' || event_type
          when event_id % 89 = 0 then '{"event_id":"x' || event_id || '","event_type":"' || event_type || '"}'
          else '{"event_id":' || event_id || '}' end as line from events)"""


def scanned_events(spark: SparkSession, folder: str, compression: str = "none") -> Routed:
    path = fresh_path(spark, "jsonl")
    formats.write_lines(views.event_lines(spark, folder), path, compression)
    return formats.scan_json_lines(spark, f"{path}/*.txt*", EVENT_FIELDS, ["event_id", "event_type"])


@query("scan_jsonl_gz", f"with {EVENT_STATUS} select event_id, user_id, event_type, value, props from status where status = 'kept'")
def scan_jsonl_gz(spark: SparkSession, folder: str) -> DataFrame:
    return scanned_events(spark, folder, "gzip").kept.select(*EVENT_COLUMNS)


@query("scan_jsonl", f"with {EVENT_STATUS} select event_id, event_type, value from status where status = 'kept'")
def scan_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    return scanned_events(spark, folder).kept.select("event_id", "event_type", "value")


@query("scan_jsonl_rejects", f"with {EVENT_STATUS} select line as record, status as reason from status where status <> 'kept'")
def scan_jsonl_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return scanned_events(spark, folder, "gzip").rejects


@query(
    "scan_jsonl_counts",
    f"""with {EVENT_STATUS}
    select 'before' as status, count(*) as n from status
    union all select s, (select count(*) from status where status = s) from (values ('kept'), ('broken'), ('missing_event_id'), ('missing_event_type')) x(s)""",
)
def scan_jsonl_counts(spark: SparkSession, folder: str) -> DataFrame:
    return scanned_events(spark, folder).counts


@query("scan_json_array", "select p_partkey, p_name, p_brand, p_size from part")
def scan_json_array(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "json-array")
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    formats.write_json_arrays(parts, path, F.floor(F.col("p_partkey") / 5000))
    return formats.read_json_array(spark, path, "p_partkey bigint, p_name string, p_brand string, p_size int").select(
        *parts.columns
    )


@query(
    "scan_csv_arrays",
    f"""with {sql.TPAIRS}
    select conv_id, turn, cast(len(intent_tokens) as bigint) as n_intent, {sql.joined('intent_tokens')} as intent_text,
      {sql.joined('snippet_tokens')} as snippet_text from tpairs""",
)
def scan_csv_arrays(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    pairs = views.token_pairs(spark, folder)
    formats.write_csv(pairs, path)
    back = formats.read_csv(spark, path, "conv_id bigint, turn bigint, intent_tokens array<string>, snippet_tokens array<string>")
    return back.select(
        "conv_id",
        "turn",
        F.size("intent_tokens").cast("bigint").alias("n_intent"),
        array_text("intent_tokens").alias("intent_text"),
        array_text("snippet_tokens").alias("snippet_text"),
    )


@query(
    "scan_parallel_lines",
    f"""with {sql.PAIRS}
    select row_number() over (order by conv_id, turn) as line_no, replace(intent, chr(10), ' ') as intent,
      replace(snippet, chr(10), ' ') as snippet from pairs""",
)
def scan_parallel_lines(spark: SparkSession, folder: str) -> DataFrame:
    one_line = [F.replace(c, F.lit("\n"), F.lit(" ")).alias(c) for c in ("intent", "snippet")]
    pairs = materialize(views.pairs(spark, folder).select("conv_id", "turn", *one_line), "pairs")
    ordered = pairs.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn")
    paths = {c: fresh_path(spark, c) for c in ("intent", "snippet")}
    for c, path in paths.items():
        ordered.select(c).write.text(path)
    return formats.read_parallel_lines(spark, paths["intent"], paths["snippet"])


PREPARED = f"""with {sql.TPAIRS}
    select conv_id, turn, {sql.joined('intent_tokens')} as intent, {sql.joined('snippet_tokens')} as snippet from tpairs"""


@query("sink_table", PREPARED)
def sink_table(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "table")
    formats.write_table(views.token_pairs(spark, folder), path)
    back = spark.read.parquet(path)
    return back.select("conv_id", "turn", array_text("intent_tokens").alias("intent"), array_text("snippet_tokens").alias("snippet"))


@query(
    "sink_stage",
    f"""with {sql.PAIRS}
    select conv_id, turn, cast(len({sql.tok("lower(intent)")}) as bigint) as n_intent,
      cast(len({sql.tok('snippet')}) as bigint) as n_snippet from pairs""",
)
def sink_stage(spark: SparkSession, folder: str) -> DataFrame:
    lowered = materialize_once(views.pairs(spark, folder).withColumn("intent", F.lower("intent")), "lowered")
    tokenized = materialize_once(
        lowered.select("conv_id", "turn", tokenize_code("intent").alias("i"), tokenize_code(strip("snippet")).alias("s")), "tokenized"
    )
    return tokenized.select(
        "conv_id", "turn", F.size("i").cast("bigint").alias("n_intent"), F.size("s").cast("bigint").alias("n_snippet")
    )


@query("sink_sentences", f"with {sql.DOCS} select '<s> ' || {sql.joined('tokens')} || ' </s>' as value from docs")
def sink_sentences(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "sentences")
    formats.write_sentences(views.docs(spark, folder), "tokens", path)
    return spark.read.text(path).select("value")


@query("sink_tokens", f"with {sql.DOCS}, {sql.TOKS} select token as value, count(*) as n from toks group by token")
def sink_tokens(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    formats.write_tokens(views.docs(spark, folder), "tokens", path)
    return spark.read.text(path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sink_results",
    f"""with {sql.PREDS}, {sql.bleu('preds', 'prediction', 'truth')}
    select intent, {sql.joined('truth')} as truth, {sql.joined('prediction')} as prediction,
      'pairs' as dataset, 'edit' as model, 1 as beam, printf('BLEU=%.4f', bleu * 100) as metric
    from preds, score where truth <> prediction""",
)
def sink_results(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "results")
    scored = materialize(views.predictions(spark, folder), "predictions")
    metric = corpus_bleu(scored, "prediction", "truth").select(F.format_string("BLEU=%.4f", F.col("bleu") * 100))
    errors = error_table(scored, "prediction", "truth", "intent").select(
        "*", F.lit("pairs").alias("dataset"), F.lit("edit").alias("model"), F.lit(1).alias("beam"), metric.scalar().alias("metric")
    )
    formats.write_results(errors, path, ("dataset", "model", "beam", "metric"))
    return spark.read.schema(errors.schema).parquet(path).select(*errors.columns)
