"""Chat messages as canonical JSON lines, with tool calls linked to their results.

A message is plain text, or JSON: an assistant message may hold ``tool_calls`` (id, name, arguments), a tool message names its
``tool_call_id``; arguments may use another call's result as ``{"$result": "<call id>"}``. Calls and results are joined by
(conversation, call id). A result comes after its call, and a call after the results it uses: messages are ordered by
levels, each round placing those whose predecessors are all placed, until a round places none; what is left is a cycle.
``after`` is the latest turn a message must follow, itself included, so (after, level, turn) is a topological order of a
conversation. Nothing is gathered per conversation, so a conversation with most of the turns stays spread.

Arguments are checked against ``schemas``: name -> {argument: (JSON type, required)}. Lines have sorted keys and no blanks.

A null text is an empty content, a null role an empty one. Text that is not the JSON of a call or a result is content as it is. Of calls that
repeat an id in a conversation the first turn counts, the others are errors. Rows that repeat conversation and turn are kept as they
are. Messages without conversation or turn are never linked. Other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.stages import Stage

Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]

_MESSAGE = "content string, tool_call_id string, tool_calls array<struct<id:string,name:string,arguments:string>>"
_KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def check_arguments(name: str | None, arguments: str | None, schemas: Schemas) -> tuple[object, str | None]:
    """The decoded arguments and the first fault; a name without a schema is a fault if there are schemas at all."""
    try:
        value = json.loads(arguments) if arguments else {}
    except (ValueError, RecursionError):
        return arguments, "arguments are not JSON"
    if not isinstance(value, dict):
        return value, "arguments are not an object"
    if not schemas:
        return value, None
    if name not in schemas:
        return value, f"no tool {name}"
    for key, (kind, required) in sorted(schemas[name].items()):
        if key not in value:
            if required:
                return value, f"{key} is missing"
        elif not _fits(value[key], kind):
            return value, f"{key} is not {kind}"
    unknown = sorted(set(value) - set(schemas[name]))
    return value, f"{unknown[0]} is unknown" if unknown else None


def _fits(value: object, kind: str) -> bool:
    if isinstance(value, dict) and set(value) == {"$result"}:
        return True  # known only when the other call has returned
    if isinstance(value, bool) and kind != "boolean":
        return False
    return isinstance(value, _KINDS[kind])


def _serialise(schemas: Schemas):
    """Rows with a call or a result -> their line and the first fault."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, faults = [], []
            for role, content, result, calls in zip(*(batch.column(c).to_pylist() for c in ("role", "content", "tool_call_id", "tool_calls"))):
                message: dict[str, object] = {"content": content or "", "role": role}
                fault = None
                if result is not None:
                    message["tool_call_id"] = result
                if calls:
                    made = []
                    for call in calls:
                        call = call or {}
                        arguments, wrong = check_arguments(call.get("name"), call.get("arguments"), schemas)
                        fault = fault or wrong
                        made.append({"arguments": arguments, "id": call.get("id"), "name": call.get("name")})
                    message["tool_calls"] = made
                lines.append(canonical(message))
                faults.append(fault)
            columns = [batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.string()), pa.array(faults, pa.string())], names=[*batch.schema.names, "line", "fault"])

    return run


def _order(links: DataFrame) -> tuple[DataFrame, list[Stage]]:
    """conv, turn, after, level of every message in a link (conv, turn, needs); cyclic ones have no level."""
    edges = Stage(links.distinct(), "edges")
    nodes = edges.df.select("conv", "turn").union(edges.df.select("conv", F.col("needs").alias("turn"))).distinct()
    waiting = edges.df.select("conv", "turn").distinct()
    placed = Stage(nodes.join(waiting, ["conv", "turn"], "left_anti").select("conv", "turn", F.col("turn").alias("after"), F.lit(0).alias("level")), "placed")
    stages = [edges]
    level, before = 0, placed.df.count()
    while before:
        level += 1
        done = placed.df.select("conv", F.col("turn").alias("needs"), F.col("after").alias("at"))
        ready = (
            edges.df.join(placed.df.select("conv", "turn"), ["conv", "turn"], "left_anti")
            .join(done, ["conv", "needs"], "left")
            .groupBy("conv", "turn")
            .agg(F.max("at").alias("at"), F.count_if(F.col("at").isNull()).alias("open"))
            .where("open = 0")
            .select("conv", "turn", F.greatest("turn", "at").alias("after"), F.lit(level).alias("level"))
        )
        more = Stage(ready, "ready")
        found = more.df.count()
        stages += [placed, more]
        if not found:
            break
        placed = Stage(placed.df.union(more.df), "placed")
    return nodes.join(placed.df, ["conv", "turn"], "left"), stages


def format_chats(
    turns: DataFrame, schemas: Schemas | None = None, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Per row of ``turns``: conv, turn, kind (message, call, result), after, level, valid, fault, line."""
    rows = turns.select(
        F.col(conversation).cast("bigint").alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    looks = F.col("role").isin("assistant", "tool") & F.trim("text").startswith("{")
    parsed = rows.withColumn("json", F.when(looks, F.from_json("text", _MESSAGE)))
    kind = (
        F.when((F.col("role") == "assistant") & (F.size("json.tool_calls") > 0), "call")
        .when((F.col("role") == "tool") & F.col("json.tool_call_id").isNotNull(), "result")
        .otherwise("message")
    )
    parsed = parsed.withColumn("kind", F.coalesce(kind, F.lit("message")))
    plain = parsed.where("kind = 'message'").select(
        "conv", "turn", "kind", F.col("turn").alias("after"), F.lit(0).alias("level"), F.lit(None).cast("string").alias("fault"),
        F.to_json(F.struct(F.col("text").alias("content"), "role")).alias("line"),
    )
    tools = Stage(parsed.where("kind <> 'message'").select("conv", "turn", "kind", "role", "json.*"), "tools")
    calls = tools.df.where("kind = 'call'").select("conv", "turn", F.explode("tool_calls").alias("call")).select("conv", "turn", F.col("call.id").alias("call_id"), "call.arguments")
    first = calls.where("call_id is not null").groupBy("conv", "call_id").agg(F.min("turn").alias("called"))
    results = tools.df.where("kind = 'result'").select("conv", "turn", F.col("tool_call_id").alias("call_id"))
    answered = results.groupBy("conv", "call_id").agg(F.min("turn").alias("answered"))
    uses = calls.select("conv", "turn", F.explode(F.regexp_extract_all("arguments", F.lit(r'"\$result"\s*:\s*"([^"]+)"'), 1)).alias("call_id"))
    links = (
        results.join(first, ["conv", "call_id"]).select("conv", "turn", F.col("called").alias("needs"))
        .union(uses.join(answered, ["conv", "call_id"]).select("conv", "turn", F.col("answered").alias("needs")))
        .where("turn is not null and needs is not null and turn <> needs")
    )
    order, _ = _order(links)
    open_calls = calls.join(answered, ["conv", "call_id"], "left_anti").select("conv", "turn", F.lit("a call has no result").alias("unlinked"))
    twice = calls.join(first, ["conv", "call_id"]).where("turn <> called").select("conv", "turn", F.lit("a call repeats an id").alias("unlinked"))
    orphans = results.join(first, ["conv", "call_id"], "left_anti").select("conv", "turn", F.lit("the result has no call").alias("unlinked"))
    lost = uses.join(answered, ["conv", "call_id"], "left_anti").select("conv", "turn", F.lit("a used result is missing").alias("unlinked"))
    unlinked = open_calls.union(twice).union(orphans).union(lost).groupBy("conv", "turn").agg(F.min("unlinked").alias("unlinked"))
    lines = tools.df.select("conv", "turn", "kind", "role", "content", "tool_call_id", "tool_calls").mapInArrow(
        _serialise(schemas or {}), f"conv bigint, turn bigint, kind string, role string, {_MESSAGE}, line string, fault string"
    )
    node = order.withColumn("linked", F.lit(True))
    linked = (
        lines.join(node, ["conv", "turn"], "left")
        .join(unlinked, ["conv", "turn"], "left")
        .select(
            "conv", "turn", "kind", F.coalesce("after", "turn").alias("after"),
            F.when(F.col("linked") & F.col("level").isNull(), -1).otherwise(F.coalesce("level", F.lit(0))).alias("level"),
            F.coalesce("fault", "unlinked", F.when(F.col("linked") & F.col("level").isNull(), "part of a cycle")).alias("fault"), "line",
        )
    )
    every = plain.unionByName(linked)
    return every.select("conv", "turn", "kind", "after", "level", F.col("fault").isNull().alias("valid"), "fault", "line")
