"""Chat formatting with linked tool calls.

A message of an assistant may be a JSON object with "content" and "tool_calls" (each
with "id", "name", "arguments"), one of a tool an object with "tool_call_id" and
"content"; any other text is content. Calls and results are hash-joined by
conversation and identifier. An argument refers to the result of another call as
{"$ref": id}; calls follow the calls they refer to, results follow their calls.
Arguments are checked against the tools' schemas and messages become canonical JSON:
sorted keys, no spaces, no escapes but those JSON needs.
"""

from __future__ import annotations

import json
import re
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import cut

CALL = "struct<id: string, name: string, valid: boolean, refs: array<string>>"
DECLARED = "tools array<struct<name: string, parameters: string, function: struct<name: string, parameters: string>>>"
TYPES = {"string": str, "boolean": bool, "array": list, "object": dict}
#: Calls of a conversation that one task orders; larger conversations are ordered by rounds of joins.
LOCAL_CALLS = 10_000
#: What a text can raise that is no message of ours: it is plain content then.
ESCAPE = re.compile(r"\\(?:u([0-9a-f]{4})|.)")
ODD = (ValueError, RecursionError, OverflowError, TypeError)


def canonical(value: object) -> str:
    """Canonical JSON: sorted keys, no spaces, control characters without a short form as \\u00XX with capital digits, as to_json writes them.

    Infinite numbers and lone surrogates have none: a ValueError.
    """
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    text = ESCAPE.sub(lambda m: m[0] if m[1] is None else "\\u" + m[1].upper(), text)
    text.encode("utf-8")
    return text


def matches(value: object, schema: dict) -> bool:
    """JSON-schema check of type, enum, required, properties, additionalProperties, items, minimum and maximum."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return False
    if "enum" in schema and value not in schema["enum"]:
        return False
    if isinstance(value, (int, float)) and not isinstance(value, bool) and not schema.get("minimum", -math.inf) <= value <= schema.get("maximum", math.inf):
        return False
    if isinstance(value, list):
        return all(matches(x, schema.get("items", {})) for x in value)
    if isinstance(value, dict):
        known, rest = schema.get("properties", {}), schema.get("additionalProperties", True)
        inner = all(matches(x, known[k]) if k in known else matches(x, rest) if isinstance(rest, dict) else rest for k, x in value.items())
        return inner and all(k in value for k in schema.get("required", []))
    return True


def _fits(arguments: dict, schema: object) -> bool:
    """matches(), false for a schema that is none."""
    try:
        return isinstance(schema, dict) and matches(arguments, schema)
    except (*ODD, AttributeError):
        return False


@lru_cache(maxsize=4096)
def _schema(text: str) -> object:
    """A declared schema; none that can be read is one that nothing fits."""
    try:
        return json.loads(text)
    except ODD:
        return None


def _is(value: object, kind: str) -> bool:
    if isinstance(value, dict) and set(value) == {"$ref"}:
        return True  # stands for a result that isn't known here
    if kind == "null":
        return value is None
    if kind in ("integer", "number"):
        return isinstance(value, (int, float)) and not isinstance(value, bool) and (kind == "number" or isinstance(value, int) or value.is_integer())
    return isinstance(value, TYPES.get(kind, object)) and (kind == "boolean" or not isinstance(value, bool))


def _name(identifier: object) -> str | None:
    """An identifier as text; null stays."""
    return identifier if identifier is None or isinstance(identifier, str) else canonical(identifier)


def references(value: object) -> list[str]:
    if isinstance(value, dict):
        if set(value) == {"$ref"}:
            return [_name(value["$ref"]) or "null"]
        return [r for x in value.values() for r in references(x)]
    return [r for x in value for r in references(x)] if isinstance(value, list) else []


def read_message(role: str, text: str, schemas: dict[str, dict]) -> dict:
    """The canonical message, its calls and the call it answers.

    Text that is no such object, or can't be written as canonical JSON (lone surrogates, numbers that
    are no finite ones, nesting too deep to read), is plain content.
    """
    try:
        found = _linked(role, json.loads(text, parse_constant=_no_constant), schemas)
    except ODD:
        found = None
    return found or {"message": canonical({"content": text, "role": role}), "calls": [], "answers": None}


def _no_constant(name: str) -> None:
    raise ValueError(name)


def _linked(role: str, body: object, schemas: dict[str, dict]) -> dict | None:
    """The message with tool calls or with a result that a text's JSON is, if it is one."""
    if not isinstance(body, dict) or not body.keys() & ({"tool_calls"} if role == "assistant" else {"tool_call_id"}):
        return None
    if role == "tool":
        answers = body["tool_call_id"]
        content = body.get("content")
        content = content if isinstance(content, str) or content is None else canonical(content)
        return {"message": canonical({"content": content, "role": role, "tool_call_id": answers}), "calls": [], "answers": _name(answers)}
    if not isinstance(body["tool_calls"], list) or not all(isinstance(c, dict) for c in body["tool_calls"]):
        return None
    calls, shown = [], []
    for c in body["tool_calls"]:
        arguments = c.get("arguments", {})
        if isinstance(arguments, str):
            try:
                arguments = json.loads(arguments, parse_constant=_no_constant)
                canonical(arguments)
            except ODD:
                arguments = c["arguments"]
        name, ident = c.get("name"), c.get("id")
        valid = isinstance(name, str) and name in schemas and isinstance(arguments, dict) and _fits(arguments, schemas[name])
        calls.append({"id": _name(ident), "name": name if isinstance(name, str) else None, "valid": valid, "refs": sorted(set(references(arguments)))})
        shown.append({"arguments": arguments, "id": ident, "name": name})
    return {"message": canonical({"content": body.get("content"), "role": role, "tool_calls": shown}), "calls": calls, "answers": None}


def _local_order(ids: list[str], turns: list[int], refs: list[tuple[str, str]]) -> list[tuple[str, int, int, bool]]:
    """(call, seq, depth, cyclic) of one conversation by taking calls off whose references all have their place."""
    at = dict(zip(ids, turns, strict=True))
    place, waits, after = {c: (t, 0) for c, t in at.items()}, Counter(), defaultdict(list)
    for call, ref in refs:
        waits[call] += 1
        after[ref].append(call)
    ready = [c for c in ids if not waits[c]]
    for c in ready:
        for d in after[c]:
            place[d] = max(place[d], (place[c][0], place[c][1] + 1))
            waits[d] -= 1
            if not waits[d]:
                ready.append(d)
    done = set(ready)
    return [(c, *(place[c] if c in done else (at[c], 0)), c not in done) for c in ids]


def _order_by_rounds(known: DataFrame, edges: DataFrame) -> DataFrame:
    """The same by joins: each round places the calls whose references all have theirs; it ends when a round places none."""
    placed = cut(known.join(edges, ["conv_id", "call_id"], "left_anti").withColumn("depth", F.lit(0)), "chat-order")
    all_placed, waiting = placed, edges
    while True:
        of_ref = all_placed.select("conv_id", F.col("call_id").alias("ref"), F.struct("seq", "depth").alias("at"))
        seen = waiting.join(of_ref, ["conv_id", "ref"], "left").groupBy("conv_id", "call_id").agg(F.max("at").alias("at"), F.bool_and(F.col("at").isNotNull()).alias("ready"))
        least = F.struct(F.col("at.seq").alias("seq"), (F.col("at.depth") + 1).alias("depth"))
        best = F.greatest(F.struct("seq", F.lit(0).alias("depth")), least)
        placed = cut(known.join(seen.filter("ready"), ["conv_id", "call_id"]).select("conv_id", "call_id", best.alias("b")).select("conv_id", "call_id", "b.seq", "b.depth"), "chat-order")
        if placed.isEmpty():
            rest = known.join(all_placed.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")
            return all_placed.withColumn("cyclic", F.lit(False)).unionByName(rest.withColumn("depth", F.lit(0)).withColumn("cyclic", F.lit(True)))
        waiting = cut(waiting.join(placed, ["conv_id", "call_id"], "left_anti"), "chat-waiting")
        all_placed = cut(all_placed.unionByName(placed), "chat-order")


def _order(calls: DataFrame, local_calls: int = LOCAL_CALLS) -> DataFrame:
    """conv_id, call_id, seq, depth, cyclic: the turn and the step within it at which a call can be made.

    Chains of references may have any length. Calls on a cycle of references, or behind one, can't be
    ordered: they keep their own turn and depth 0 and are marked. Conversations of up to local_calls calls and as many
    references are ordered in one task each, the others by rounds of joins, one for each link of the longest chain.
    """
    known = cut(calls.groupBy("conv_id", "call_id").agg(F.min("turn").alias("seq")), "chat-known")
    edges = calls.select("conv_id", "call_id", F.explode("refs").alias("ref")).distinct()
    edges = cut(edges.join(known.select("conv_id", F.col("call_id").alias("ref")), ["conv_id", "ref"], "left_semi"), "chat-edges")
    loose = known.withColumn("depth", F.lit(0)).withColumn("cyclic", F.lit(False))
    if edges.isEmpty():
        return loose
    counts = edges.groupBy("conv_id").agg(F.count("*").alias("n_refs")).join(known.groupBy("conv_id").agg(F.count("*").alias("n_calls")), "conv_id")
    counts = cut(counts.select("conv_id", (F.greatest("n_refs", "n_calls") <= local_calls).alias("local")), "chat-sizes")
    small, large = counts.filter("local").select("conv_id"), counts.filter("NOT local").select("conv_id")
    schema = f"conv_id {calls.schema['conv_id'].dataType.simpleString()}, call_id string, seq {known.schema['seq'].dataType.simpleString()}, depth int, cyclic boolean"

    def order(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        made = group[group["ref"].isna()].sort_values("call_id")
        refs = group[group["ref"].notna()]
        rows = _local_order(made["call_id"].tolist(), [int(t) for t in made["seq"]], list(zip(refs["call_id"], refs["ref"], strict=True)))
        return pd.DataFrame([(key[0], *r) for r in rows], columns=["conv_id", "call_id", "seq", "depth", "cyclic"])

    both = known.withColumn("ref", F.lit(None).cast("string")).unionByName(edges.withColumn("seq", F.lit(None).cast(known.schema["seq"].dataType)))
    ordered = cut(both.join(small, "conv_id", "left_semi").groupBy("conv_id").applyInPandas(order, schema), "chat-local")
    ordered = ordered.unionByName(loose.join(counts, "conv_id", "left_anti"))
    if not large.isEmpty():
        ordered = ordered.unionByName(_order_by_rounds(known.join(large, "conv_id", "left_semi"), edges.join(large, "conv_id", "left_semi")))
    return cut(ordered, "chat-order")


def declared_tools(messages: DataFrame) -> DataFrame:
    """conv_id, tools: names and JSON schemas of the tools that a conversation declares.

    A system or developer message that is a JSON object declares them in "tools", each with "name" and "parameters", or with these in
    "function". Of several declarations of a name the earliest counts; one without parameters takes any.
    """
    found = messages.filter(F.col("role").isin("system", "developer") & F.col("conv_id").isNotNull() & F.col("text").contains('"tools"') & F.col("text").rlike(r"^\s*\{"))
    found = found.select("conv_id", "turn", F.explode(F.from_json("text", DECLARED)["tools"]).alias("t"))
    tools = found.select("conv_id", "turn", F.coalesce("t.name", "t.function.name").alias("name"), F.coalesce("t.parameters", "t.function.parameters", F.lit("{}")).alias("schema")).filter("name IS NOT NULL")
    each = tools.groupBy("conv_id", "name").agg(F.min_by("schema", F.struct("turn", "schema")).alias("schema"))
    return each.groupBy("conv_id").agg(F.collect_list(F.struct("name", "schema")).alias("tools"))


def format_chat(messages: DataFrame, schemas: dict[str, dict] | None = None, local_calls: int = LOCAL_CALLS) -> DataFrame:
    """One row per row of ``messages`` (conv_id, turn, role, text): the canonical message and its place.

    A conversation in order is its rows by (seq, depth, result, turn). n_calls, n_valid,
    n_answered, n_cyclic: tool calls of the message, those whose arguments fit the schema of a known
    tool, those with a result, and those on or behind a cycle of references. linked: false for a result whose call doesn't exist.
    schemas: JSON schema of each tool's arguments by name, bounded by the caller, beside those that a conversation declares itself.
    A message stands where its first call can be made, so before all its results.
    Null conversations, turns and roles stay and link with nothing; null text is null
    content; repeated rows stay, a repeated call identifier counts as one call from its first
    turn; an empty table gives an empty result. Conversations are never gathered whole.
    """
    schemas = schemas or {}
    rows = messages.select("conv_id", "turn", "role", "text")
    special = F.coalesce(F.col("role").isin("assistant", "tool") & F.col("text").rlike(r"^\s*\{"), F.lit(False))
    content = rows.filter(~special).select("conv_id", "turn", "role", F.to_json(F.struct(F.col("text").alias("content"), "role"), {"ignoreNullFields": "false"}).alias("message"), F.lit(None).cast(f"array<{CALL}>").alias("calls"), F.lit(None).cast("string").alias("answers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("id", pa.string()), ("name", pa.string()), ("valid", pa.bool_()), ("refs", pa.list_(pa.string()))]))
        for batch in batches:
            declared = [schemas | {d["name"]: _schema(d["schema"]) for d in tools or ()} for tools in batch.column(4).to_pylist()]
            found = [read_message(r, t, d) for r, t, d in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), declared, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([f["message"] for f in found], pa.string()), pa.array([f["calls"] for f in found], kind), pa.array([f["answers"] for f in found], pa.string())], names=["conv_id", "turn", "role", "message", "calls", "answers"])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:3])
    linked = rows.filter(special).join(declared_tools(rows), "conv_id", "left").select("conv_id", "turn", "role", "text", "tools")
    parsed = cut(linked.mapInArrow(run, f"{head}, message string, calls array<{CALL}>, answers string"), "chat-parsed")
    calls = parsed.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", F.inline("calls")).filter("id IS NOT NULL").withColumnRenamed("id", "call_id")
    order = _order(calls, local_calls)
    answered = parsed.filter("answers IS NOT NULL").select("conv_id", F.col("answers").alias("call_id")).distinct()
    status = calls.join(order, ["conv_id", "call_id"]).join(answered.withColumn("answered", F.lit(True)), ["conv_id", "call_id"], "left")
    status = status.groupBy("conv_id", "turn").agg(F.min(F.struct("seq", "depth")).alias("at"), F.count_if("valid").alias("n_valid"), F.count_if(F.coalesce("answered", F.lit(False))).alias("n_answered"), F.count_if("cyclic").alias("n_cyclic"))
    made = parsed.filter("answers IS NULL").join(status, ["conv_id", "turn"], "left").withColumn("linked", F.lit(True))
    results = parsed.filter("answers IS NOT NULL").join(order.withColumnRenamed("call_id", "answers"), ["conv_id", "answers"], "left")
    after_call = F.when(F.col("seq").isNotNull(), F.struct("seq", "depth"))
    results = results.select("conv_id", "turn", "role", "message", "calls", "answers", after_call.alias("at"), F.lit(0).cast("long").alias("n_valid"), F.lit(0).cast("long").alias("n_answered"), F.lit(0).cast("long").alias("n_cyclic"), F.col("seq").isNotNull().alias("linked"))
    every = content.withColumn("linked", F.lit(True)).unionByName(made, allowMissingColumns=True).unionByName(results, allowMissingColumns=True)
    zero = F.lit(0).cast("long")
    return every.select(
        "conv_id",
        "turn",
        "role",
        F.coalesce("at.seq", "turn").alias("seq"),
        F.coalesce("at.depth", F.lit(0)).alias("depth"),
        F.col("answers").isNotNull().cast("int").alias("result"),
        "message",
        F.when(F.col("calls").isNull(), zero).otherwise(F.size("calls").cast("long")).alias("n_calls"),
        F.coalesce("n_valid", zero).alias("n_valid"),
        F.coalesce("n_answered", zero).alias("n_answered"),
        F.coalesce("n_cyclic", zero).alias("n_cyclic"),
        "linked",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: canonical message and place of every turn."""
    return format_chat(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: Holds while no text of an assistant or a tool is a JSON object, as in the given tables.
ORACLE = """
SELECT conv_id, turn, role, turn AS seq, 0 AS depth, 0 AS result,
       '{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || '}' AS message,
       CAST(0 AS BIGINT) AS n_calls, CAST(0 AS BIGINT) AS n_valid, CAST(0 AS BIGINT) AS n_answered, CAST(0 AS BIGINT) AS n_cyclic, true AS linked
FROM conversations
"""
