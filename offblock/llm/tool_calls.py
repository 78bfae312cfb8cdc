"""Operator 4, chat formatting: tool-call linking.

Calls and results are hash-joined by identifier; calls are ordered
topologically behind the call they wait for; arguments are validated against
their tool's schema; each call is written as canonical JSON.

A call's depth is the number of calls before it on its chain. It is found by
pointer jumping: each round a call's pointer skips as far ahead as the pointer of
the call it points to, so a chain of n calls takes log2(n) rounds. Calls on, or
behind, a cycle never reach a first call and have no depth.
"""

from __future__ import annotations

import json
import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offblock.llm.common import written

TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def canonical(value) -> str:
    """JSON with sorted keys, no blanks and unescaped non-ASCII."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _unique(pairs):
    out = dict(pairs)
    if len(out) != len(pairs):
        raise ValueError("repeated key")
    return out


def _no_constant(name):
    raise ValueError(name)


def parse(text: str | None):
    """A JSON value; ValueError for anything that is not strict JSON in UTF-8.

    That is also so for repeated keys, numbers beyond doubles, lone surrogates and
    values nested too deeply to be written again.
    """
    if text is None:
        raise ValueError("no arguments")
    try:
        value = json.loads(text, object_pairs_hook=_unique, parse_constant=_no_constant)
        canonical([[value]]).encode("utf-8")  # as deep as it lies in a record
    except RecursionError:
        raise ValueError("nested too deeply") from None
    except UnicodeEncodeError:
        raise ValueError("lone surrogate") from None
    return value


def _is(value, kind: str) -> bool:
    return kind in TYPES and isinstance(value, TYPES[kind]) and not (isinstance(value, bool) and kind in ("integer", "number"))


def _equal(x, y) -> bool:
    """JSON equality: numbers by value, and true is not 1."""
    if _is(x, "number") and _is(y, "number"):
        return x == y
    return canonical(x) == canonical(y)


def faults(value, schema: dict, at: str = "$") -> list[str]:
    """Breaches of a JSON schema: type (an unknown one fits nothing), enum, bounds, lengths, required, properties, items."""
    out, todo = [], [(value, schema, at)]
    while todo:
        at_hand = todo.pop()
        if isinstance(at_hand, str):
            out.append(at_hand)
            continue
        value, schema, at = at_hand
        kinds = schema.get("type") or []
        kinds = kinds if isinstance(kinds, list) else [kinds]
        if kinds and not any(_is(value, k) for k in kinds):
            out.append(f"{at}: not {'/'.join(kinds)}")
            continue
        if "enum" in schema and not any(_equal(value, x) for x in schema["enum"]):
            out.append(f"{at}: not in enum")
        if _is(value, "number") and not schema.get("minimum", -math.inf) <= value <= schema.get("maximum", math.inf):
            out.append(f"{at}: out of bounds")
        if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", math.inf):
            out.append(f"{at}: length")
        parts = []
        if isinstance(value, list) and "items" in schema:
            parts = [(x, schema["items"], f"{at}[{i}]") for i, x in enumerate(value)]
        if isinstance(value, dict):
            known = schema.get("properties", {})
            out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
            for k in sorted(value):
                if k in known:
                    parts.append((value[k], known[k], f"{at}.{k}"))
                elif schema.get("additionalProperties", True) is False:
                    parts.append(f"{at}.{k}: unknown")
        todo += reversed(parts)
    return out


def depths(calls: DataFrame) -> DataFrame:
    """(key, depth) of distinct calls (key, after): null on or behind a cycle; a missing predecessor counts as none.

    key is unique. Each round is written, so its lineage stays short.
    """
    known = calls.select(F.col("key").alias("after"))
    has = calls.join(known.withColumn("has", F.lit(True)), "after", "left")
    state = written(has.select("key", F.when(F.col("has"), F.col("after")).alias("to"), F.when(F.col("has"), 1).otherwise(0).cast("long").alias("depth")), "chains")
    rounds = 0
    total = state.count()
    while 2**rounds <= total and not state.where("to is not null").isEmpty():
        ahead = state.select(F.col("key").alias("to"), F.col("to").alias("far"), F.col("depth").alias("more"))
        state = state.join(ahead, "to", "left").select("key", F.col("far").alias("to"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        state = written(state, "chains")
        rounds += 1
    return state.select("key", F.when(F.col("to").isNull(), F.col("depth")).alias("depth"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], messages: DataFrame | None = None) -> DataFrame:
    """One row for each call, each result without a call and each message.

    calls: conv_id, turn, call_id, name, arguments (JSON), after (call_id or null);
    results: conv_id, turn, call_id, content; messages, which are neither: conv_id,
    turn, role, content. Identifiers hold within a conversation; a null identifier, or
    one of no conversation, links with nothing. Of calls that repeat an
    identifier the first (by turn, then arguments) is linked, the others are
    `repeated`; results likewise (by turn, then content). Returned: conv_id, turn,
    call_id, status (linked, unanswered, repeated, orphan, message), depth, valid,
    errors, json. A message has no call_id and depth, and is not valid; its json holds
    its role, status and content.
    """
    key = F.xxhash64("conv_id", "call_id")
    first = Window.partitionBy("conv_id", "call_id").orderBy("turn", "body")

    def ranked(df, body):
        return df.withColumn("body", F.col(body)).withColumn("rank", F.when(F.col("call_id").isNull() | F.col("conv_id").isNull(), F.lit(0)).otherwise(F.row_number().over(first))).drop("body")

    c, r = ranked(calls, "arguments"), ranked(results, "content")
    c = c.withColumn("key", F.when(F.col("rank") == 1, key)).withColumn("wait", F.when(F.col("after").isNotNull(), F.xxhash64("conv_id", F.col("after"))))
    d = depths(c.where("key is not null").select("key", F.col("wait").alias("after")))
    answers = r.where("rank = 1").select(key.alias("key"), F.col("turn").alias("r_turn"), "content")
    linked = c.join(d, "key", "left").join(answers, "key", "left")
    status = F.when(F.col("rank") > 1, "repeated").when(F.col("r_turn").isNotNull() | F.col("content").isNotNull(), "linked").otherwise("unanswered")
    linked = linked.select("conv_id", "turn", "call_id", status.alias("status"), "depth", "name", "arguments", "after", "content")
    orphan = r.join(c.where("key is not null").select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")
    orphan = orphan.unionByName(r.where("rank > 1").join(orphan.select("conv_id", "call_id").distinct(), ["conv_id", "call_id"], "left_anti"))
    none = F.lit(None).cast("string")
    orphan = orphan.select("conv_id", "turn", "call_id", F.when(F.col("rank") > 1, "repeated").otherwise("orphan").alias("status"),
                           F.lit(None).cast("long").alias("depth"), none.alias("name"), none.alias("arguments"), none.alias("after"), "content")
    every = linked.unionByName(orphan).withColumn("role", none)
    if messages is not None:
        every = every.unionByName(messages.select("conv_id", "turn", "role", "content", F.lit("message").alias("status")), allowMissingColumns=True)

    def write(batches):
        for batch in batches:
            rows, out = batch.to_pylist(), []
            for x in rows:
                errors, value = [], None
                if x["name"] is not None or x["arguments"] is not None:
                    try:
                        value = parse(x["arguments"])
                        errors = faults(value, schemas[x["name"]]) if x["name"] in schemas else ["no such tool"]
                    except ValueError as e:
                        errors = [f"not JSON: {e}"]
                record = {"call_id": x["call_id"], "name": x["name"], "arguments": value if not errors else x["arguments"], "after": x["after"],
                          "depth": x["depth"], "status": x["status"], "result": x["content"]}
                if x["status"] == "message":
                    record = {"role": x["role"], "status": x["status"], "content": x["content"]}
                out.append((not errors and x["status"] == "linked", "; ".join(errors), canonical(record)))
            valid, errors, text = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("conv_id", "turn", "call_id", "status", "depth")), pa.array(valid, pa.bool_()),
                                              pa.array(errors, pa.string()), pa.array(text, pa.string())],
                                             names=["conv_id", "turn", "call_id", "status", "depth", "valid", "errors", "json"])

    return every.mapInArrow(write, "conv_id long, turn long, call_id string, status string, depth long, valid boolean, errors string, json string")


#: The tool that conversations are read as calls of, with its schema.
REPLY = {"reply": {"type": "object", "required": ["prompt", "turn"], "additionalProperties": False,
                   "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}}}


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Conversations as calls and results of the tool `reply`, and messages: the table holds no tool calls of its own.

    A user's turn t is a call `t` with the text as its prompt, which waits for call
    `t - 2`; the assistant's turn t is the result of call `t - 1`. Null texts are null
    prompts, which the schema refuses. Rows of any other role (system), or of none, are
    messages, so every row is a call, a result or a message.
    """
    d = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.col("text").cast("string").alias("text"))
    arguments = F.to_json(F.struct(F.col("text").alias("prompt"), "turn"), {"ignoreNullFields": "false"})
    calls = d.where("role = 'user'").select("conv_id", "turn", F.col("turn").cast("string").alias("call_id"), F.lit("reply").alias("name"),
                                            arguments.alias("arguments"), (F.col("turn") - 2).cast("string").alias("after"))
    results = d.where("role = 'assistant'").select("conv_id", "turn", (F.col("turn") - 1).cast("string").alias("call_id"), F.col("text").alias("content"))
    messages = d.where("role is null or role not in ('user', 'assistant')").select("conv_id", "turn", "role", F.col("text").alias("content"))
    return calls, results, messages


def op4_tool_calls(conversations: DataFrame) -> DataFrame:
    """Every row of conversations, a linked result in the row of its call."""
    calls, results, messages = calls_of(conversations)
    return link_calls(calls, results, REPLY, messages)
