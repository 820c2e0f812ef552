"""Tool-call linking for chat data.

Calls and results are joined by (conversation, identifier); calls are ordered so that a call follows
every call whose result its arguments use; arguments are validated against the tool's schema; and each
exchange is serialised as canonical JSON (sorted keys, no blanks, shortest numbers).

An argument uses another call's result by the object ``{"$result": "<call id>"}`` at any depth. The order
is found in layers: layer 0 holds the calls without such references, each further layer those whose
references are all in earlier ones; the rounds work on the unresolved references only, as joins over the
whole table, so a conversation with a third of all rows spreads over all tasks. Within a layer the order
is that of the calls' positions.

Defined results (column ``status``): ``linked``; ``no result``; ``orphan`` (a result without a call);
``repeated`` (a further call or result with an identifier already used, the first by position, then by
content, counts); ``cycle`` (references that never resolve; no place in the order). References to unknown calls are
an error of the arguments, not of the order. Null identifiers never link; null or invalid JSON arguments
are not valid, nor are numbers beyond a double's range and values nested more than MAX_NESTING deep; lone surrogates stay
escaped; unknown tools are not valid; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.llm.ranks import running_total
from dwspark.llm.tables import save

MAX_NESTING = 100
KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value: Any, kind: str) -> bool:
    if kind == "integer":
        return not isinstance(value, bool) and (isinstance(value, int) or (isinstance(value, float) and value.is_integer()))
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return isinstance(value, KINDS[kind])


def schema_errors(value: Any, schema: dict, at: str = "$") -> list[str]:
    """Violations of a JSON schema: type, enum, const, bounds, lengths, pattern, required, properties,
    additionalProperties, items. A reference to a result stands for any value."""
    if isinstance(value, dict) and set(value) == {"$result"}:
        return []
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at}: not of type {'/'.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not one of the allowed values")
    if "const" in schema and value != schema["const"]:
        out.append(f"{at}: not the required value")
    if _is(value, "number"):
        for key, wrong in (("minimum", lambda b: value < b), ("maximum", lambda b: value > b),
                           ("exclusiveMinimum", lambda b: value <= b), ("exclusiveMaximum", lambda b: value >= b)):
            if key in schema and wrong(schema[key]):
                out.append(f"{at}: beyond {key} {schema[key]}")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{at}: shorter than {schema['minLength']}")
        if len(value) > schema.get("maxLength", len(value)):
            out.append(f"{at}: longer than {schema['maxLength']}")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            out.append(f"{at}: does not match the pattern")
    if isinstance(value, list):
        if len(value) < schema.get("minItems", 0) or len(value) > schema.get("maxItems", len(value)):
            out.append(f"{at}: wrong number of items")
        for i, x in enumerate(value):
            out += schema_errors(x, schema.get("items", {}), f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for k in sorted(value):
            if k in known:
                out += schema_errors(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: not allowed")
    return out


def canonical(value: Any) -> str:
    """Canonical JSON: sorted keys, no blanks, text unescaped but for lone surrogates (no UTF-8 can hold them), and
    the shortest form of every number: whole floats below 1e16 as integers, others as Python writes them."""
    def plain(x: Any) -> Any:
        if isinstance(x, float) and x.is_integer() and abs(x) < 1e16:
            return int(x)
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        return [plain(v) for v in x] if isinstance(x, list) else x

    return storable(json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False))


def storable(text: str) -> str:
    """``text`` with lone surrogates as JSON escapes."""
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", text)


def nesting(value: Any) -> int:
    """How deep lists and objects stand in each other."""
    deepest, waiting = 0, [(value, 1)]
    while waiting:
        x, depth = waiting.pop()
        if isinstance(x, (dict, list)):
            deepest = max(deepest, depth)
            waiting += [(v, depth + 1) for v in (x.values() if isinstance(x, dict) else x)]
    return deepest


def references(value: Any) -> set[str]:
    found, waiting = set(), [value]
    while waiting:
        x = waiting.pop()
        if isinstance(x, dict):
            if set(x) == {"$result"} and isinstance(x["$result"], str):
                found.add(storable(x["$result"]))
            else:
                waiting += x.values()
        elif isinstance(x, list):
            waiting += x
    return found


def _number(text: str) -> float:
    value = float(text)
    if value in (float("inf"), float("-inf")):
        raise ValueError(text)  # JSON has no infinity
    return value


def _unlike_json(name: str):
    raise ValueError(name)


def _checked(schemas: dict[str, dict]):
    def check(name: str | None, text: str | None) -> tuple[str | None, list[str], list[str]]:
        try:
            value = json.loads(text or "", parse_constant=_unlike_json, parse_float=_number)
        except (ValueError, RecursionError):
            return None, ["$: not JSON"], []
        if nesting(value) > MAX_NESTING:
            return None, ["$: nested too deeply"], []
        wrong = schema_errors(value, schemas[name]) if name in schemas else ["$: unknown tool"]
        return canonical(value), [storable(x) for x in wrong], sorted(references(value))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [check(n, t) for n, t in zip(pdf["name"], pdf["arguments"])]
            yield pdf.assign(arguments=[x[0] for x in found], errors=[x[1] for x in found], needs=[x[2] for x in found])

    return run


def _serialised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for conv, call, name, arguments, content, status in zip(*(pdf[c] for c in ("conv_id", "call_id", "name", "arguments", "content", "status"))):
            value = {"arguments": json.loads(arguments) if arguments else None, "id": call, "name": name, "result": content, "status": status}
            out.append(canonical(value))
        yield pdf.assign(json=out).drop(columns=["content"])


def _layers(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """conv_id, call_id and layer of every call whose references resolve."""
    key = ["conv_id", "call_id"]
    edges = save(edges, "references")
    ready = save(calls.join(edges.select(*key).distinct(), key, "left_anti").select(*key, F.lit(0).alias("layer")), "layer")
    layers, number = ready, 0
    while not edges.isEmpty() and not ready.isEmpty():
        number += 1
        left = save(edges.join(ready.select("conv_id", F.col("call_id").alias("need")), ["conv_id", "need"], "left_anti"), "references")
        ready = save(edges.select(*key).distinct().join(left.select(*key).distinct(), key, "left_anti").select(*key, F.lit(number).alias("layer")), "layer")
        layers, edges = layers.unionByName(ready), left
    return layers


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row for each call and each result without a call: conv_id, call_id, name, position, status,
    ``valid``, ``errors``, canonical ``arguments``, ``layer``, ``place`` (from 0 in the conversation) and ``json``.

    ``calls``: conv_id, call_id, position, name, arguments; ``results``: conv_id, call_id, position, content."""
    key = ["conv_id", "call_id"]
    calls = calls.select(*key, "position", "name", "arguments")
    results = results.select(*key, "position", "content")
    calls = save(calls.mapInPandas(_checked(schemas), f"{_ddl(calls)}, errors array<string>, needs array<string>"), "calls")
    # The first use of an identifier counts, by aggregation: no task gathers a hot identifier.
    named = calls.where("call_id IS NOT NULL AND conv_id IS NOT NULL")
    rest = ["position", "name", "arguments", "errors", "needs"]
    first = save(named.groupBy(*key).agg(F.min(F.struct(*rest)).alias("x"), F.count(F.lit(1)).alias("n")).select(
        *key, *[F.col(f"x.{c}").alias(c) for c in rest], "n"), "first-calls")
    answers = results.where("call_id IS NOT NULL AND conv_id IS NOT NULL").groupBy(*key).agg(F.min(F.struct("position", "content")).alias("r"))
    linked = first.join(answers, key, "left")

    edges = first.select("conv_id", "call_id", F.explode("needs").alias("need"))
    known = first.select("conv_id", F.col("call_id").alias("need"))
    edges = save(edges.join(known, ["conv_id", "need"], "left_semi"), "edges")
    layers = _layers(first, edges)
    unknown = first.select("conv_id", "call_id", F.explode("needs").alias("need")).join(known, ["conv_id", "need"], "left_anti").groupBy(*key).agg(
        F.sort_array(F.collect_set(F.concat(F.lit("$: unknown call "), "need"))).alias("unknown"))  # by one call's arguments
    linked = linked.join(layers, key, "left").join(unknown, key, "left")
    linked = linked.select(
        *key, "name", "position", "arguments", F.concat("errors", F.coalesce("unknown", F.array().cast("array<string>"))).alias("errors"), "layer",
        F.col("r.content").alias("content"),
        F.when(F.col("layer").isNull(), "cycle").when(F.col("r").isNull(), "no result").otherwise("linked").alias("status"))

    none = lambda kind: F.lit(None).cast(kind)
    columns = [*key, "name", "position", "arguments", "errors", "layer", "content", "status"]
    # Further calls with a used identifier, and calls without one: each copy is a row of its own.
    further = calls.join(first.select(*key, F.struct(*rest).alias("x"), "n").where("n > 1"), key).withColumn("_same", F.struct(*rest) == F.col("x"))
    others = further.where("NOT _same").select(*key, *rest)
    copies = further.where("_same").groupBy(*key).agg(F.count(F.lit(1)).alias("m"), F.first("x").alias("x")).where("m > 1").select(
        *key, "x.*", F.explode(F.sequence(F.lit(2), F.col("m"))).alias("_")).drop("_")
    repeated = others.unionByName(copies).withColumns({"layer": none("int"), "content": none("string"), "status": F.lit("repeated")}).select(*columns)
    nameless = calls.where("call_id IS NULL OR conv_id IS NULL").withColumns(
        {"layer": none("int"), "content": none("string"), "status": F.lit("no result")}).select(*columns)
    void = {"name": none("string"), "arguments": none("string"), "errors": F.array().cast("array<string>"), "layer": none("int")}
    orphans = results.join(first.select(*key), key, "left_anti").withColumns(void | {"status": F.lit("orphan")}).select(*columns)
    later = results.join(linked.where("status <> 'no result'").select(*key), key, "left_semi").join(
        answers, key).where(F.struct("position", "content") != F.col("r")).withColumns(void | {"status": F.lit("repeated")}).select(*columns)

    rows = linked.unionByName(repeated).unionByName(nameless).unionByName(orphans).unionByName(later)
    rows = rows.withColumn("valid", (F.size("errors") == 0) & F.col("arguments").isNotNull())
    rows = save(rows.mapInPandas(_serialised, f"{_ddl(rows.drop('content'))}, json string"), "exchanges")
    placed = rows.where("layer IS NOT NULL").withColumns({"_conv": F.col("conv_id").cast("string"), "_one": F.lit(1).cast("long")})
    placed = running_total(placed.select(*key, "layer", "position", "_conv", "_one"), "_conv", ["layer", "position", "call_id"], "_one", "place")
    return rows.join(placed.select(*key, "layer", "place"), [*key, "layer"], "left").select(
        *key, "name", "position", "status", "valid", "errors", "arguments", "layer", "place", "json")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


# The tools that the conversations' turns are read as calls of.
TOOLS = {
    "count_words": {"type": "object", "required": ["text", "words"], "additionalProperties": False, "properties": {
        "text": {"type": "string", "minLength": 1}, "words": {"type": "integer", "minimum": 1, "maximum": 60}, "after": {"type": "string"}}},
    "find_lines": {"type": "object", "required": ["text", "lines"], "properties": {
        "text": {"type": "string"}, "lines": {"type": "integer", "maximum": 3}, "after": {"type": "string"}}},
    "summarise": {"type": "object", "required": ["text"], "properties": {
        "text": {"type": "string", "maxLength": 400}, "words": {"type": "integer"}, "lines": {"type": "integer"}, "after": {"type": "string"}}},
}


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that a table of turns holds: each assistant turn t calls a tool with its text,
    its word and line counts, and the result of an earlier call (that of half the rank); the user turn
    t + 1 is the result."""
    text = F.coalesce("text", F.lit(""))
    rank = F.floor(F.col("turn") / 2)
    names = F.array(*[F.lit(x) for x in TOOLS])
    earlier = F.when(rank > 0, F.struct(F.concat(F.lit("call_"), (F.floor((rank - 1) / 2) * 2 + 1).cast("long").cast("string")).alias("$result")))
    arguments = F.to_json(F.struct(
        earlier.alias("after"), text.alias("text"), F.size(F.split(F.trim(text), r"\s+")).alias("words"), F.size(F.split(text, "\n")).alias("lines")))
    calls = turns.where("role = 'assistant'").select(
        "conv_id", F.concat(F.lit("call_"), F.col("turn").cast("string")).alias("call_id"), F.col("turn").alias("position"),
        F.get(names, F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(len(TOOLS))).cast("int")).alias("name"), arguments.alias("arguments"))
    results = turns.where("role = 'user' AND turn > 0").select(
        "conv_id", F.concat(F.lit("call_"), (F.col("turn") - 1).cast("string")).alias("call_id"), F.col("turn").alias("position"), text.alias("content"))
    return calls, results


def query(conversations: DataFrame) -> DataFrame:
    calls, results = from_turns(conversations)
    return link(calls, results, TOOLS)
