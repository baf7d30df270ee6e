"""Chat formatting with tool calls: link, order, validate, serialise.

Calls and results are hash-joined by conversation and identifier.  A conversation's calls are put in
topological order of their dependencies (ties by position, then identifier), each one's arguments are checked
against its tool's JSON schema, and the whole becomes one line of canonical JSON (sorted keys,
no spaces, no escapes beyond those JSON requires).

``turns_as_calls`` makes calls of plain chats, where no tool is called: a user turn calls ``reply`` with
its text and turn and depends on the user turn before; an assistant turn is a result of the last
user turn before it; system turns are context.

Defined cases: rows without conversation, identifier or position are left out; repeated calls of an identifier
keep the first by position; results keep their order, equal ones at one position count once; a result
without its call is an orphan; dependencies on calls that don't exist don't hold a call back; calls in a cycle come last, by
position; arguments that aren't an object or don't conform and an unknown tool make a call invalid. Arguments that
are no JSON (NaN and infinite numbers, also those beyond a double, and numbers of over 4,300 digits are none) or are nested too deeply to read stay as raw
text or null, and the call is invalid.  Of a key given twice in an object the last counts.  Lone surrogates are written as
escapes.  Texts of any length are kept whole; a conversation is one row, so all of it meets in one task.  Other columns of the tables are
not looked at.  An empty table gives no rows.  A schema keyword that isn't implemented or a broken schema is an error before the job starts.
"""

from __future__ import annotations

import heapq
import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REPLY = {
    "reply": {
        "type": "object",
        "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
        "required": ["text", "turn"],
        "additionalProperties": False,
    }
}
_TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
}


#: Keywords that say nothing of whether a value conforms.
ANNOTATIONS = {"title", "description", "default", "examples", "format", "$schema", "$id", "$comment", "$defs", "definitions", "deprecated", "readOnly", "writeOnly"}
_ONE = {"not", "if", "then", "else", "additionalProperties", "propertyNames", "contains", "items"}  # of a schema
_MANY = {"anyOf", "oneOf", "allOf", "prefixItems"}
_NAMED = {"properties", "patternProperties", "dependentSchemas", "$defs", "definitions"}
_PLAIN = {
    "type", "enum", "const", "required", "minItems", "maxItems", "uniqueItems", "minLength", "maxLength", "pattern", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum",
    "multipleOf", "minProperties", "maxProperties", "dependentRequired", "minContains", "maxContains", "$ref",
}


def check_schema(schema: object, root: object = None) -> None:
    """Raises ValueError for what ``conforms`` doesn't implement."""
    root = schema if root is None else root
    if isinstance(schema, bool):
        return
    if not isinstance(schema, dict):
        raise ValueError(f"not a schema: {schema!r}")
    if unknown := schema.keys() - _ONE - _MANY - _NAMED - _PLAIN - ANNOTATIONS:
        raise ValueError(f"schema keywords that aren't implemented: {sorted(unknown)}")
    kinds = schema.get("type", [])
    if unknown := {kinds} - _TYPES.keys() if isinstance(kinds, str) else set(kinds) - _TYPES.keys():
        raise ValueError(f"unknown types: {sorted(unknown)}")
    for p in [*([schema["pattern"]] if "pattern" in schema else ()), *schema.get("patternProperties", ())]:
        re.compile(p)
    if "$ref" in schema:
        _at(schema["$ref"], root)
    for k in _ONE & schema.keys():
        check_schema(schema[k], root)
    for x in [*(x for k in _MANY & schema.keys() for x in schema[k]), *(x for k in _NAMED & schema.keys() for x in schema[k].values())]:
        check_schema(x, root)


def _at(ref: str, root: object) -> object:
    """What a reference within the schema (#, #/a/b) points to."""
    if not ref.startswith("#"):
        raise ValueError(f"only references within the schema: {ref}")
    for part in ref[1:].split("/")[1:]:
        part = part.replace("~1", "/").replace("~0", "~")
        try:
            root = root[int(part)] if isinstance(root, list) else root[part]
        except (KeyError, IndexError) as e:
            raise ValueError(f"reference to nothing: {ref}") from e
    return root


def same(a: object, b: object) -> bool:
    """Equality of JSON values: true isn't 1, and 1 is 1.0."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same(v, b[k]) for k, v in a.items())
    return type(a) is type(b) and a == b or isinstance(a, (int, float)) and isinstance(b, (int, float)) and a == b


def conforms(value: object, schema: object, root: object = None) -> bool:
    """Whether a value meets a JSON schema (the keywords of draft 2020-12 but for dynamic references and unevaluated*)."""
    if isinstance(schema, bool):
        return schema
    root = schema if root is None else root
    ok = lambda v, s: conforms(v, s, root)
    kinds = schema.get("type")
    if kinds is not None and not any(_TYPES[k](value) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return False
    if "enum" in schema and not any(same(value, x) for x in schema["enum"]) or "const" in schema and not same(value, schema["const"]):
        return False
    if "$ref" in schema and not ok(value, _at(schema["$ref"], root)) or not all(ok(value, s) for s in schema.get("allOf", ())):
        return False
    if "anyOf" in schema and not any(ok(value, s) for s in schema["anyOf"]) or "oneOf" in schema and sum(ok(value, s) for s in schema["oneOf"]) != 1:
        return False
    if "not" in schema and ok(value, schema["not"]) or "if" in schema and not ok(value, schema.get("then" if ok(value, schema["if"]) else "else", True)):
        return False
    if isinstance(value, dict):
        return _object_conforms(value, schema, ok)
    if isinstance(value, list):
        return _array_conforms(value, schema, ok)
    if isinstance(value, str):
        return schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)) and ("pattern" not in schema or re.search(schema["pattern"], value) is not None)
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        step = schema.get("multipleOf")
        if step is not None and (value % step if isinstance(value, int) and isinstance(step, int) else not math.isclose(value / step, round(value / step), rel_tol=1e-12)):
            return False
        return schema.get("minimum", value) <= value <= schema.get("maximum", value) and schema.get("exclusiveMinimum", -math.inf) < value < schema.get("exclusiveMaximum", math.inf)
    return True


def _object_conforms(value: dict, schema: dict, ok) -> bool:
    known, patterns = schema.get("properties", {}), schema.get("patternProperties", {})
    if any(k not in value for k in schema.get("required", ())) or not schema.get("minProperties", 0) <= len(value) <= schema.get("maxProperties", len(value)):
        return False
    if any(k in value and any(x not in value for x in need) for k, need in schema.get("dependentRequired", {}).items()) or any(k in value and not ok(value, s) for k, s in schema.get("dependentSchemas", {}).items()):
        return False
    for k, v in value.items():
        mine = [*([known[k]] if k in known else ()), *(s for p, s in patterns.items() if re.search(p, k))]
        if not all(ok(v, s) for s in mine or [schema.get("additionalProperties", True)]) or not ok(k, schema.get("propertyNames", True)):
            return False
    return True


def _array_conforms(value: list, schema: dict, ok) -> bool:
    if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
        return False
    if schema.get("uniqueItems") and len({canonical(_plain(v)) for v in value}) < len(value):
        return False
    if "contains" in schema and not schema.get("minContains", 1) <= sum(ok(v, schema["contains"]) for v in value) <= schema.get("maxContains", len(value)):
        return False
    first = schema.get("prefixItems", ())
    return all(map(ok, value, first)) and all(ok(v, schema.get("items", True)) for v in value[len(first) :])


def _plain(value: object) -> object:
    """Numbers that are equal get one spelling."""
    if isinstance(value, float) and value.is_integer():
        return int(value)
    return [_plain(v) for v in value] if isinstance(value, list) else {k: _plain(v) for k, v in value.items()} if isinstance(value, dict) else value


def _no_number(text: str) -> float:
    raise ValueError(f"no JSON number: {text}")


def _number(text: str) -> float:
    return x if math.isfinite(x := float(text)) else _no_number(text)


def parsed(text: str) -> object:
    return json.loads(text, parse_constant=_no_number, parse_float=_number)


def canonical(value: object) -> str:
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m.group()):04x}", text)  # halves of pairs can't be encoded


def ordered(calls: list[dict]) -> tuple[list[dict], int]:
    """The calls in topological order, and how many are in or behind a cycle (they come last)."""
    by_id = {c["id"]: c for c in calls}
    waits = {c["id"]: {d for d in c["depends_on"] or () if d in by_id} for c in calls}
    after: dict[str, list[str]] = {}
    for i, w in waits.items():
        for d in w:
            after.setdefault(d, []).append(i)
    left = {i: len(w) for i, w in waits.items()}
    ready = [(c["position"], c["id"]) for c in calls if not left[c["id"]]]
    heapq.heapify(ready)
    out = []
    while ready:
        _, i = heapq.heappop(ready)
        out.append(by_id[i])
        for j in after.get(i, ()):
            left[j] -= 1
            if not left[j]:
                heapq.heappush(ready, (by_id[j]["position"], j))
    rest = sorted((c for c in calls if left[c["id"]]), key=lambda c: (c["position"], c["id"]))
    return out + rest, len(rest)


def conversation(conv: int, calls: list[dict], orphans: list[dict], context: list[dict], schemas: dict[str, dict]) -> dict:
    calls, cyclic = ordered(calls)
    lines, invalid, linked = [], 0, 0
    for c in calls:
        try:
            value = parsed(c["arguments"])
            arguments = canonical(value)
            valid = isinstance(value, dict) and c["name"] in schemas and conforms(value, schemas[c["name"]])
        except (TypeError, ValueError, RecursionError):  # null, no JSON, too deep
            arguments, valid = canonical(c["arguments"]), False
        invalid += not valid
        results = [r["content"] for r in c["results"] or ()]
        linked += bool(results)
        lines.append(f'{{"arguments":{arguments},{canonical({"id": c["id"], "name": c["name"], "results": results, "valid": valid})[1:]}')
    rest = canonical({"context": [x["content"] for x in context], "conv_id": conv, "orphans": [x["content"] for x in orphans]})
    text = f'{{"calls":[{",".join(lines)}],{rest[1:]}'
    return {"n_calls": len(lines), "n_linked": linked, "n_unanswered": len(lines) - linked, "n_orphans": len(orphans), "n_invalid": invalid, "n_cyclic": cyclic, "json": text}


def chats(calls: DataFrame, results: DataFrame, context: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row for each conversation, from

    calls (conv_id, id, name, arguments, depends_on, position), results (conv_id, id, content,
    position) and context (conv_id, content, position)."""
    for schema in schemas.values():
        check_schema(schema)
    call = F.struct("position", "id", "name", "arguments", "depends_on")
    calls = calls.where("conv_id is not null and id is not null and position is not null").groupBy("conv_id", "id").agg(F.min(call).alias("call"))
    said = F.sort_array(F.collect_set(F.struct("position", "content")))
    results = results.where("conv_id is not null and position is not null").withColumn("id", F.coalesce("id", F.lit(""))).groupBy("conv_id", "id").agg(said.alias("results"))
    linked = calls.join(results, ["conv_id", "id"], "full").select("conv_id", "call", "results")
    context = context.where("conv_id is not null and position is not null").select("conv_id", F.struct("position", "content").alias("context"))
    rows = linked.unionByName(context, allowMissingColumns=True).groupBy("conv_id").agg(
        F.collect_list(F.when(F.col("call").isNotNull(), F.struct("call", "results"))).alias("calls"),
        F.flatten(F.collect_list(F.when(F.col("call").isNull(), F.col("results")))).alias("orphans"),
        F.collect_list("context").alias("context"),
    )
    columns = "n_calls long, n_linked long, n_unanswered long, n_orphans long, n_invalid long, n_cyclic long, json string"

    @F.arrow_udf(f"struct<{columns.replace(' ', ': ').replace(',: ', ', ')}>")
    def format_chat(conv: pa.Array, calls: pa.Array, orphans: pa.Array, context: pa.Array) -> pa.Array:
        out = []
        for v, c, o, x in zip(conv.to_pylist(), calls.to_pylist(), orphans.to_pylist(), context.to_pylist()):
            by_place = [sorted(y or (), key=lambda r: (r["position"], r["content"] or "")) for y in (o, x)]
            out.append(conversation(v, [{**k["call"], "results": k["results"]} for k in c], *by_place, schemas))
        kind = pa.struct([(n, pa.string() if n == "json" else pa.int64()) for n in ("n_calls", "n_linked", "n_unanswered", "n_orphans", "n_invalid", "n_cyclic", "json")])
        return pa.array(out, kind)

    return rows.select("conv_id", format_chat("conv_id", "calls", "orphans", "context").alias("x")).select("conv_id", "x.*")


def turns_as_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls, results, context) of plain turns (conv_id, turn, role, text); see above."""
    turns = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("position"), "role", F.col("text").alias("content")).where("conv_id is not null and position is not null")
    asked = F.when(F.col("role") == "user", F.col("position"))
    order = Window.partitionBy("conv_id").orderBy("position")
    turns = turns.withColumn("last", F.max(asked).over(order.rangeBetween(Window.unboundedPreceding, -1)))
    name = lambda c: F.concat(F.lit("call_"), F.col("conv_id"), F.lit("_"), F.col(c))
    arguments = F.to_json(F.struct(F.col("content").alias("text"), F.col("position").alias("turn")))
    depends = F.when(F.col("last").isNull(), F.array().cast("array<string>")).otherwise(F.array(name("last")))
    calls = turns.where("role = 'user'").select("conv_id", name("position").alias("id"), F.lit("reply").alias("name"), arguments.alias("arguments"), depends.alias("depends_on"), "position")
    results = turns.where("role = 'assistant'").select("conv_id", name("last").alias("id"), "content", "position")
    context = turns.where("role is null or role not in ('user', 'assistant')").select("conv_id", "content", "position")
    return calls, results, context
