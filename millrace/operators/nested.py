"""Deeply nested records to flat tables with parent-child links.

One depth-first pass over every record emits (tag, rec_id, pk, parent_key, payload) rows; `write_tables` writes them
partitioned by tag and `read_table` applies each tag's schema to the payload.

Keys: message m<i>, call m<i>.c<j>, tool t<k>, parameter t<k>.<name>, nested t<k>.<name>.<name>. Tags: messages, calls,
uses (parent: the first declared tool with the call's name, or null), answers, tools, params. The key of an answer is the
answering message, its parent the call; the key of a use is the call.

Defined cases: a null or empty array of messages emits nothing; a null message or call keeps its position and has null fields; a
null or blank id or name matches as any other value, but a null id has no answer and a null name no tool; an unreadable
tools string declares nothing; a declared entry that is neither an object nor a name is a tool without name or parameters.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EMITTED = "tag string, rec_id bigint, pk string, parent_key string, payload string"
PAYLOADS = {
    "messages": "role string, content string, reasoning string, name string, tool_call_id string",
    "calls": "id string, type string, name string, arguments string",
    "uses": "name string",
    "answers": "id string",
    "tools": "name string, description string",
    "params": "name string, type string, description string, required boolean",
}
#: The link name of each tag that has a parent.
LINKS = {"calls": "call", "uses": "use", "answers": "answer", "params": "param"}

def declared(text: str | None) -> list:
    """The entries of a tools string: a list, an object that holds one under `tools`, or either as encoded text."""
    value: object = text
    while isinstance(value, str):  # each decoding takes at least its quotes away
        try:
            value = json.loads(value.lstrip("﻿"))
        except (ValueError, RecursionError):
            return []
    if isinstance(value, dict):
        value = value["tools"] if "tools" in value else [value] if "name" in value or "function" in value else []
        if isinstance(value, str):
            return declared(value)
    return value if isinstance(value, list) else []


def tool_of(entry: object) -> tuple[str | None, str | None, object]:
    """Name, description and parameter schema of a declared entry."""
    if isinstance(entry, str):
        try:  # an entry may itself be encoded; else it is a bare name
            inner = json.loads(entry)
        except (ValueError, RecursionError):
            inner = None
        return tool_of(inner) if isinstance(inner, dict) else (entry, None, None)
    if not isinstance(entry, dict):
        return None, None, None
    inner = entry["function"] if isinstance(entry.get("function"), dict) else entry
    schema = next((inner[k] for k in ("parameters", "input_schema", "inputSchema") if isinstance(inner.get(k), dict)), None)
    name, said = inner.get("name"), inner.get("description")
    return name if isinstance(name, str) else None, said if isinstance(said, str) else None, schema


def parameters(key: str, schema: object) -> Iterator[tuple[str, str, dict, bool]]:
    """(key, parent, property schema, required) depth first, on an explicit stack so that depth has no limit."""
    stack = [(key, schema)]
    while stack:
        parent, node = stack.pop()
        within = [node]
        properties: list[tuple[str, object, bool]] = []
        while within:  # the properties of an array's items hang directly under the array
            x = within.pop()
            if isinstance(x, list):
                within.extend(reversed(x))
            elif isinstance(x, dict):
                needed = x.get("required")
                needed = set(y for y in needed if isinstance(y, str)) if isinstance(needed, list) else ()
                if isinstance(x.get("properties"), dict):
                    properties += [(name, p, name in needed) for name, p in x["properties"].items()]
                if isinstance(x.get("items"), (dict, list)):
                    within.append(x["items"])
        seen = set()
        for name, p, needed in properties:
            if name not in seen:
                seen.add(name)
                yield f"{parent}.{name}", parent, p if isinstance(p, dict) else {}, needed
                stack.append((f"{parent}.{name}", p))


def visit(rec: int, messages: list | None, tools: str | None, payload: bool) -> Iterator[tuple]:
    """Depth first: declared tools with their parameters, then messages with their calls; links follow what they join."""
    dump = (lambda **x: json.dumps(x, ensure_ascii=False)) if payload else (lambda **x: None)
    first: dict[str, str] = {}
    for k, entry in enumerate(declared(tools) if tools else ()):
        name, said, schema = tool_of(entry)
        yield "tools", rec, f"t{k}", None, dump(name=name, description=said)
        if name is not None:
            first.setdefault(name, f"t{k}")
        for pk, parent, p, needed in parameters(f"t{k}", schema) if schema else ():
            kind = p.get("type")
            text = p.get("description")
            yield "params", rec, pk, parent, payload and dump(name=pk[len(parent) + 1 :], type=kind if isinstance(kind, str) or kind is None else json.dumps(kind), description=text if isinstance(text, str) else None, required=needed) or None
    waiting: dict[str, str] = {}
    for i, m in enumerate(messages or ()):
        m = m or {}
        if payload:
            yield "messages", rec, f"m{i}", None, dump(**{k: m.get(k) for k in ("role", "content", "reasoning", "name", "tool_call_id")})
        if m.get("role") == "tool" and (at := m.get("tool_call_id")) is not None and at in waiting:
            yield "answers", rec, f"m{i}", waiting.pop(at), dump(id=at)
        for j, call in enumerate(m.get("tool_calls") or ()):
            call = call or {}
            pk, inner, at = f"m{i}.c{j}", call.get("function") or {}, call.get("id")
            name = inner.get("name")
            yield "calls", rec, pk, f"m{i}", payload and dump(id=at, type=call.get("type"), name=name, arguments=inner.get("arguments")) or None
            yield "uses", rec, pk, first.get(name) if name is not None else None, dump(name=name)
            if at is not None:
                waiting[at] = pk


SCHEMA = pa.schema([("tag", pa.string()), ("rec_id", pa.int64()), ("pk", pa.string()), ("parent_key", pa.string()), ("payload", pa.string())])


def emit(df: DataFrame, rec: str, messages: str, tools: str | None = None, payload: bool = True) -> DataFrame:
    """The tagged rows of every record of df; without payload only the fields that links need are read from the files.

    Narrow: no shuffle, one pass, bounded by one record's own size. Other columns of df, whatever their names, are not read.
    """
    m = F.col(messages)
    if not payload:
        call = lambda c: F.struct(c["id"].alias("id"), F.struct(c["function"]["name"].alias("name")).alias("function"))
        m = F.transform(m, lambda x: F.struct(x["role"].alias("role"), x["tool_call_id"].alias("tool_call_id"), F.transform(x["tool_calls"], call).alias("tool_calls")))
    picked = df.select(F.col(rec).cast("bigint").alias("rec"), m.alias("messages"), (F.col(tools) if tools else F.lit(None)).cast("string").alias("tools"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = [r for x in zip(*(c.to_pylist() for c in part.columns)) for r in visit(*x, payload)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA)], schema=SCHEMA)

    return picked.mapInArrow(run, EMITTED)


def links(emitted: DataFrame) -> DataFrame:
    """(rec_id, link, parent_key, child_key): the rows that have a parent."""
    name = F.create_map(*[F.lit(x) for pair in LINKS.items() for x in pair])
    return emitted.where(F.col("tag").isin(*LINKS) & F.col("parent_key").isNotNull()).select("rec_id", name[F.col("tag")].alias("link"), "parent_key", F.col("pk").alias("child_key"))


def flat_table(emitted: DataFrame, tag: str) -> DataFrame:
    """One tag's rows with its schema applied."""
    return emitted.where(F.col("tag") == tag).select("rec_id", "pk", "parent_key", F.from_json("payload", PAYLOADS[tag]).alias("p")).select("rec_id", "pk", "parent_key", "p.*")


def write_tables(emitted: DataFrame, path: str) -> None:
    """All tables in one pass, a directory per tag."""
    emitted.write.mode("overwrite").partitionBy("tag").parquet(path)


def read_table(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """A table written by write_tables; only its directory is read."""
    return flat_table(spark.read.schema(EMITTED).parquet(path), tag)
