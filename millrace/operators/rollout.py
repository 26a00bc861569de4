"""Rollouts: rows are handed in batches to a model backend inside the tasks; a deterministic stub stands in where there is no model.

A backend answers a batch of conversations. Tools are Python callables by name. Per row failures never end a job: an unknown tool, bad
arguments or an exception of a tool become tool messages, a backend that fails on a row leaves it out (`on_error="drop"`) or gives the
messages so far with the error (`on_error="partial"`).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MESSAGES = "array<struct<role:string,content:string,reasoning:string,name:string,tool_call_id:string,tool_calls:array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>>>"
#: Turns after which a rollout ends, with tools and with a simulated user.
TOOL_TURNS, USER_TURNS = 16, 4


class Backend(Protocol):
    def chat_batch(self, conversations: list[list[dict]], tools: list[dict]) -> list[dict | None]:
        """An assistant message for each conversation: content, optional reasoning and tool_calls; None where it failed."""


@dataclass
class StubBackend:
    """Answers made of a hash of the conversation; asks for a tool as long as fewer than `calls` answers of tools are there."""

    calls: int = 1

    def chat_batch(self, conversations: list[list[dict]], tools: list[dict]) -> list[dict | None]:
        return [self._one(c, tools) for c in conversations]

    def _one(self, messages: list[dict], tools: list[dict]) -> dict:
        said = hashlib.md5(json.dumps([[m["role"], m.get("content")] for m in messages], ensure_ascii=False).encode()).hexdigest()
        done = sum(m["role"] == "tool" for m in messages)
        if tools and done < self.calls:
            name = tools[int(said[:4], 16) % len(tools)]["function"]["name"]
            return {"content": "", "tool_calls": [{"id": f"call_{done}", "type": "function", "function": {"name": name, "arguments": json.dumps({"q": said[:6]})}}]}
        return {"content": f"Answer: {said[:8]}", "reasoning": None, "tool_calls": None}


@dataclass
class ToolRegistry:
    """Callables by name with their schemas; names are distinct."""

    functions: dict[str, Callable[..., Any]] = field(default_factory=dict)
    schemas: dict[str, dict] = field(default_factory=dict)

    def add(self, name: str, function: Callable[..., Any], description: str = "", parameters: dict | None = None) -> None:
        if name in self.functions:
            raise ValueError(f"tool {name} is there already")
        schema = {"type": "object", "properties": {}} | (parameters or {})
        self.functions[name] = function
        self.schemas[name] = {"type": "function", "function": {"name": name, "description": description, "parameters": schema}}

    def descriptors(self) -> list[dict]:
        return [self.schemas[k] for k in sorted(self.schemas)]

    def run(self, name: str | None, arguments: str | None) -> str:
        """The tool's output as text; every failure is a text too."""
        if name not in self.functions:
            return f"Unknown tool: {name}"
        try:
            args = json.loads(arguments or "{}")
            if not isinstance(args, dict):
                raise ValueError("not an object")
        except ValueError as e:
            return f"Bad arguments: {e}"
        try:
            out = self.functions[name](**args)
        except Exception as e:  # noqa: BLE001
            return f"Tool failed: {e}"
        return "" if out is None else out if isinstance(out, str) else json.dumps(out, ensure_ascii=False, default=str)


def blank(role: str, content: str | None, **more: Any) -> dict:
    return {"role": role, "content": content, "reasoning": None, "name": None, "tool_call_id": None, "tool_calls": None} | more


def opening(prompt: str, system: str | None) -> list[dict]:
    return ([blank("system", system)] if system else []) + [blank("user", prompt)]


def text_rollouts(backend: Backend, rows: list[list[dict]]) -> list[list[dict] | None]:
    """One call for all rows; as many answers as rows."""
    answers = backend.chat_batch(rows, [])
    if len(answers) != len(rows):
        raise ValueError(f"{len(answers)} answers to {len(rows)} conversations")
    return [None if a is None else r + [blank("assistant", a.get("content"), reasoning=a.get("reasoning"))] for r, a in zip(rows, answers)]


def tool_rollouts(backend: Backend, rows: list[list[dict]], tools: ToolRegistry, turns: int = TOOL_TURNS) -> list[list[dict] | None]:
    """Calls the model and its tools in turn until an answer asks for none or the turns are used up; open rows go on together."""
    state: list[list[dict] | None] = [list(r) for r in rows]
    open_ = list(range(len(rows)))
    for _ in range(turns):
        if not open_:
            break
        answers = backend.chat_batch([state[i] for i in open_], tools.descriptors())
        still = []
        for i, a in zip(open_, answers):
            if a is None:
                state[i] = None
                continue
            calls = a.get("tool_calls") or None
            state[i].append(blank("assistant", a.get("content"), reasoning=a.get("reasoning"), tool_calls=calls))
            for c in calls or ():
                state[i].append(blank("tool", tools.run(c["function"]["name"], c["function"]["arguments"]), name=c["function"]["name"], tool_call_id=c["id"]))
            if calls:
                still.append(i)
        open_ = still
    return state


def user_rollouts(backend: Backend, user: Backend, rows: list[list[dict]], turns: int = USER_TURNS) -> list[list[dict] | None]:
    """An assistant and a simulated user in turn; the user sees the conversation as text."""
    state = text_rollouts(backend, rows)
    for _ in range(turns - 1):
        open_ = [i for i, x in enumerate(state) if x is not None]
        seen = [[blank("user", "\n".join(f"{m['role']}: {m['content'] or ''}" for m in state[i]))] for i in open_]
        for i, a in zip(open_, user.chat_batch(seen, [])):
            state[i] = None if a is None else state[i] + [blank("user", a.get("content"))]
        open_ = [i for i in open_ if state[i] is not None]
        for i, x in zip(open_, text_rollouts(backend, [state[i] for i in open_])):
            state[i] = x
    return state


def generate(prompts: DataFrame, key: str, runner: Callable[[list[list[dict]]], list[list[dict] | None]], prompt: str = "prompt", system: str | None = None, batch: int = 64) -> DataFrame:
    """(key, trajectory) of prompts: the runner gets the openings of a batch of rows; rows it fails on are left out.

    Null prompts are left out. The rows stay where they are; a lost task is run again from its own rows.
    """
    picked = prompts.where(F.col(prompt).isNotNull()).select(F.col(key).alias("key"), F.col(prompt).alias("prompt"), (F.col(system) if system else F.lit(None)).cast("string").alias("system"))
    kind = dict(picked.dtypes)["key"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), batch):
                part = f.iloc[at : at + batch]
                done = runner([opening(p, s) for p, s in zip(part["prompt"], part["system"])])
                kept = [(k, t) for k, t in zip(part["key"], done) if t is not None]
                yield pd.DataFrame({"key": pd.Series([k for k, _ in kept], dtype=part["key"].dtype), "trajectory": pd.Series([t for _, t in kept], dtype=object)})

    return picked.mapInPandas(run, f"key {kind}, trajectory {MESSAGES}").withColumnRenamed("key", key)
