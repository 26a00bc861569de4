"""Queries that run rollouts on the stub; their rows are checked, not their text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rollout as R
from ..sources import views as V


def tools() -> R.ToolRegistry:
    registry = R.ToolRegistry()
    registry.add("search_notes", lambda q="": {"found": len(q)}, "Finds notes.", {"properties": {"q": {"type": "string"}}})
    registry.add("count_letters", lambda q="": len(q), "Counts letters.")
    return registry


def text(s: SparkSession, d: str) -> DataFrame:
    r = R.generate(V.prompts(s, d), "conv_id", lambda rows: R.text_rollouts(R.StubBackend(), rows))
    return r.select("conv_id", F.size("trajectory").alias("n_messages"), F.length(F.element_at("trajectory", -1)["content"]).alias("n_chars"))


def with_tools(s: SparkSession, d: str) -> DataFrame:
    r = R.generate(V.prompts(s, d), "conv_id", lambda rows: R.tool_rollouts(R.StubBackend(2), rows, tools()))
    return r.select("conv_id", F.size("trajectory").alias("n_messages"), F.size(F.filter("trajectory", lambda m: m["role"] == "tool")).alias("n_answers"))


def with_user(s: SparkSession, d: str) -> DataFrame:
    r = R.generate(V.prompts(s, d), "conv_id", lambda rows: R.user_rollouts(R.StubBackend(), R.StubBackend(), rows, 3))
    return r.select("conv_id", F.size("trajectory").alias("n_messages"))


QUERIES = {"rollout_stub_text": text, "rollout_stub_tools": with_tools, "rollout_stub_multiturn": with_user}
ORACLE = {
    "rollout_stub_text": f"SELECT conv_id, 2 AS n_messages, 16 AS n_chars FROM {V.PROMPTS}",
    "rollout_stub_tools": f"SELECT conv_id, 6 AS n_messages, 2 AS n_answers FROM {V.PROMPTS}",
    "rollout_stub_multiturn": f"SELECT conv_id, 6 AS n_messages FROM {V.PROMPTS}",
}
