"""Queries on conversations and trajectories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chat as C
from ..sources import views as V

SYSTEM = "You are a careful assistant."
#: The caps of the query are small, so that its data reach them.
CAP, TOTAL = 60, 150


def rendered(render):
    def query(s: SparkSession, d: str) -> DataFrame:
        x = V.chats(s, d).select(F.col("chat_id").alias("conv_id"), render(F.col("messages")).alias("x"))
        return x.select("conv_id", F.md5("x").alias("text_md5"), F.length("x").alias("n"))

    return query


def first_last(s: SparkSession, d: str) -> DataFrame:
    """First and last message of each role."""
    m = V.messages(s, d)
    return m.groupBy("conv_id", "role").agg(F.min_by("text", "turn").alias("first_text"), F.max_by("text", "turn").alias("last_text"), F.max("turn").alias("last_turn"))


def generation_record(s: SparkSession, d: str) -> DataFrame:
    """Prompt, content and reasoning with empty ones left null, and the trajectory of the exchange."""
    r = V.rollouts(s, d)
    empty = lambda c: F.nullif(F.col(c), F.lit(""))
    return r.select("rollout_id", "prompt", empty("content").alias("content"), empty("reasoning").alias("reasoning"), F.md5(C.serialized(C.single_turn(F.col("prompt"), F.col("content"), F.lit(SYSTEM)))).alias("trajectory_md5"))


def capped(s: SparkSession, d: str) -> DataFrame:
    x = V.tool_runs(s, d).where("trajectory is not null").select("run_id", F.posexplode(C.capped(F.col("trajectory"), CAP, TOTAL)).alias("turn", "m"))
    return x.where("m.role = 'tool'").select("run_id", "turn", F.length("m.content").alias("n"))


def items(s: SparkSession, d: str) -> DataFrame:
    x = V.chats(s, d).select(F.col("chat_id").alias("conv_id"), F.posexplode(C.response_items(F.col("messages"))).alias("pos", "x"))
    return x.select("conv_id", "pos", "x.type", "x.role", "x.content", "x.call_id", "x.name")


QUERIES = {
    "trajectory_text": rendered(C.serialized),
    "render_role_colon": rendered(C.role_colon),
    "render_llama3": rendered(C.header_tags),
    "render_qwen3": rendered(C.im_tags),
    "initial_history": lambda s, d: V.prompts(s, d).select("conv_id", F.explode(C.history(F.col("prompt"), F.when(F.col("conv_id") % 2 == 0, SYSTEM))).alias("m")).select("conv_id", "m.role", "m.content"),
    "last_assistant": lambda s, d: V.chats(s, d).select(F.col("chat_id").alias("conv_id"), C.last_content(F.col("messages"), "assistant").alias("response")),
    "first_last_by_turn": first_last,
    "message_roles_valid": lambda s, d: V.chats(s, d).where((F.size("messages") >= 2) & (F.try_element_at("messages", F.lit(-1))["role"] == "assistant")).select(F.col("chat_id").alias("conv_id"), F.size("messages").alias("n_messages")),
    "tool_turn_filter": lambda s, d: V.tool_runs(s, d).where(C.has_tool_turn(F.col("trajectory"))).select("run_id"),
    "tool_error_filter": lambda s, d: V.tool_runs(s, d).where(C.sound_tool_use(F.col("trajectory"))).select("run_id"),
    "content_cap": capped,
    "code_block_extract": lambda s, d: V.rollouts(s, d).select("rollout_id", C.code_block(F.col("content")).alias("code")).where("code is not null"),
    "generation_record": generation_record,
    "response_input": items,
    "role_remap": lambda s, d: V.chats(s, d).select(F.col("chat_id").alias("conv_id"), F.md5(C.serialized(C.remapped(F.col("messages"), {"user": "assistant", "assistant": "user"}))).alias("text_md5")),
}

_EACH = f"SELECT conv_id, string_agg({{}}, {{}} ORDER BY turn) AS x FROM {V.MESSAGES} GROUP BY conv_id"
_ALL = f"SELECT chat_id AS conv_id, coalesce(x, '') AS x FROM {V.CHATS} LEFT JOIN ({_EACH}) e ON e.conv_id = chat_id"
_SUM = "SELECT conv_id, md5({}) AS text_md5, length({})::INT AS n FROM ({})"


def _render(one: str, sep: str, start: str = "", end: str = "") -> str:
    whole = f"{start}x{end}"
    return _SUM.format(whole, whole, _ALL.format(one, sep))


_RUN = f"(SELECT run_id, i::INT AS turn, m, trajectory FROM (SELECT run_id, trajectory, unnest(range(len(trajectory))) AS i, unnest(trajectory) AS m FROM {V.TOOL_RUNS}))"
_FAILED = (
    "(lower(coalesce(m.content, '')) LIKE '%unauthorized%' OR lower(coalesce(m.content, '')) LIKE '%forbidden%' OR m.content LIKE '%401%' OR m.content LIKE '%403%' OR "
    "coalesce(CASE WHEN json_valid(m.content) THEN json_extract_string(m.content, '$.error') END, '') NOT IN ('', '0', '0.0', 'false', '[]', '{}', 'null', '-0', '-0.0'))"
)
ORACLE = {
    "trajectory_text": _render("role || ': ' || text", "chr(10)"),
    "render_role_colon": _render("upper(role[1]) || role[2:] || ': ' || text || chr(10) || chr(10)", "''", end=" || 'Assistant:'"),
    "render_llama3": _render("'<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) || text || '<|eot_id|>'", "''", "'<|begin_of_text|>' || ", " || '<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10)"),
    "render_qwen3": _render("'<|im_start|>' || role || chr(10) || CASE WHEN role = 'assistant' AND NOT contains(text, '<think>') THEN '<think>' || chr(10) ELSE '' END || text || '<|im_end|>'", "chr(10)", end=" || chr(10) || '<|im_start|>assistant' || chr(10) || '<think>' || chr(10)"),
    "initial_history": f"SELECT conv_id, 'user' AS role, prompt AS content FROM {V.PROMPTS} UNION ALL SELECT conv_id, 'system', '{SYSTEM}' FROM {V.PROMPTS} WHERE conv_id % 2 = 0",
    "last_assistant": f"SELECT chat_id AS conv_id, coalesce(list_filter(messages, lambda m: m.role = 'assistant' AND m.content IS NOT NULL)[-1].content, '') AS response FROM {V.CHATS}",
    "first_last_by_turn": f"SELECT conv_id, role, min_by(text, turn) AS first_text, max_by(text, turn) AS last_text, max(turn) AS last_turn FROM {V.MESSAGES} GROUP BY conv_id, role",
    "message_roles_valid": f"SELECT chat_id AS conv_id, len(messages)::INT AS n_messages FROM {V.CHATS} WHERE len(messages) >= 2 AND messages[-1].role = 'assistant'",
    "tool_turn_filter": f"SELECT DISTINCT run_id FROM {_RUN} WHERE m.role = 'tool'",
    "tool_error_filter": f"SELECT run_id FROM {_RUN} GROUP BY run_id HAVING bool_or(m.role = 'assistant' AND coalesce(len(m.tool_calls), 0) > 0) AND NOT coalesce(bool_or(m.role = 'tool' AND {_FAILED}), false)",
    "content_cap": f"SELECT run_id, turn, CASE WHEN newer <= {TOTAL} THEN least(size, {CAP}) ELSE size END::INT AS n FROM (SELECT run_id, turn, m.role AS role, length(m.content) AS size, coalesce(sum(CASE WHEN m.role = 'tool' THEN least(length(coalesce(m.content, '')), {CAP}) ELSE 0 END) OVER (PARTITION BY run_id ORDER BY turn DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS newer FROM {_RUN}) WHERE role = 'tool'",
    "code_block_extract": f"SELECT rollout_id, regexp_replace(regexp_replace(string_split(tail, '```')[1], '^[\\r\\n]+', ''), '\\s+$', '') AS code FROM (SELECT rollout_id, regexp_split_to_array(content, '(?i)```python') AS parts, parts[-1] AS tail FROM {V.ROLLOUTS}) WHERE len(parts) > 1 AND contains(tail, '```')",
    "generation_record": f"SELECT rollout_id, prompt, nullif(content, '') AS content, nullif(reasoning, '') AS reasoning, md5('system: {SYSTEM}' || chr(10) || 'user: ' || prompt || chr(10) || 'assistant: ' || coalesce(content, '')) AS trajectory_md5 FROM {V.ROLLOUTS}",
    "response_input": "SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY i, j) - 1)::INT AS pos, type, role, content, call_id, name FROM ("
    f"SELECT chat_id AS conv_id, i, -1 AS j, CASE WHEN m.role = 'tool' THEN 'function_call_output' ELSE 'message' END AS type, CASE WHEN m.role <> 'tool' THEN m.role END AS role, coalesce(m.content, '') AS content, CASE WHEN m.role = 'tool' THEN m.tool_call_id END AS call_id, NULL::VARCHAR AS name FROM (SELECT chat_id, unnest(range(len(messages))) AS i, unnest(messages) AS m FROM {V.CHATS}) UNION ALL "
    f"SELECT chat_id, i, j, 'function_call', NULL, c.function.arguments, c.id, c.function.name FROM (SELECT chat_id, i, unnest(range(len(m.tool_calls))) AS j, unnest(m.tool_calls) AS c FROM (SELECT chat_id, unnest(range(len(messages))) AS i, unnest(messages) AS m FROM {V.CHATS}) WHERE m.role <> 'tool'))",
    "role_remap": f"SELECT conv_id, md5(string_agg(CASE role WHEN 'user' THEN 'assistant' WHEN 'assistant' THEN 'user' ELSE role END || ': ' || text, chr(10) ORDER BY turn)) AS text_md5 FROM {V.MESSAGES} GROUP BY conv_id",
}
