"""Views that queries share, over the tables of conversations, documents and events; each with its SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.deliveries import latest_delivery
from ..session import table


def h7(x: Column) -> Column:
    """The first seven hex digits of md5 as an integer: a hash that every engine has."""
    return F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("bigint")


def text_of(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_delivery(table(spark, sf_dir, "chats"), "chat_id")


def tool_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_delivery(table(spark, sf_dir, "tool_runs"), "run_id")


def rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_delivery(table(spark, sf_dir, "rollouts"), "rollout_id")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, source, turn, role, text): a row per message, null content as empty text."""
    each = chats(spark, sf_dir).select(F.col("chat_id").alias("conv_id"), "source", F.posexplode("messages").alias("turn", "m"))
    return each.select("conv_id", "source", "turn", F.col("m.role").alias("role"), F.coalesce("m.content", F.lit("")).alias("text"))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, prompt): the first user message of each conversation that isn't empty; others have no row."""
    user = F.filter("messages", lambda m: (m["role"] == "user") & (m["content"] != ""))
    return chats(spark, sf_dir).select(F.col("chat_id").alias("conv_id"), F.try_element_at(user, F.lit(1))["content"].alias("prompt")).where("prompt is not null")


def tokens(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """(conv_id, turn, pos, tok, lp_student, lp_teacher, mask): the words of every message with hashed log-probabilities, and more columns of the messages."""
    m = messages(spark, sf_dir).select("conv_id", "turn", "role", *more, F.filter(F.split("text", "\\s+"), lambda x: x != "").alias("toks"))
    t = m.select("conv_id", "turn", "role", *more, F.posexplode("toks").alias("pos", "tok"))
    at = text_of(F.col("conv_id"), ":", F.col("turn"), ":", F.col("pos"))
    lp = lambda salt: -(h7(F.concat(F.lit(salt), at)) % 1000) / 100.0
    return t.select("conv_id", "turn", "pos", "tok", lp("s:").alias("lp_student"), lp("t:").alias("lp_teacher"), (F.col("role") == "assistant").cast("int").alias("mask"), *more)


def rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(group_id, member_id, reward): documents by source; the reward is a hash of the id, zero or one."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("source").alias("group_id"), F.col("doc_id").alias("member_id"), (h7(text_of("r:", F.col("doc_id"))) % 2).cast("double").alias("reward"))


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, step, sampler_step, tokens): groups in the order of their ids, sixteen to a step."""
    e = table(spark, sf_dir, "events")
    step = F.floor(F.col("event_id") / 16).cast("bigint")
    return e.select("event_id", step.alias("step"), (step - h7(F.col("event_id").cast("string")) % 5).alias("sampler_step"), F.floor(F.coalesce("value", F.lit(0.0))).cast("bigint").alias("tokens"))


def _last(name: str, key: str) -> str:
    return f"(SELECT * FROM {name} WHERE {key} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY ingested_at DESC NULLS LAST) = 1)"


def h7_sql(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 7))::BIGINT"


CHATS, TOOL_RUNS, ROLLOUTS = _last("chats", "chat_id"), _last("tool_runs", "run_id"), _last("rollouts", "rollout_id")
MESSAGES = f"(SELECT conv_id, source, turn::INT AS turn, m.role AS role, coalesce(m.content, '') AS text FROM (SELECT chat_id AS conv_id, source, unnest(range(len(messages))) AS turn, unnest(messages) AS m FROM {CHATS}))"
PROMPTS = f"(SELECT conv_id, text AS prompt FROM {MESSAGES} WHERE role = 'user' AND text <> '' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1)"
TOKENS = (
    "(SELECT conv_id, turn, pos::INT AS pos, tok, -(" + h7_sql("'s:' || conv_id || ':' || turn || ':' || pos") + " % 1000) / 100.0::DOUBLE AS lp_student, "
    "-(" + h7_sql("'t:' || conv_id || ':' || turn || ':' || pos") + " % 1000) / 100.0::DOUBLE AS lp_teacher, (role = 'assistant')::INT AS mask FROM "
    f"(SELECT conv_id, turn, role, unnest(range(len(toks))) AS pos, unnest(toks) AS tok FROM (SELECT conv_id, turn, role, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS toks FROM {MESSAGES})))"
)
REWARDS = f"(SELECT source AS group_id, doc_id AS member_id, ({h7_sql("'r:' || doc_id")} % 2)::DOUBLE AS reward FROM documents)"
STEPS = f"(SELECT event_id, floor(event_id / 16)::BIGINT AS step, floor(event_id / 16)::BIGINT - {h7_sql('event_id::VARCHAR')} % 5 AS sampler_step, floor(coalesce(value, 0))::BIGINT AS tokens FROM events)"
