"""Queries on joins, retrieval, logs and time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import events as E
from ..operators import retrieval, sampling
from ..operators.deliveries import latest_delivery
from ..session import table
from ..sources import views as V


def tool_dispatch(s: SparkSession, d: str) -> DataFrame:
    """Calls with the server's tool of that name; a call of an unknown tool gets a warning."""
    r = V.tool_runs(s, d)
    calls = r.select("run_id", "server_key", F.posexplode("trajectory").alias("i", "m")).select("run_id", "server_key", "i", F.posexplode("m.tool_calls").alias("j", "c")).select("run_id", "server_key", "i", "j", F.col("c.function.name").alias("name"))
    tools = table(s, d, "mcp_servers").select("server_key", F.explode("tools").alias("name"), F.lit(True).alias("known")).distinct()
    joined = calls.join(tools, ["server_key", "name"], "left")
    return joined.select("run_id", "i", "j", "name", F.when(F.coalesce("known", F.lit(False)), "ok").otherwise(F.concat(F.lit("Unknown tool: "), F.coalesce("name", F.lit("")))).alias("said"))


def zipped(s: SparkSession, d: str) -> DataFrame:
    """Titles and answers side by side by position, only where there are as many."""
    m = table(s, d, "mcp_servers").where("size(tools) = size(generated_questions)")
    return m.select("server_key", F.posexplode(F.arrays_zip("tools", "generated_questions")).alias("pos", "x")).select("server_key", "pos", F.col("x.tools").alias("tool"), F.col("x.generated_questions").alias("question"))


def log(s: SparkSession, d: str) -> DataFrame:
    return latest_delivery(table(s, d, "job_log"), "log_id", "received_at")


def levels(s: SparkSession, d: str) -> DataFrame:
    """Events per job mode and level; levels are compared without case and with their short forms."""
    raw = F.upper(F.trim("log_level"))
    level = F.when(raw.isNull(), "NONE").when(raw.startswith("WARN"), "WARNING").when(raw.startswith("ERR"), "ERROR").when(raw.startswith("INFO") | (raw == "I"), "INFO").when(raw.startswith("DEB"), "DEBUG").otherwise(raw)
    jobs = table(s, d, "jobs").select("job_id", "job_mode")
    return log(s, d).groupBy("job_id", level.alias("level")).agg(F.count(F.lit(1)).alias("n")).join(jobs, "job_id", "left").groupBy("job_mode", "level").agg(F.sum("n").alias("n"))


def indexed(s: SparkSession, d: str) -> DataFrame:
    """Group index to dataset index to teacher, a chain of lookups."""
    r = V.rollouts(s, d).select("rollout_id", "job_id")
    return r.join(table(s, d, "jobs").select("job_id", "source", "model"), "job_id").groupBy("source", "model").agg(F.count(F.lit(1)).alias("n"))


def neighbours(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings")
    return retrieval.nearest(e.where("vec_id % 50 = 0"), e, "vec_id", "embedding", 5).select("query_id", "rank", "neighbour_id")


def staleness(s: SparkSession, d: str) -> DataFrame:
    kept, back = E.fresh(V.steps(s, d), 2)
    count = lambda x, k: x.groupBy("step").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(k))
    return count(kept, "kept").unionByName(count(back, "requeued"))


QUERIES = {
    "decontaminate_anti": lambda s, d: V.rollouts(s, d).join(table(s, d, "eval_items").select(F.col("lang").alias("x"), F.col("question").alias("prompt")), "prompt", "left_anti").select("rollout_id"),
    "semi_ids": lambda s, d: V.rollouts(s, d).join(table(s, d, "jobs").where("batch_size > 16").select("job_id"), "job_id", "left_semi").select("rollout_id", "job_id"),
    "lookup_join": lambda s, d: V.tool_runs(s, d).join(table(s, d, "mcp_servers").select("server_key", "title"), "server_key").select("run_id", "server_key", "title"),
    "explode_tools_join": lambda s, d: table(s, d, "mcp_servers").select("server_key", F.posexplode("tools").alias("pos", "tool")).join(V.tool_runs(s, d).groupBy("server_key").agg(F.count(F.lit(1)).alias("n_runs")), "server_key").select("server_key", "pos", "tool", "n_runs"),
    "tool_dispatch": tool_dispatch,
    "zip_strict": zipped,
    "lookup_chain": indexed,
    "knn_topk": neighbours,
    "servers_with_tools": lambda s, d: table(s, d, "mcp_servers").where(F.size("tools") >= 2).select("server_key", F.size("tools").alias("n")),
    "event_offsets": lambda s, d: E.offsets(log(s, d).where("job_id is not null"), "job_id", ["event_offset", "log_id"]).select("log_id", F.col("offset").cast("bigint").alias("pos")),
    "event_ring_buffer": lambda s, d: E.ring(log(s, d).where("job_id is not null"), "job_id", "event_offset").select("job_id", "event_offset"),
    "event_since": lambda s, d: E.since(log(s, d).where("job_id is not null"), "job_id", "event_offset", 10),
    "log_levels": levels,
    "stale_filter": staleness,
    "count_window_minibatch": lambda s, d: V.steps(s, d).withColumn("minibatch", F.floor(F.col("event_id") % 16 / 4)).groupBy("step", "minibatch").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("tokens")),
    "event_windows": lambda s, d: E.windowed(table(s, d, "events"), "ts", "1 hour", "10 minutes", "event_type").select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round("total", 4).alias("total")),
    "first_last_event": lambda s, d: table(s, d, "events").groupBy("user_id").agg(F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"), F.count(F.lit(1)).alias("n")),
    "pricing_summary": lambda s, d: table(s, d, "lineitem").where("l_shipdate <= timestamp_ntz'1998-09-02'").groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count(F.lit(1)).alias("n")),
}
_LOG = "(SELECT * FROM job_log WHERE log_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY log_id ORDER BY received_at DESC NULLS LAST) = 1)"
_RING = f"(SELECT job_id, event_offset, max(event_offset) OVER (PARTITION BY job_id) AS last FROM {_LOG} WHERE job_id IS NOT NULL)"
_CALLS = f"(SELECT run_id, server_key, i, unnest(range(len(m.tool_calls))) AS j, unnest(m.tool_calls) AS c FROM (SELECT run_id, server_key, unnest(range(len(trajectory))) AS i, unnest(trajectory) AS m FROM {V.TOOL_RUNS}))"
ORACLE = {
    "decontaminate_anti": f"SELECT rollout_id FROM {V.ROLLOUTS} r WHERE NOT EXISTS (SELECT 1 FROM eval_items e WHERE e.question = r.prompt)",
    "semi_ids": f"SELECT rollout_id, job_id FROM {V.ROLLOUTS} WHERE job_id IN (SELECT job_id FROM jobs WHERE batch_size > 16)",
    "lookup_join": f"SELECT run_id, server_key, title FROM {V.TOOL_RUNS} JOIN (SELECT server_key, title FROM mcp_servers) USING (server_key)",
    "explode_tools_join": f"SELECT server_key, pos::INT AS pos, tool, n_runs FROM (SELECT server_key, unnest(range(len(tools))) AS pos, unnest(tools) AS tool FROM mcp_servers) JOIN (SELECT server_key, count(*) AS n_runs FROM {V.TOOL_RUNS} GROUP BY server_key) USING (server_key)",
    "tool_dispatch": f"SELECT run_id, i::INT AS i, j::INT AS j, c.function.name AS name, CASE WHEN t.tool IS NOT NULL THEN 'ok' ELSE 'Unknown tool: ' || coalesce(c.function.name, '') END AS said FROM {_CALLS} x LEFT JOIN (SELECT DISTINCT server_key, unnest(tools) AS tool FROM mcp_servers) t ON t.server_key = x.server_key AND t.tool = x.c.function.name",
    "zip_strict": "SELECT server_key, pos::INT AS pos, tool, question FROM (SELECT server_key, unnest(range(len(tools))) AS pos, unnest(tools) AS tool, unnest(generated_questions) AS question FROM mcp_servers WHERE len(tools) = len(generated_questions))",
    "lookup_chain": f"SELECT j.source, j.model, count(*) AS n FROM {V.ROLLOUTS} r JOIN jobs j USING (job_id) GROUP BY j.source, j.model",
    "knn_topk": "SELECT query_id, rank::INT AS rank, neighbour_id FROM (SELECT q.vec_id AS query_id, e.vec_id AS neighbour_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) DESC, e.vec_id) AS rank FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0) WHERE rank <= 5",
    "servers_with_tools": "SELECT server_key, len(tools)::INT AS n FROM mcp_servers WHERE len(tools) >= 2",
    "event_offsets": f"SELECT log_id, row_number() OVER (PARTITION BY job_id ORDER BY event_offset, log_id) - 1 AS pos FROM {_LOG} WHERE job_id IS NOT NULL",
    "event_ring_buffer": f"SELECT job_id, event_offset FROM {_RING} WHERE event_offset > last - 200",
    "event_since": f"SELECT job_id, count(*) FILTER (WHERE event_offset >= 10) AS n, max(event_offset) + 1 AS next, min(event_offset) > 10 AS truncated FROM {_RING} WHERE event_offset > last - 200 GROUP BY job_id",
    "log_levels": "SELECT job_mode, level, sum(n)::BIGINT AS n FROM (SELECT job_id, CASE WHEN r IS NULL THEN 'NONE' WHEN r LIKE 'WARN%' THEN 'WARNING' WHEN r LIKE 'ERR%' THEN 'ERROR' WHEN r LIKE 'INFO%' OR r = 'I' THEN 'INFO' WHEN r LIKE 'DEB%' THEN 'DEBUG' ELSE r END AS level, count(*) AS n "
    f"FROM (SELECT job_id, upper(trim(log_level, ' ')) AS r FROM {_LOG}) GROUP BY ALL) LEFT JOIN (SELECT job_id, job_mode FROM jobs) USING (job_id) GROUP BY job_mode, level",
    "stale_filter": f"SELECT step, count(*) AS n, CASE WHEN step - sampler_step > 2 THEN 'requeued' ELSE 'kept' END AS kind FROM {V.STEPS} GROUP BY ALL",
    "count_window_minibatch": f"SELECT step, event_id % 16 // 4 AS minibatch, count(*) AS n, sum(tokens)::BIGINT AS tokens FROM {V.STEPS} GROUP BY ALL",
    "event_windows": "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "first_last_event": "SELECT user_id, arg_min(event_type, {t: ts, i: event_id}) AS first_type, arg_max(event_type, {t: ts, i: event_id}) AS last_type, count(*) AS n FROM events GROUP BY user_id",
    "pricing_summary": "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL",
}
