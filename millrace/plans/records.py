"""Queries on records, tokens and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import records as R
from ..functions import tokens as K
from ..functions.text import strip
from ..operators.sampling import numbered
from ..session import table
from ..sources import views as V


def items(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "eval_items")


def contexts(s: SparkSession, d: str) -> DataFrame:
    """Questions of a suite under the lines of their answers."""
    return items(s, d).select("item_id", R.context_prompt(F.array(F.split("question", r"\. "), F.array("answer", "suite")), F.col("question")).alias("prompt"))


def meta_prompts(s: SparkSession, d: str) -> DataFrame:
    """A server with three of its tools, drawn by hash."""
    t = table(s, d, "mcp_servers").select("server_key", "title", F.explode("tools").alias("t"))
    w = Window.partitionBy("server_key").orderBy(F.md5(F.concat("server_key", F.lit(":"), "t")), "t")  # a server's tools are a handful
    t = t.withColumn("n", F.row_number().over(w)).where("n <= 3").groupBy("server_key", "title").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "t"))), lambda x: x["t"]), ", ").alias("tools"))
    turns = F.when(V.h7(F.col("server_key")) % 10 < 8, 1).otherwise(2)
    return t.select("server_key", F.concat(F.lit("Server: "), "title", F.lit("\nTools: "), "tools", F.lit("\nTurns: "), turns).alias("prompt"))


def speakers(s: SparkSession, d: str) -> DataFrame:
    turns = F.transform("messages", lambda m: F.struct(F.when(m["role"] == "user", "human").otherwise("gpt").alias("from"), F.coalesce(m["content"], F.lit("")).alias("value")))
    x = V.chats(s, d).select(F.col("chat_id").alias("conv_id"), F.posexplode(R.speaker_messages(turns)).alias("turn", "m"))
    return x.groupBy("conv_id", "m.role").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("m.content")).alias("n_chars"))


def parts(s: SparkSession, d: str) -> DataFrame:
    p = lambda t, x: F.struct(F.lit(t).alias("type"), x.alias("text"))
    two = F.array(p("text", F.col("question")), F.when(F.col("item_id") % 5 == 0, p("image", F.lit("x"))).otherwise(p("text", F.col("answer"))))
    return items(s, d).select("item_id", R.joined_parts(two).alias("loose"), R.joined_parts(two, " ", True).alias("strict"))


def token_arrays(s: SparkSession, d: str) -> DataFrame:
    t = V.tokens(s, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "pos", "tok", "lp_student", "mask"))).alias("x"))
    return t.select("conv_id", F.col("x.tok").alias("toks"), F.col("x.lp_student").alias("lp"), F.col("x.mask").alias("mask"))


def spans(s: SparkSession, d: str) -> DataFrame:
    t = token_arrays(s, d)
    return t.select("conv_id", F.size(K.completion(F.col("toks"), F.col("mask"))).alias("n_completion"), F.size(K.trained_span(F.col("lp"), F.col("mask"))).alias("n_span"), F.md5(F.array_join(K.completion(F.col("toks"), F.col("mask")), " ")).alias("completion_md5"))


def mismatch(s: SparkSession, d: str) -> DataFrame:
    """Where the words of prompt and content first differ."""
    w = lambda c: F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda x: x != "")
    return V.rollouts(s, d).select("rollout_id", F.coalesce(K.first_difference(w("prompt"), w("content")), F.lit(-1)).alias("at"), K.starts_with(w("prompt"), w("content")).alias("copied"))


def moving_union(s: SparkSession, d: str) -> DataFrame:
    """Distinct sources of the last three batches of a hundred documents: every batch counts for itself and the next two."""
    b = table(s, d, "documents").select(F.floor(F.col("doc_id") / 100).alias("own"), "source").distinct()
    spread = b.select(F.explode(F.sequence("own", F.col("own") + 2)).alias("batch"), "source", "own")
    return spread.groupBy("batch").agg(F.countDistinct("source").alias("n_sources"), F.max("own").alias("own")).where("own = batch").select("batch", F.col("n_sources").cast("int").alias("n_sources"))


def steps_summary(s: SparkSession, d: str) -> DataFrame:
    return V.steps(s, d).groupBy((F.col("step") / 100).cast("bigint").alias("block")).agg(F.min("sampler_step").alias("first"), F.max("sampler_step").alias("last"), F.round(F.avg("sampler_step"), 6).alias("mean"))


def job_metrics(s: SparkSession, d: str) -> DataFrame:
    """Per job the rows, those that say something, those left out and the tokens."""
    r = V.rollouts(s, d).groupBy("job_id").agg(F.count(F.lit(1)).alias("prompts"), F.count(F.nullif(strip(F.col("content")), F.lit(""))).alias("written"), F.sum("token_count").alias("tokens"))
    return r.select("job_id", "prompts", "written", (F.col("prompts") - F.col("written")).alias("filtered"), F.coalesce("tokens", F.lit(0)).alias("tokens"))


def log_ids(s: SparkSession, d: str) -> DataFrame:
    """Small ids of jobs by when they were first seen, and the events' time since then in microseconds."""
    log = table(s, d, "job_log").where("job_id is not null")
    first = numbered(log.groupBy("job_id").agg(F.min("logged_at").alias("first")), [F.col("first"), F.col("job_id")])
    return first.select("job_id", (F.col("idx") + 1).cast("int").alias("pid"), F.date_format("first", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("first_at"))


QUERIES = {
    "context_prompt": contexts,
    "instructed_prompt": lambda s, d: items(s, d).select("item_id", R.instructed_prompt(F.when(F.col("item_id") % 2 == 0, F.col("suite")), F.col("question")).alias("prompt")),
    "issue_prompt": lambda s, d: table(s, d, "documents").where("doc_kind = 'issue'").select("doc_id", F.md5(R.issue_prompt(F.concat("source", F.lit("/x")), F.col("text"), F.col("lang"), F.lit(""))).alias("prompt_md5")),
    "meta_prompt": meta_prompts,
    "tool_descriptors": lambda s, d: table(s, d, "mcp_servers").select("server_key", F.posexplode("tools").alias("pos", "t")).select("server_key", "pos", R.descriptor(F.col("t"), F.lit(None).cast("string"), F.lit(None).cast("string")).alias("descriptor")),
    "speaker_messages": speakers,
    "multipart_text": parts,
    "gold_match": lambda s, d: items(s, d).select("item_id", R.any_gold(F.concat(F.lit("The "), F.upper("answer"), F.lit(".")), R.gold_of(F.array().cast("array<string>"), F.array("answer", "suite"))).alias("correct")),
    "thought_split": lambda s, d: V.rollouts(s, d).where("content is not null").select("rollout_id", F.md5(F.coalesce(R.thought(F.col("content"))[0], F.lit(""))).alias("reasoning_md5"), F.md5(R.thought(F.col("content"))[1]).alias("content_md5")),
    "error_kinds": lambda s, d: V.tool_runs(s, d).groupBy(R.error_kind(F.col("error")).alias("kind")).agg(F.count(F.lit(1)).alias("n")),
    "script_language": lambda s, d: items(s, d).groupBy(R.script_language(F.col("question")).alias("label"), "lang").agg(F.count(F.lit(1)).alias("n")),
    "image_names": lambda s, d: table(s, d, "jobs").select("job_id", R.image_name(F.concat("model", F.lit("/"), "source", F.lit(":"), "job_id")).alias("name")),
    "editor_replace": lambda s, d: table(s, d, "documents").select("doc_id", F.md5(R.replaced(F.coalesce("text", F.lit("")), "the ", "a ")[0]).alias("text_md5"), R.replaced(F.coalesce("text", F.lit("")), "the ", "a ")[1].alias("n")),
    "editor_view": lambda s, d: table(s, d, "documents").where("text is not null").select("doc_id", F.md5(R.viewed(F.col("text"), 2, 4)).alias("view_md5"), F.md5(R.inserted(F.col("text"), 1, "new")).alias("insert_md5")),
    "token_spans": spans,
    "token_mismatch": mismatch,
    "prompt_truncate": lambda s, d: V.prompts(s, d).select("conv_id", K.truncated(F.col("prompt"), 16).alias("prompt")),
    "length_preference": lambda s, d: V.rollouts(s, d).select("rollout_id", F.signum(F.length(F.coalesce("reasoning", F.lit(""))) - F.length(F.coalesce("content", F.lit("")))).cast("int").alias("sign")),
    "schedules": lambda s, d: s.range(40).select("id", F.round(K.learning_rate(F.col("id"), 30), 6).alias("lr"), F.round(K.backoff(F.col("id")), 6).alias("delay"), K.batch_size(F.col("id"), F.when(F.col("id") % 2 == 0, 7), 2).alias("batch")),
    "moving_union": moving_union,
    "sampler_steps": steps_summary,
    "job_metrics": job_metrics,
    "eval_moments": lambda s, d: V.rollouts(s, d).groupBy("model").agg(F.round(F.avg("token_count"), 6).alias("mean"), F.round(F.stddev_pop("token_count"), 6).alias("std"), F.count("token_count").alias("n")),
    "containment_accuracy": lambda s, d: V.rollouts(s, d).groupBy("source").agg(F.round(F.avg(F.contains(F.lower(F.coalesce("content", F.lit(""))), F.lower(F.substring_index("prompt", " ", 1))).cast("int")), 6).alias("accuracy")),
    "job_first_seen": log_ids,
    "distinct_servers": lambda s, d: V.tool_runs(s, d).where("server_key is not null").select("server_key").distinct(),
    "answer_pairs": lambda s, d: items(s, d).where("answer is not null").select("item_id", F.to_json(F.array(F.struct(F.lit("user").alias("role"), F.col("question").alias("content")), F.struct(F.lit("assistant").alias("role"), F.col("answer").alias("content")))).alias("messages")),
}
_NW = "list_filter(regexp_split_to_array(coalesce({0}, ''), '\\s+'), lambda x: x <> '')"
_T = f"(SELECT conv_id, list(tok ORDER BY turn, pos) FILTER (WHERE mask = 1) AS c, list(mask ORDER BY turn, pos) AS m FROM {V.TOKENS} GROUP BY conv_id)"
_ST = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
ORACLE = {
    "context_prompt": "SELECT item_id, array_to_string(list_concat(string_split(question, '. '), [answer, suite]), chr(10)) || chr(10) || chr(10) || 'Question: ' || question AS prompt FROM eval_items",
    "instructed_prompt": "SELECT item_id, CASE WHEN item_id % 2 = 0 THEN suite ELSE '' END || chr(10) || chr(10) || question AS prompt FROM eval_items",
    "issue_prompt": f"SELECT doc_id, md5('Repository: ' || replace(source || '/x', '/', '__') || chr(10) || chr(10) || coalesce(nullif({_ST.format('text')}, ''), '(no description)') || CASE WHEN coalesce(lang, '') <> '' THEN chr(10) || chr(10) || 'Hints:' || chr(10) || lang ELSE '' END) AS prompt_md5 FROM documents WHERE doc_kind = 'issue'",
    "meta_prompt": f"SELECT server_key, 'Server: ' || title || chr(10) || 'Tools: ' || string_agg(t, ', ' ORDER BY n) || chr(10) || 'Turns: ' || CASE WHEN {V.h7_sql('server_key')} % 10 < 8 THEN 1 ELSE 2 END AS prompt FROM (SELECT server_key, title, t, row_number() OVER (PARTITION BY server_key ORDER BY md5(server_key || ':' || t), t) AS n FROM (SELECT server_key, title, unnest(tools) AS t FROM mcp_servers)) WHERE n <= 3 GROUP BY server_key, title",
    "tool_descriptors": "SELECT server_key, pos::INT AS pos, '{\"type\":\"function\",\"function\":{\"name\":\"' || t || '\",\"description\":\"\",\"parameters\":\"{\\\"type\\\":\\\"object\\\",\\\"properties\\\":{}}\"}}' AS descriptor FROM (SELECT server_key, unnest(range(len(tools))) AS pos, unnest(tools) AS t FROM mcp_servers)",
    "speaker_messages": f"SELECT conv_id, CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role, count(*) AS n, sum(length(text))::BIGINT AS n_chars FROM {V.MESSAGES} GROUP BY 1, 2",
    "multipart_text": "SELECT item_id, question || CASE WHEN item_id % 5 = 0 THEN '' ELSE answer END AS loose, CASE WHEN item_id % 5 <> 0 THEN question || ' ' || answer END AS strict FROM eval_items",
    "gold_match": "SELECT item_id, answer IS NOT NULL AS correct FROM eval_items",
    "thought_split": f"SELECT rollout_id, md5({_ST.format("regexp_extract(content, '<think>(.*?)</think>', 1, 's')")}) AS reasoning_md5, md5({_ST.format("regexp_replace(content, '<think>.*?</think>', '', 'gs')")}) AS content_md5 FROM {V.ROLLOUTS} WHERE content IS NOT NULL",
    "error_kinds": f"SELECT CASE WHEN regexp_matches(m, 'permission|unauthorized|forbidden|denied') THEN 'permission' WHEN regexp_matches(m, 'context length|maximum context|max_tokens|too many tokens|too long') THEN 'context' WHEN regexp_matches(m, 'parse|json|decode|invalid') THEN 'parse' ELSE 'other' END AS kind, count(*) AS n FROM (SELECT lower(coalesce(error, '')) AS m FROM {V.TOOL_RUNS}) GROUP BY 1",
    "script_language": "SELECT CASE WHEN regexp_matches(question, '\\p{Greek}') THEN 'el' WHEN regexp_matches(question, '\\p{Cyrillic}') THEN 'ru' WHEN regexp_matches(question, '\\p{Han}') THEN 'zh' WHEN regexp_matches(question, '[äöüß]') THEN 'de' WHEN regexp_matches(question, '[ñ¿¡]') THEN 'es' WHEN regexp_matches(question, '[çêœàè]') THEN 'fr' ELSE 'en' END AS label, lang, count(*) AS n FROM eval_items GROUP BY 1, 2",
    "image_names": "SELECT job_id, right(translate(model || '/' || source || ':' || job_id, '/:', '__'), 12) AS name FROM jobs",
    "editor_replace": "SELECT doc_id, md5(replace(coalesce(text, ''), 'the ', 'a ')) AS text_md5, ((length(coalesce(text, '')) - length(replace(coalesce(text, ''), 'the ', ''))) / 4)::INT AS n FROM documents",
    "editor_view": "SELECT doc_id, md5(array_to_string(l[2:4], chr(10))) AS view_md5, md5(array_to_string(list_concat(l[1:1], ['new'], l[2:]), chr(10))) AS insert_md5 FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)",
    "token_spans": f"SELECT conv_id, coalesce(len(c), 0)::INT AS n_completion, CASE WHEN c IS NULL THEN 0 ELSE len(m) - list_position(m, 1) - list_position(list_reverse(m), 1) + 2 END::INT AS n_span, md5(coalesce(array_to_string(c, ' '), '')) AS completion_md5 FROM {_T}",
    "token_mismatch": f"SELECT rollout_id, coalesce((SELECT min(i) FROM range(greatest(len(a), len(b))) t(i) WHERE a[i + 1] IS DISTINCT FROM b[i + 1]), -1)::INT AS at, b[1:len(a)] = a AS copied FROM (SELECT rollout_id, {_NW.format('prompt')} AS a, {_NW.format('content')} AS b FROM {V.ROLLOUTS})",
    "prompt_truncate": f"SELECT conv_id, array_to_string(({_NW.format('prompt')})[1:16], ' ') AS prompt FROM {V.PROMPTS}",
    "length_preference": f"SELECT rollout_id, sign(length(coalesce(reasoning, '')) - length(coalesce(content, '')))::INT AS sign FROM {V.ROLLOUTS}",
    "schedules": "SELECT id, round(greatest(0, 1 - id / 30.0::DOUBLE), 6) AS lr, round(least(30.0::DOUBLE, pow(1.5::DOUBLE, id)), 6) AS delay, greatest(1, least(CASE WHEN id % 2 = 0 THEN 7 ELSE 8 END, id)) AS batch FROM range(40) t(id)",
    "moving_union": "WITH b AS (SELECT doc_id // 100 AS batch, source FROM documents GROUP BY ALL) SELECT x.batch, (SELECT count(DISTINCT source) FROM b WHERE b.batch BETWEEN x.batch - 2 AND x.batch)::INT AS n_sources FROM (SELECT DISTINCT batch FROM b) x",
    "sampler_steps": f"SELECT step // 100 AS block, min(sampler_step) AS first, max(sampler_step) AS last, round(avg(sampler_step), 6) AS mean FROM {V.STEPS} GROUP BY 1",
    "job_metrics": f"SELECT job_id, prompts, written, prompts - written AS filtered, coalesce(tokens, 0) AS tokens FROM (SELECT job_id, count(*) AS prompts, count(nullif({_ST.format('content')}, '')) AS written, sum(token_count)::BIGINT AS tokens FROM {V.ROLLOUTS} GROUP BY job_id)",
    "eval_moments": f"SELECT model, round(avg(token_count), 6) AS mean, round(stddev_pop(token_count), 6) AS std, count(token_count) AS n FROM {V.ROLLOUTS} GROUP BY model",
    "containment_accuracy": f"SELECT source, round(avg(contains(lower(coalesce(content, '')), lower(string_split(prompt, ' ')[1]))::INT), 6) AS accuracy FROM {V.ROLLOUTS} GROUP BY source",
    "job_first_seen": "SELECT job_id, row_number() OVER (ORDER BY first, job_id)::INT AS pid, strftime(first, '%Y-%m-%dT%H:%M:%S.%fZ') AS first_at FROM (SELECT job_id, min(logged_at) AS first FROM job_log WHERE job_id IS NOT NULL GROUP BY job_id)",
    "distinct_servers": f"SELECT DISTINCT server_key FROM {V.TOOL_RUNS} WHERE server_key IS NOT NULL",
    "answer_pairs": "SELECT item_id, to_json([{role: 'user', content: question}, {role: 'assistant', content: answer}])::VARCHAR AS messages FROM eval_items WHERE answer IS NOT NULL",
}
