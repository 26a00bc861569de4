"""Queries on answers, names, JSON and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grading, text as X
from ..session import table
from ..sources import views as V


def contents(s: SparkSession, d: str) -> DataFrame:
    return V.rollouts(s, d).select("rollout_id", F.coalesce("content", F.lit("")).alias("c"), F.coalesce("prompt", F.lit("")).alias("p"))


def hhh(s: SparkSession, d: str) -> DataFrame:
    t = contents(s, d).select("rollout_id", X.transcript(F.concat(F.lit("Human: "), F.col("p"), F.lit("\n\nAssistant: "), F.col("c"))).alias("x"))
    return t.select("rollout_id", F.posexplode("x").alias("pos", "m")).select("rollout_id", "pos", "m.role", F.md5("m.content").alias("content_md5"))


def guesses(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "eval_items")
    n = V.h7(V.text_of("g:", F.col("item_id"))) % 50
    text = F.when(F.col("item_id") % 7 == 0, F.col("answer")).otherwise(V.text_of("Guess: ", n))
    return e.select("item_id", X.feedback(text, F.lit(25)).alias("feedback"))


def numbers(s: SparkSession, d: str) -> DataFrame:
    a = F.col("answer")
    return table(s, d, "eval_items").select("item_id", X.is_int(a).alias("is_int"), X.is_float(a).alias("is_float"), X.is_fraction(F.concat(a, F.lit("/3"))).alias("is_fraction"))


def pages(s: SparkSession, d: str) -> DataFrame:
    """Messages made pages of: the text comes back, single-spaced."""
    m = V.messages(s, d).where("role = 'user'")
    page = F.concat(F.lit("<html><head><style>p {}</style><title>t</title></head><body><p>"), F.replace(F.replace("text", F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit("</p><script>x < 1</script></body></html>"))
    return m.select("conv_id", "turn", F.md5(X.html_text(page)).alias("text_md5"))


def arguments(s: SparkSession, d: str) -> DataFrame:
    c = V.tool_runs(s, d).select("run_id", F.posexplode("trajectory").alias("i", "m")).select("run_id", "i", F.posexplode("m.tool_calls").alias("j", "c"))
    return c.select("run_id", "i", "j", "c.function.name", X.valid_json(F.col("c.function.arguments")).alias("valid"))


def errors(s: SparkSession, d: str) -> DataFrame:
    m = V.tool_runs(s, d).select("run_id", F.posexplode("trajectory").alias("i", "m")).where("m.role = 'tool'")
    return m.select("run_id", "i", F.coalesce(F.get_json_object("m.content", "$.error"), F.lit("")).alias("error"))


QUERIES = {
    "qa_normalize": lambda s, d: table(s, d, "eval_items").select("item_id", X.normalized_answer(F.col("question")).alias("x")),
    "answer_extract": lambda s, d: contents(s, d).select("rollout_id", X.marked_answer(F.col("c")).alias("answer")).where("answer is not null"),
    "gsm8k_answer": lambda s, d: contents(s, d).select("rollout_id", X.hash_answer(F.col("c")).alias("answer")).where("answer is not null"),
    "boxed_answer": lambda s, d: contents(s, d).where(F.col("c").contains("\\boxed")).select("rollout_id", grading.boxed_udf("c").alias("answer")),
    "tool_name_sanitize": lambda s, d: table(s, d, "mcp_servers").select("server_key", F.posexplode("tools").alias("pos", "t")).select("server_key", "pos", X.tool_name(F.concat(F.lit("7-"), F.col("t"), F.lit("."))).alias("name")),
    "hhh_parse": hhh,
    "guess_feedback": guesses,
    "format_reward": lambda s, d: contents(s, d).select("rollout_id", F.round(X.format_reward(F.col("c").contains("Answer"), F.col("c").contains(":")), 6).alias("reward")),
    "numeric_predicates": numbers,
    "repr_truncate": lambda s, d: contents(s, d).select("rollout_id", X.shortened(F.col("c")).alias("x")),
    "html_to_text": pages,
    "json_args_parse": arguments,
    "json_error_flag": errors,
    "question_extract": lambda s, d: table(s, d, "mcp_servers").where("generated_questions is not null").select("server_key", F.posexplode(X.questions(F.array_join(F.transform("generated_questions", lambda q: F.concat(F.lit("<question> "), q, F.lit(" </question>"))), "\n"))).alias("pos", "question")),
    "stop_split": lambda s, d: contents(s, d).select("rollout_id", F.md5(X.split_at_stop(F.col("c"), "\n\n")[0]).alias("text_md5"), X.split_at_stop(F.col("c"), "\n\n")[1].alias("ended")),
}
_C = f"(SELECT rollout_id, coalesce(content, '') AS c, coalesce(prompt, '') AS p FROM {V.ROLLOUTS})"
_S = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
ORACLE = {
    "qa_normalize": "SELECT item_id, array_to_string(list_filter(regexp_split_to_array(regexp_replace(lower(question), '[!-/:-@\\[-`{-~]', '', 'g'), '\\s+'), lambda w: w NOT IN ('', 'a', 'an', 'the')), ' ') AS x FROM eval_items",
    "answer_extract": f"SELECT rollout_id, {_S.format("string_split(c, 'Answer:')[2]")} AS answer FROM {_C} WHERE len(string_split(c, 'Answer:')) = 2",
    "gsm8k_answer": f"SELECT rollout_id, {_S.format("replace(regexp_replace(" + _S.format("l[5:]") + ", '^:', ''), ',', '')")} AS answer FROM (SELECT rollout_id, list_filter(list_transform(string_split(c, chr(10)), lambda y: {_S.format('y')}), lambda y: starts_with(y, '####'))[-1] AS l FROM {_C}) WHERE l IS NOT NULL",
    "boxed_answer": f"SELECT rollout_id, regexp_extract(c, '.*\\\\boxed\\{{([^{{}}]*)\\}}', 1, 's') AS answer FROM {_C} WHERE contains(c, '\\boxed')",
    "tool_name_sanitize": "SELECT server_key, pos::INT AS pos, 'tool_' || regexp_replace(regexp_replace('7-' || t || '.', '[^0-9A-Za-z]', '_', 'g'), '^_+|_+$', '', 'g') AS name FROM (SELECT server_key, unnest(range(len(tools))) AS pos, unnest(tools) AS t FROM mcp_servers)",
    "hhh_parse": f"SELECT rollout_id, 0 AS pos, 'user' AS role, md5({_S.format('p')}) AS content_md5 FROM {_C} UNION ALL SELECT rollout_id, 1, 'assistant', md5({_S.format('c')}) FROM {_C}",
    "guess_feedback": f"SELECT item_id, CASE WHEN item_id % 7 = 0 THEN 'Please write Guess: and a number.' WHEN n = 25 THEN 'Correct' WHEN n > 25 THEN 'Too high' ELSE 'Too low' END AS feedback FROM (SELECT item_id, {V.h7_sql("'g:' || item_id")} % 50 AS n FROM eval_items)",
    "format_reward": f"SELECT rollout_id, round(contains(c, 'Answer')::INT::DOUBLE + 0.1::DOUBLE * (contains(c, ':')::INT::DOUBLE - 1), 6) AS reward FROM {_C}",
    "numeric_predicates": "SELECT item_id, regexp_matches(answer, '^\\s*-?\\d{1,3}(,\\d{3})*\\s*$|^\\s*-?\\d+\\s*$') AS is_int, regexp_matches(answer, '^\\s*[-+]?(\\d+\\.?\\d*|\\.\\d+)([eE][-+]?\\d+)?\\s*$') AS is_float, regexp_matches(answer || '/3', '^-?\\d+/0*[1-9]\\d*$') AS is_fraction FROM eval_items",
    "repr_truncate": f"SELECT rollout_id, CASE WHEN length(c) > 256 THEN left(c, 128) || ' ... ' || right(c, 128) ELSE c END AS x FROM {_C}",
    "html_to_text": f"SELECT conv_id, turn, md5(array_to_string(list_filter(regexp_split_to_array('t ' || text, '\\s+'), lambda w: w <> ''), ' ')) AS text_md5 FROM {V.MESSAGES} WHERE role = 'user'",
    "json_args_parse": f"SELECT run_id, i::INT AS i, j::INT AS j, c.function.name AS name, coalesce(json_valid(c.function.arguments), false) AS valid FROM (SELECT run_id, i, unnest(range(len(m.tool_calls))) AS j, unnest(m.tool_calls) AS c FROM (SELECT run_id, unnest(range(len(trajectory))) AS i, unnest(trajectory) AS m FROM {V.TOOL_RUNS}))",
    "json_error_flag": f"SELECT run_id, i::INT AS i, coalesce(CASE WHEN json_valid(m.content) THEN json_extract_string(m.content, '$.error') END, '') AS error FROM (SELECT run_id, unnest(range(len(trajectory))) AS i, unnest(trajectory) AS m FROM {V.TOOL_RUNS}) WHERE m.role = 'tool'",
    "question_extract": f"SELECT server_key, (row_number() OVER (PARTITION BY server_key ORDER BY i) - 1)::INT AS pos, question FROM (SELECT server_key, i, {_S.format('q')} AS question FROM (SELECT server_key, unnest(range(len(generated_questions))) AS i, unnest(generated_questions) AS q FROM mcp_servers WHERE generated_questions IS NOT NULL)) WHERE question <> ''",
    "stop_split": f"SELECT rollout_id, CASE WHEN len(x) <= 2 THEN md5({_S.format('x[1]')}) END AS text_md5, len(x) = 2 AS ended FROM (SELECT rollout_id, string_split(c, chr(10) || chr(10)) AS x FROM {_C})",
}
