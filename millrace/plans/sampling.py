"""Queries on prompts: extraction, samples, splits, batches, sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sampling as S
from ..session import table
from ..sources import views as V

#: Pieces that are united, and one of all other rows.
PIECES = ("en", "de", "fr", "es")
SYSTEM_PROMPTS = ("You are a careful assistant.", "Answer briefly.", "Think step by step.")


def docs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select("doc_id", "source", "lang", "n_chars")


def arithmetic(s: SparkSession, d: str) -> DataFrame:
    """A generator: problems from hashes of their index."""
    x = lambda salt: V.h7(V.text_of(salt, F.col("id"))) % 101
    return s.range(1000).select("id", x("x:").alias("x"), x("y:").alias("y")).select("id", V.text_of("What is ", F.col("x"), " + ", F.col("y"), "?").alias("question"), (F.col("x") + F.col("y")).alias("answer"))


def composite(s: SparkSession, d: str) -> DataFrame:
    """Step by step the batches of two datasets side by side, as many steps as the shorter has."""
    p = S.batches(V.prompts(s, d).select(F.col("conv_id").alias("id")), "id", 32, drop_last=True).withColumn("dataset", F.lit(0))
    r = S.batches(V.rollouts(s, d).select(F.col("rollout_id").alias("id")), "id", 64, drop_last=True).withColumn("dataset", F.lit(1))
    both = p.unionByName(r)
    last = both.groupBy("dataset").agg(F.max("batch").alias("m")).agg(F.min("m").alias("last"))
    return both.join(F.broadcast(last)).where("batch <= last").groupBy("batch", "dataset").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))


QUERIES = {
    "prompt_extract": lambda s, d: V.prompts(s, d),
    "prompt_sample_md5": lambda s, d: S.sample(V.prompts(s, d), "conv_id", 100),
    "prompt_limit_after_filter": lambda s, d: S.first_n(V.prompts(s, d).where(F.length("prompt") >= 200), "conv_id", 50),
    "system_prompt_choice": lambda s, d: V.prompts(s, d).select("conv_id", F.element_at(F.array(*map(F.lit, SYSTEM_PROMPTS)), (V.h7(F.col("conv_id").cast("string")) % 3 + 1).cast("int")).alias("system_prompt")),
    "split_slice": lambda s, d: S.sliced(V.prompts(s, d), "conv_id", 128, 256),
    "train_test_split": lambda s, d: S.split(V.prompts(s, d), "conv_id", 100, "split:").select("conv_id", "part"),
    "stratified_sample": lambda s, d: S.stratified(docs(s, d), "source", "doc_id", 5).select("source", "doc_id"),
    "batch_assign_ceil": lambda s, d: S.batches(docs(s, d), "doc_id", 64).groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last_id")),
    "batch_assign_drop_last": lambda s, d: S.batches(docs(s, d), "doc_id", 64, True).groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last_id")),
    "split_even": lambda s, d: S.even_chunks(docs(s, d), "doc_id", 7).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")),
    "linspace_representatives": lambda s, d: S.representatives(docs(s, d), "n_chars", "doc_id", 11).select("idx", "doc_id", "n_chars"),
    "group_replicate": lambda s, d: S.replicated(V.prompts(s, d).select("conv_id"), 4, "env"),
    "repeat_epochs": lambda s, d: S.replicated(table(s, d, "eval_items").select("item_id"), 3, "epoch"),
    "composite_batches": composite,
    "union_pieces": lambda s, d: reduce(DataFrame.unionByName, [docs(s, d).where(F.lower("lang") == x).select("doc_id", F.lit(x).alias("piece")) for x in PIECES] + [docs(s, d).where(F.coalesce(~F.lower("lang").isin(*PIECES), F.lit(True))).select("doc_id", F.lit("other").alias("piece"))]),
    "except_sets": lambda s, d: table(s, d, "jobs").select("job_id").subtract(V.rollouts(s, d).select("job_id")),
    "arithmetic_source": arithmetic,
}
_HASH = "md5({0}::VARCHAR), {0}"
ORACLE = {
    "prompt_extract": f"SELECT * FROM {V.PROMPTS}",
    "prompt_sample_md5": f"SELECT * FROM {V.PROMPTS} ORDER BY md5(conv_id::VARCHAR), conv_id LIMIT 100",
    "prompt_limit_after_filter": f"SELECT * FROM {V.PROMPTS} WHERE length(prompt) >= 200 ORDER BY conv_id LIMIT 50",
    "system_prompt_choice": f"SELECT conv_id, [{', '.join(repr(x) for x in SYSTEM_PROMPTS)}][{V.h7_sql('conv_id::VARCHAR')} % 3 + 1] AS system_prompt FROM {V.PROMPTS}",
    "split_slice": f"SELECT * FROM {V.PROMPTS} ORDER BY conv_id LIMIT 128 OFFSET 128",
    "train_test_split": f"SELECT conv_id, CASE WHEN count(*) OVER () > 100 AND row_number() OVER (ORDER BY md5('split:' || conv_id), conv_id) <= 100 THEN 'test' ELSE 'train' END AS part FROM {V.PROMPTS}",
    "stratified_sample": "SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) <= 5",
    "batch_assign_ceil": "SELECT batch, count(*) AS n, max(doc_id) AS last_id FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS batch FROM documents) GROUP BY batch",
    "batch_assign_drop_last": "SELECT batch, count(*) AS n, max(doc_id) AS last_id FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS batch FROM documents) WHERE batch < (SELECT count(*) // 64 FROM documents) GROUP BY batch",
    "split_even": "SELECT chunk, count(*) AS n, min(doc_id) AS first_id FROM (SELECT doc_id, (SELECT max(c) FROM range(7) t(c) WHERE c * a // 7 <= i) AS chunk FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS a FROM documents)) GROUP BY chunk",
    "linspace_representatives": "SELECT idx, doc_id, n_chars FROM (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS idx FROM documents) WHERE idx IN (SELECT i * ((SELECT count(*) FROM documents) - 1) // 10 FROM range(11) t(i))",
    "group_replicate": f"SELECT conv_id, env::INT AS env FROM {V.PROMPTS}, range(4) t(env)",
    "repeat_epochs": "SELECT item_id, epoch::INT AS epoch FROM eval_items, range(3) t(epoch)",
    "composite_batches": f"WITH b AS (SELECT conv_id AS id, (row_number() OVER (ORDER BY conv_id) - 1) // 32 AS batch, 0 AS dataset FROM {V.PROMPTS} QUALIFY batch < count(*) OVER () // 32 UNION ALL "
    f"SELECT rollout_id, (row_number() OVER (ORDER BY rollout_id) - 1) // 64 AS batch, 1 FROM {V.ROLLOUTS} QUALIFY batch < count(*) OVER () // 64) "
    "SELECT batch, dataset, count(*) AS n, min(id) AS first_id FROM b WHERE batch <= (SELECT min(m) FROM (SELECT max(batch) AS m FROM b GROUP BY dataset)) GROUP BY batch, dataset",
    "union_pieces": "SELECT doc_id, CASE WHEN lower(lang) IN ('en', 'de', 'fr', 'es') THEN lower(lang) ELSE 'other' END AS piece FROM documents",
    "except_sets": f"SELECT job_id FROM jobs EXCEPT SELECT job_id FROM {V.ROLLOUTS}",
    "arithmetic_source": f"SELECT id, 'What is ' || x || ' + ' || y || '?' AS question, x + y AS answer FROM (SELECT id, {V.h7_sql("'x:' || id")} % 101 AS x, {V.h7_sql("'y:' || id")} % 101 AS y FROM range(1000) t(id))",
}
