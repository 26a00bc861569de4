"""Queries of problem 7: evaluation questions in documents. Tested against a brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from .leaks import Search, leaks

EXACT = Search(run=12)
EDITED = Search(run=12, edits=2, walks=12, samples=5)


def searched(spark: SparkSession, sf_dir: str, how: Search) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "question", how)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return searched(spark, sf_dir, EXACT).select(F.col("doc").alias("doc_id"), F.col("item").cast("int").alias("item_id"))


def p7_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also passages with up to two edited words."""
    return searched(spark, sf_dir, EDITED).select(F.col("doc").alias("doc_id"), F.col("item").cast("int").alias("item_id"), "edits")


def p7_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item with the number of documents it leaked into."""
    hits = searched(spark, sf_dir, EXACT).groupBy(F.col("item").alias("hit")).agg(F.count(F.lit(1)).alias("n"))
    items = table(spark, sf_dir, "eval_items")
    return items.join(hits, F.col("item_id") == F.col("hit"), "left").select("item_id", "suite", F.coalesce("n", F.lit(0)).alias("n_docs"))


QUERIES = {"p7_found": p7_found, "p7_edited": p7_edited, "p7_items": p7_items}
ORACLE: dict[str, str] = {}
