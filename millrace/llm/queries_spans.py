"""Queries of problem 8: long exact spans shared between documents. Tested against a brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import spans

SPAN = 400


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_spans(table(spark, sf_dir, "documents"), "doc_id", "text", SPAN).withColumnRenamed("id", "doc_id")


def p8_shared_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = spans.shared_part(docs, spans.shared_spans(docs, "doc_id", "text", SPAN), "doc_id", "text")
    share = F.coalesce(F.try_divide(F.col("n_shared"), F.col("n_chars")), F.lit(0.0))
    return part.select(F.col("id").alias("doc_id"), "n_chars", "n_shared", "n_spans", F.round(share, 6).alias("share"))


QUERIES = {"p8_found": p8_found, "p8_shared_part": p8_shared_part}
ORACLE: dict[str, str] = {}
