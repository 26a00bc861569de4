"""Queries of problem 2: groups of near-equal rollouts. Tested against a brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.deliveries import latest_delivery
from ..session import table
from . import similar


def grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_delivery(table(spark, sf_dir, "rollouts"), "rollout_id")
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return similar.groups(rows.select(F.col("rollout_id").alias("id"), F.concat(blank("prompt"), F.lit(" "), blank("content")).alias("text")))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.pairs_of(grouped(spark, sf_dir)).select(F.col("a").alias("rollout_a"), F.col("b").alias("rollout_b"))


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rollout of a group with the group's least id and its size."""
    g = grouped(spark, sf_dir)
    sizes = g.groupBy("group").agg(F.count(F.lit(1)).alias("n_members"))
    return g.join(sizes, "group").select(F.col("id").alias("rollout_id"), F.col("group").alias("group_id"), "n_members")


QUERIES = {"p2_found": p2_found, "p2_groups": p2_groups}
ORACLE: dict[str, str] = {}
