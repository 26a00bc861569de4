"""Queries of problem 3: broken prompt and response pairs. Tested by held-out accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.deliveries import latest_delivery
from ..session import table
from .defects import defective


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_delivery(table(spark, sf_dir, "rollouts"), "rollout_id")
    return defective(rows.select(F.col("rollout_id").alias("id"), "prompt", "content")).withColumnRenamed("id", "rollout_id")


def p3_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_found(spark, sf_dir).groupBy("defect").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {"p3_found": p3_found, "p3_kinds": p3_kinds}
ORACLE: dict[str, str] = {}
