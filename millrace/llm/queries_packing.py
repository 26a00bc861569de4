"""Queries of problem 6: documents packed into sequences. Tested by invariants and against a brute force on small inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import packing


def inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    limits = table(spark, sf_dir, "seq_limits").select("limit_id", F.col("max_tokens").cast("bigint").alias("capacity"))
    return packing.counted(table(spark, sf_dir, "documents"), "doc_id", "text"), limits


def packed(method: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return packing.pack(*inputs(spark, sf_dir), method=method).withColumnRenamed("id", "doc_id")

    return query


def p6_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of the room both methods use."""
    counts, limits = inputs(spark, sf_dir)
    parts = [packing.use(packing.pack(counts, limits, method=m), limits).withColumn("method", F.lit(m)) for m in ("harmonic", "planned")]
    return parts[0].unionByName(parts[1])


QUERIES = {"p6_pack": packed("planned"), "p6_harmonic": packed("harmonic"), "p6_use": p6_use}
ORACLE: dict[str, str] = {}
