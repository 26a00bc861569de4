"""Queries of problem 4: residue in chats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.deliveries import latest_delivery
from ..session import table
from .residue import residue


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_delivery(table(spark, sf_dir, "chats"), "chat_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue(chats(spark, sf_dir), "chat_id", "messages").select(F.col("rec").alias("chat_id"), F.col("pos").alias("msg_pos"))


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that are left for training."""
    every = chats(spark, sf_dir).select("chat_id", F.posexplode("messages").alias("msg_pos", "m"))
    return every.select("chat_id", "msg_pos", F.col("m.role").alias("role"), F.col("m.content").alias("content")).join(p4_found(spark, sf_dir), ["chat_id", "msg_pos"], "left_anti")


QUERIES = {"p4_found": p4_found, "p4_clean": p4_clean}
ORACLE: dict[str, str] = {}
