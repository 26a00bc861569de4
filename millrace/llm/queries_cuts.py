"""Queries of problem 1: texts stored cut off. Tested on texts cut for the purpose."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.deliveries import latest_delivery
from ..session import keep, table
from .cuts import cut_texts


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tab, source, rec_id, msg_pos, role, text) of all contents."""
    r = latest_delivery(table(spark, sf_dir, "rollouts"), "rollout_id")
    c = latest_delivery(table(spark, sf_dir, "chats"), "chat_id").select("chat_id", "source", F.posexplode("messages").alias("msg_pos", "m"))
    r = r.select(F.lit("rollouts").alias("tab"), "source", F.col("rollout_id").alias("rec_id"), F.lit(-1).alias("msg_pos"), F.lit("assistant").alias("role"), F.col("content").alias("text"))
    return r.unionByName(c.select(F.lit("chats").alias("tab"), "source", F.col("chat_id").alias("rec_id"), "msg_pos", F.col("m.role").alias("role"), F.col("m.content").alias("text")))


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """texts() with their ids, written once: what finds the last deliveries is broadcast for that, not for each pass over the texts."""
    return keep(texts(spark, sf_dir).withColumn("id", F.xxhash64("tab", "rec_id", "msg_pos")))


def found(every: DataFrame) -> DataFrame:
    return keep(cut_texts(every.select("id", "role", "text")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = marked(spark, sf_dir)
    return every.select("tab", "rec_id", "msg_pos", "id").join(found(every), "id", "left_semi").drop("id")


def p1_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each source the share of its texts that are cut; blank texts don't count."""
    every = marked(spark, sf_dir)
    cut = found(every).withColumn("cut", F.lit(1))
    own = every.where(F.col("text").rlike(r"\S")).select("source", "id").join(cut, "id", "left")
    return own.groupBy("source").agg(F.count(F.lit(1)).alias("n_texts"), F.count("cut").alias("n_cut"), F.round(F.count("cut") / F.count(F.lit(1)), 6).alias("share"))


QUERIES = {"p1_found": p1_found, "p1_sources": p1_sources}
ORACLE: dict[str, str] = {}
