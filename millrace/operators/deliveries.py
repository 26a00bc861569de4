"""Repeated deliveries: of the rows that share a record id, the one delivered last counts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Up to so many repeated ids their list is broadcast (id and position, under 100 bytes each); beyond, the join shuffles.
BROADCAST_IDS = 1_000_000


def latest_delivery(df: DataFrame, key: str, at: str = "ingested_at", broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """Keeps, for each key, the row with the largest `at`; rows without a key are dropped.

    Over files only the key, the time and the row's place in its file are aggregated (with map-side combine, so a key that
    holds a third of all rows is one partial row per task); the wide rows stay where they are unless there are more
    repeated keys than `broadcast_ids`. Ties on `at` are broken by the place in the files, a null `at` loses to any other.
    Other frames are ranked by a window.
    """
    df = df.where(F.col(key).isNotNull())
    try:
        placed = df.withColumn("_place", F.struct(F.col(at).alias("t"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r")))
    except AnalysisException:
        ranked = Window.partitionBy(key).orderBy(F.col(at).desc_nulls_last())
        return df.withColumn("_n", F.row_number().over(ranked)).where("_n = 1").drop("_n")
    again = placed.groupBy(F.col(key).alias("_key")).agg(F.max("_place").alias("_last"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    if again.limit(broadcast_ids + 1).count() <= broadcast_ids:
        again = F.broadcast(again)
    joined = placed.join(again, F.col(key) == F.col("_key"), "left")
    return joined.where(F.col("_last").isNull() | (F.col("_place") == F.col("_last"))).drop("_key", "_last", "_place")
