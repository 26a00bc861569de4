"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import keep


def components(links: DataFrame) -> DataFrame:
    """(id, comp) for every end of links (a, b): comp is the least id that can be reached.

    Alternating large and small stars: each round links every node to the least of its neighbourhood, in a number of
    rounds that grows with the logarithm of the longest path. Minima are pre-aggregated before they are shuffled, and
    rounds are cut through tables in the shared folder and go on until nothing changes; nothing is read to the driver but whether a round changed anything.
    """
    edges = keep(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select("u", F.col("m").alias("v")).union(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        edges = keep(small)
        # done when every node has one link and no target has one itself
        open_ends = edges.select(F.col("v").alias("u")).distinct().join(edges, "u", "left_semi")
        if edges.groupBy("u").count().where("count > 1").limit(1).count() == 0 and open_ends.limit(1).count() == 0:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())


def linked(met: DataFrame, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Verified links (a, b) that hold together whatever shares a bucket and verifies, from met (key, id, first, n).

    The members of a bucket are first compared with its first one, which is linear; then those of different components
    with each other. `verify` keeps the pairs (a, b) that are links.
    """
    links = keep(verify(met.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()).select("a", "b"))
    comps = components(links)
    left = met.where("n > 2").join(comps, "id", "left").select("key", "id", "first", F.coalesce("comp", "id").alias("comp"))
    several = left.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
    left = keep(left.join(several, "key", "left_semi"))
    x = left.select("key", F.col("id").alias("a"), F.col("comp").alias("ca"), "first")
    y = left.select("key", F.col("id").alias("b"), F.col("comp").alias("cb"))
    rest = x.join(y, "key").where("a < b and ca <> cb and a <> first and b <> first").select("a", "b").distinct()
    return links.union(verify(rest).select("a", "b"))


#: One row in so many tells which keys are hot; a key is hot from so many sampled rows on.
SAMPLED, HOT = 97, 20
#: Hot keys, which are broadcast with their least id and number (24 bytes each): under 1 / HOT of a sample's postings by definition; more are handled as the others.
MOST_HOT = 100_000


def buckets(postings: DataFrame, sample: DataFrame) -> DataFrame:
    """(key, id, first, n): the postings (key, id) of every key that has several, with the least id and the number.

    Keys are grouped by a window, but for hot ones: those are aggregated where they are, their least ids broadcast and joined, so that no
    task sees all rows of a hot key. sample holds the keys of one row in SAMPLED; it decides on the way only, not on the result.
    """
    spark = postings.sparkSession
    hot = sample.groupBy("key").count().where(F.col("count") >= HOT).select("key").limit(MOST_HOT).collect()
    own = Window.partitionBy("key")
    if not hot:
        met = postings.withColumn("first", F.min("id").over(own)).withColumn("n", F.count(F.lit(1)).over(own))
        return met.where("n > 1")
    keys = spark.createDataFrame(hot, "key bigint")
    cold = postings.join(F.broadcast(keys), "key", "left_anti").withColumn("first", F.min("id").over(own)).withColumn("n", F.count(F.lit(1)).over(own))
    warm = postings.join(F.broadcast(keys), "key", "left_semi")
    least = warm.groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    return cold.where("n > 1").unionByName(warm.join(F.broadcast(least), "key").where("n > 1"))
