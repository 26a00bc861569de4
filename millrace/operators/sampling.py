"""Limits, samples, splits and batches that any engine reproduces: ranks come from a hash of the key, never from a random stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import keep


def hash_order(key: str, salt: str = "") -> list[Column]:
    """Order of a seeded shuffle: md5 of the salted key, then the key."""
    return [F.md5(F.concat(F.lit(salt), F.col(key).cast("string"))), F.col(key)]


def sample(df: DataFrame, key: str, n: int, salt: str = "") -> DataFrame:
    """n rows drawn without replacement; a top-n, so nothing but n rows a task is shuffled."""
    return df.orderBy(*hash_order(key, salt)).limit(n)


def first_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first n rows that are left after the filters before; only surviving rows count."""
    return df.orderBy(key).limit(n)


def sliced(df: DataFrame, key: str, start: int, stop: int) -> DataFrame:
    """Rows [start, stop) in the order of key."""
    return df.orderBy(key).offset(start).limit(max(0, stop - start))


def placed(df: DataFrame, order: list[Column], parts: int) -> DataFrame:
    """df in a global order with `_part`, the range a row is in, and `_n`, its number there. Written once: ranges come from a sample, so
    what is taken from two runs of the same exchange doesn't fit together."""
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    at = F.col("_id")
    return keep(ranged).withColumn("_part", F.shiftright(at, 33).cast("int")).withColumn("_n", at.bitwiseAND(F.lit((1 << 33) - 1))).drop("_id")


def numbered(df: DataFrame, order: list[Column], name: str = "idx", parts: int = 64) -> DataFrame:
    """A dense number from 0 in a global order, without a single task that sees all rows.

    Rows are range-partitioned and numbered within their range; the ranges' sizes, one row each, are summed and joined back.
    """
    local = placed(df, order, parts)
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_c"))
    before = F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # at most `parts` rows
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return local.join(F.broadcast(starts), "_part").withColumn(name, F.col("_n") + F.col("_start")).drop("_part", "_n", "_start")


def numbered_within(df: DataFrame, key: str, order: list[Column], name: str = "idx", parts: int = 64) -> DataFrame:
    """A dense number from 0 within each key. Rows are partitioned by ranges of key and order, so a hot key spans several tasks; the
    sizes of its parts, a row each, are summed."""
    local = placed(df, [F.col(key), *order], parts)
    sizes = local.groupBy(F.col("_part").alias("_p"), F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_c"), F.min("_n").alias("_first"))
    before = F.sum("_c").over(Window.partitionBy("_key").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_p", "_key", "_first", F.coalesce(before, F.lit(0)).alias("_start"))
    joined = local.join(starts, (F.col("_part") == F.col("_p")) & F.col(key).eqNullSafe(F.col("_key")))
    return joined.withColumn(name, F.col("_n") - F.col("_first") + F.col("_start")).drop("_part", "_n", "_start", "_first", "_p", "_key")


def running_total(df: DataFrame, order: list[Column], value: str, name: str = "running", parts: int = 64) -> DataFrame:
    """The sum of value up to and with each row in a global order, by the same way: sums within ranges, the ranges' sums joined back."""
    ranged = placed(df, order, parts)
    own = Window.partitionBy("_part").orderBy("_n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_sum", F.sum(value).over(own))
    sums = ranged.groupBy("_part").agg(F.sum(value).alias("_c"))
    before = F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # at most `parts` rows
    starts = sums.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return local.join(F.broadcast(starts), "_part").withColumn(name, F.col("_sum") + F.col("_start")).drop("_part", "_n", "_sum", "_start")


def ordered_numbers(df: DataFrame, key: str, name: str = "idx") -> DataFrame:
    return numbered(df, [F.col(key)], name)


def split(df: DataFrame, key: str, test_size: int, salt: str = "") -> DataFrame:
    """df with `part`: the first test_size rows of a seeded shuffle are the test part, all are training rows if there aren't more."""
    total = df.groupBy().agg(F.count(F.lit(1)).alias("_all"))
    test = sample(df, key, test_size, salt).select(F.col(key).alias("_key"), F.lit(1).alias("_test"))
    joined = df.join(test, F.col(key) == F.col("_key"), "left").join(F.broadcast(total))
    return joined.withColumn("part", F.when(F.col("_test").isNotNull() & (F.col("_all") > test_size), "test").otherwise("train")).drop("_key", "_test", "_all")


def stratified(df: DataFrame, by: str, key: str, n: int, salt: str = "", parts: int = 32) -> DataFrame:
    """At most n rows of every stratum, all if fewer; ranked in salted parts first, so that a large stratum isn't one task's."""
    order = hash_order(key, salt)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(parts)))
    few = salted.withColumn("_n", F.row_number().over(Window.partitionBy(by, "_salt").orderBy(*order))).where(F.col("_n") <= n)
    return few.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_n") <= n).drop("_n", "_salt")


def batches(df: DataFrame, key: str, size: int, drop_last: bool = False) -> DataFrame:
    """df with `batch`, floor(index / size) in the order of key; a last batch that isn't full may be dropped."""
    own = ordered_numbers(df, key, "_i").withColumn("batch", F.floor(F.col("_i") / size))
    if drop_last:
        full = df.groupBy().agg(F.floor(F.count(F.lit(1)) / size).alias("_full"))
        own = own.join(F.broadcast(full)).where("batch < _full").drop("_full")
    return own.drop("_i")


def even_chunks(df: DataFrame, key: str, chunks: int) -> DataFrame:
    """df with `chunk`: chunk i holds the indices from floor(i n / chunks) to floor((i + 1) n / chunks)."""
    total = df.groupBy().agg(F.count(F.lit(1)).alias("_all"))
    own = ordered_numbers(df, key, "_i").join(F.broadcast(total))
    # the largest c with floor(c n / chunks) <= i
    return own.withColumn("chunk", F.floor((F.col("_i") * chunks + chunks - 1) / F.col("_all"))).withColumn(
        "chunk", F.when(F.floor(F.col("chunk") * F.col("_all") / chunks) > F.col("_i"), F.col("chunk") - 1).otherwise(F.col("chunk"))
    ).drop("_i", "_all")


def representatives(df: DataFrame, score: str, key: str, n: int) -> DataFrame:
    """n rows evenly spaced over the order of the score, the ends included: index floor(i (rows - 1) / (n - 1))."""
    total = df.groupBy().agg(F.count(F.lit(1)).alias("_all"))
    wanted = df.sparkSession.range(n).join(F.broadcast(total)).select(F.floor(F.col("id") * (F.col("_all") - 1) / max(1, n - 1)).alias("idx")).distinct()
    return numbered(df, [F.col(score), F.col(key)], "idx").join(F.broadcast(wanted), "idx")


def replicated(df: DataFrame, times: int, name: str = "copy") -> DataFrame:
    """Every row `times` times with the copy's number; none if times < 1."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(times - 1)))) if times >= 1 else df.withColumn(name, F.lit(0)).limit(0)
