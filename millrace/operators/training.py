"""Arithmetic of training rows: groups of rewards, token losses, divergences, segments and alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sampling import running_total

# --- groups -----------------------------------------------------------------------------------------------------------


def centred(df: DataFrame, group: str, reward: str, name: str = "advantage") -> DataFrame:
    """reward minus its group's mean; the mean is aggregated and joined back, so a large group is no single task's."""
    mean = df.groupBy(group).agg(F.avg(reward).alias("_mean"))
    return df.join(mean, group).withColumn(name, F.col(reward) - F.col("_mean")).drop("_mean")


def varied_groups(df: DataFrame, group: str, reward: str) -> DataFrame:
    """Rows of groups whose rewards differ; if there is none, the first group's rows."""
    spread = df.groupBy(group).agg((F.min(reward) != F.max(reward)).alias("_varied"))
    any_ = spread.agg(F.coalesce(F.max(F.col("_varied").cast("int")), F.lit(0)).alias("_any"), F.min(group).alias("_first"))
    kept = spread.join(F.broadcast(any_)).where(F.col("_varied") | ((F.col("_any") == 0) & (F.col(group) == F.col("_first")))).select(group)
    return df.join(kept, group, "left_semi")


def group_fractions(df: DataFrame, group: str, reward: str, good: float = 0.5) -> DataFrame:
    """Fractions of groups that are mixed, all good (every reward at least `good`) and all bad."""
    g = df.groupBy(group).agg(F.min(reward).alias("lo"), F.max(reward).alias("hi"))
    share = lambda c: F.avg(c.cast("double"))
    return g.agg(share((F.col("lo") < good) & (F.col("hi") >= good)).alias("frac_mixed"), share(F.col("lo") >= good).alias("frac_all_good"), share(F.col("hi") < good).alias("frac_all_bad"))


def by_tag(df: DataFrame, tags: str, value: str) -> DataFrame:
    """Mean and count per tag and over all rows; a row with several tags counts in each, once in all. One pass: every row is its tags and `all`."""
    each = df.select(F.explode(F.array_union(F.coalesce(F.col(tags), F.array().cast("array<string>")), F.array(F.lit("all")))).alias("tag"), value)
    return each.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))


def best_and_worst(df: DataFrame, group: str, score: str, order: str) -> DataFrame:
    """(group, best, worst, margin): of groups whose scores differ the earliest of the best and the latest of the worst."""
    best, worst = F.struct(F.col(score), -F.col(order)), F.struct(F.col(score), -F.col(order))
    return df.groupBy(group).agg(F.max_by(order, best).alias("best"), F.min_by(order, worst).alias("worst"), (F.max(score) - F.min(score)).alias("margin")).where("margin > 0")


def matchups(df: DataFrame, group: str, index: str, item: str, chunk: int, both_ways: bool) -> DataFrame:
    """(group, a, b): pairs within runs of `chunk` members, ordered pairs if both ways; the run bounds the pairs of a member."""
    x = df.select(group, F.floor(F.col(index) / chunk).alias("_run"), F.col(index).alias("_i"), F.col(item).alias("a"))
    y = df.select(group, F.floor(F.col(index) / chunk).alias("_run"), F.col(index).alias("_j"), F.col(item).alias("b"))
    return x.join(y, [group, "_run"]).where(F.col("_i") != F.col("_j") if both_ways else F.col("_i") < F.col("_j")).select(group, "a", "b")


def tournament(pairs: DataFrame, reward: str) -> DataFrame:
    """(member, score, n): mean signed reward over a member's pairs; a reward speaks for b."""
    both = pairs.select(F.col("b").alias("member"), F.col(reward).alias("r")).unionByName(pairs.select(F.col("a").alias("member"), (-F.col(reward)).alias("r")))
    return both.groupBy("member").agg(F.avg("r").alias("score"), F.count(F.lit(1)).alias("n"))


# --- arrays of tokens -------------------------------------------------------------------------------------------------


def shifted(tokens: Column, most: int | None = None) -> tuple[Column, Column]:
    """(inputs, targets): tokens without the last and without the first, of at most `most` tokens."""
    t = F.slice(tokens, 1, most) if most else tokens
    return F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0))), F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0)))


def unmasked(n: Column, regions: Column) -> Column:
    """0/1 for each of n tokens: 1 within one of the regions (start, stop)."""
    one = lambda i: F.exists(regions, lambda r: (i >= r["start"]) & (i < r["stop"])).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(F.array().cast("array<int>"))


def train_weights(messages: Column, mode: str, tokens_of) -> Column:
    """A weight per token of the messages' contents: last_assistant, last_turn, all_assistant, all_user_system or all."""
    n = F.size(messages)

    def weight(m: Column, i: Column) -> Column:
        last = i == n - 1
        chosen = {
            "last_assistant": last,
            "all_assistant": last | (m["role"] == "assistant"),
            "all_user_system": last | m["role"].isin("user", "system"),
            "all_messages": F.lit(True),
            "none_but_last_user": last | (m["role"] == "user"),
        }[mode]
        return F.array_repeat(chosen.cast("int"), tokens_of(m))

    return F.flatten(F.transform(messages, weight))


def discounted(x: Column, gamma: float) -> Column:
    """y[t] = x[t] + gamma y[t + 1], from the end."""
    back = F.aggregate(F.reverse(x), F.array().cast("array<double>"), lambda acc, v: F.concat(acc, F.array(v + gamma * F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)))))
    return F.reverse(back)


def discounted_first(x: Column, gamma: float) -> Column:
    """The first of the discounted sums, in one pass from the end."""
    return F.when(F.size(x) > 0, F.aggregate(F.reverse(x), F.lit(0.0), lambda acc, v: v + gamma * acc))


# --- losses over token rows -------------------------------------------------------------------------------------------


def mean_nll(lp: Column, weight: Column) -> Column:
    """-sum(lp w) / sum(w); null without weight."""
    return -F.try_divide(F.sum(lp * weight), F.sum(weight))


def kl_moments(df: DataFrame, sampled: str, trained: str, mask: str) -> DataFrame:
    """Divergence of the sampling from the training model over masked tokens, first and second estimate, and the entropy."""
    d = F.col(sampled) - F.col(trained)
    m = df.where(F.col(mask) > 0)
    return m.agg(F.avg(d).alias("kl_v1"), (0.5 * F.avg(d * d)).alias("kl_v2"), (-F.avg(sampled)).alias("entropy"), F.sqrt(F.greatest(F.avg(d * d) - F.avg(d) * F.avg(d), F.lit(0.0))).alias("kl_std"), F.count(F.lit(1)).alias("n_tokens"))


def kl_penalised(df: DataFrame, sampled: str, base: str, mask: str, coef: float) -> DataFrame:
    """df with `penalty` = coef m (mean - difference); the mean over masked tokens is one row, joined back."""
    d = (F.col(sampled) - F.col(base)) * F.col(mask)
    mean = df.agg(F.try_divide(F.sum(d), F.sum(mask)).alias("_mean"))
    return df.join(F.broadcast(mean)).withColumn("penalty", coef * F.col(mask) * (F.col("_mean") - d)).drop("_mean")


def kl_penalties(df: DataFrame, key: list[str], sampled: str, base: str, mask: str, coef: float) -> DataFrame:
    """(key, penalty, n): the sum of those penalties per key. Tokens are aggregated once; the mean is taken from the keys' sums."""
    d = (F.col(sampled) - F.col(base)) * F.col(mask)
    sums = df.groupBy(*key).agg(F.sum(d).alias("_d"), F.sum(mask).alias("n"))
    mean = sums.agg(F.try_divide(F.sum("_d"), F.sum("n")).alias("_mean"))
    return sums.join(F.broadcast(mean)).withColumn("penalty", coef * (F.col("_mean") * F.col("n") - F.col("_d"))).select(*key, "penalty", "n")


def stopped(df: DataFrame, order: str, tokens: str, budget: int) -> DataFrame:
    """Rows in order up to the one that reaches the budget, with the running sum; no task sees all rows."""
    return running_total(df, [F.col(order)], tokens).where(F.col("running") - F.col(tokens) < budget)


def segments(df: DataFrame, key: str, turn: str, seen: str, full: str) -> DataFrame:
    """df with `segment`, from 1: a turn whose observation starts with all that was there before it continues the segment."""
    w = Window.partitionBy(key).orderBy(turn)
    before = F.lag(full).over(w)
    breaks = F.when(before.isNull() | (F.slice(F.col(seen), 1, F.size(before)) != before), 1).otherwise(0)
    return df.withColumn("_break", breaks).withColumn("segment", F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_break")


def aligned(left: DataFrame, right: DataFrame, key: list[str], lp_left: str, lp_right: str) -> DataFrame:
    """(key, stop, n_left, n_right, delta): groups of pieces of two cuttings of one text between common boundaries.

    Both sides hold (key, pos, piece, log-probability) in order. Boundaries are the running lengths; those of both sides are joined on
    equality, and every piece belongs to the first common boundary at or after its end. What follows the last one is in no group.
    """

    def ended(df: DataFrame, lp: str) -> DataFrame:
        w = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
        return df.select(*key, "pos", F.col(lp).alias("lp"), F.sum(F.length("piece")).over(w).alias("stop"))

    def grouped(df: DataFrame, n: str, total: str) -> DataFrame:
        w = Window.partitionBy(*key).orderBy("stop").rowsBetween(0, Window.unboundedFollowing)
        own = df.join(common, [*key, "stop"], "left").withColumn("group", F.first(F.when(F.col("_c").isNotNull(), F.col("stop")), ignorenulls=True).over(w))
        return own.where("group is not null").groupBy(*key, "group").agg(F.count(F.lit(1)).alias(n), F.sum("lp").alias(total))

    x, y = ended(left, lp_left), ended(right, lp_right)
    common = x.select(*key, "stop").join(y.select(*key, "stop"), [*key, "stop"]).distinct().withColumn("_c", F.lit(1))
    both = grouped(x, "n_left", "sum_left").join(grouped(y, "n_right", "sum_right"), [*key, "group"])
    return both.select(*key, F.col("group").alias("stop"), "n_left", "n_right", (F.col("sum_left") - F.col("sum_right")).alias("delta"))


def aligned_within(df: DataFrame, key: list[str], n_left: str, lp_left: str, n_right: str, lp_right: str) -> DataFrame:
    """The groups of `aligned` where both cuttings are in one row, as arrays of the pieces' lengths and of their log-probabilities: one pass, no piece is shuffled."""
    fields = [(f.name, f.dataType.simpleString()) for f in df.select(*key).schema.fields]
    columns = [*key, n_left, lp_left, n_right, lp_right]

    def ended(n: pa.Array, lp: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row and running length, in one number; log-probability) of the pieces that aren't empty."""
        size = pc.fill_null(pc.list_value_length(n), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        row, total = np.repeat(np.arange(len(size)), size), np.concatenate([[0], np.cumsum(n.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)])
        first = total[np.cumsum(size) - size]
        some = np.diff(total) > 0
        return ((row << 32) + total[1:] - first[row])[some], lp.flatten().to_numpy(zero_copy_only=False)[some]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, lx), (y, ly) = (ended(batch.column(n), batch.column(lp)) for n, lp in ((n_left, lp_left), (n_right, lp_right)))
            common = np.intersect1d(x, y, assume_unique=True)
            sums = []
            for own, lp in ((x, lx), (y, ly)):
                at = np.searchsorted(common, own)
                inside = np.flatnonzero(at < len(common))
                inside = inside[common[at[inside]] >> 32 == own[inside] >> 32]
                sums.append((np.bincount(at[inside], minlength=len(common)), np.bincount(at[inside], weights=lp[inside], minlength=len(common))))
            (nx, sx), (ny, sy) = sums
            row = pa.array(common >> 32)
            out = [*(batch.column(c).take(row) for c in key), pa.array(common & 0xFFFFFFFF), pa.array(nx.astype(np.int64)), pa.array(ny.astype(np.int64)), pa.array(sx - sy)]
            yield pa.RecordBatch.from_arrays(out, names=[*key, "stop", "n_left", "n_right", "delta"])

    schema = ", ".join(f"`{c}` {t}" for c, t in [*fields, ("stop", "bigint"), ("n_left", "bigint"), ("n_right", "bigint"), ("delta", "double")])
    return df.select(*columns).mapInArrow(run, schema)
