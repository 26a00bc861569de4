"""Arrays of tokens, log-probabilities and masks, as column expressions; and the schedules of training."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(lp: Column, mask: Column) -> Column:
    """Null log-probabilities of masked tokens as zero; others stay null."""
    return F.zip_with(lp, mask, lambda x, m: F.when(x.isNull() & (m == 0), F.lit(0.0)).otherwise(x))


def consistent(tokens: Column, *others: Column) -> Column:
    """More than one token, and as many of everything else."""
    ok = F.size(tokens) > 1
    for o in others:
        ok = ok & (F.size(o) == F.size(tokens))
    return F.coalesce(ok, F.lit(False))


def completion(tokens: Column, mask: Column) -> Column:
    """The tokens that are trained on."""
    return F.transform(F.filter(F.arrays_zip(tokens.alias("t"), mask.alias("m")), lambda x: x["m"] > 0), lambda x: x["t"])


def trained_span(values: Column, mask: Column) -> Column:
    """The values between the first and the last 1 of the mask, empty if there is none."""
    first, back = F.array_position(mask, 1), F.array_position(F.reverse(mask), 1)
    n = F.size(mask) - first - back + 2
    return F.when(first > 0, F.slice(values, F.greatest(first, F.lit(1)).cast("int"), F.greatest(n, F.lit(0)).cast("int"))).otherwise(F.slice(values, 1, 0))


def first_difference(a: Column, b: Column) -> Column:
    """Index, from 0, at which two sequences first differ or one ends; null if they are equal."""
    n = F.greatest(F.size(a), F.size(b))
    at = F.array_min(F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i))))
    return F.when(n > 0, at)


def starts_with(a: Column, b: Column) -> Column:
    """Whether b begins with a."""
    return F.slice(b, 1, F.size(a)) == a


def truncated(text: Column, most: int) -> Column:
    """The first `most` words of a prompt; a feature of prompts for models with a limit."""
    return F.array_join(F.slice(F.filter(F.split(text, r"\s+"), lambda w: w != ""), 1, most), " ")


def learning_rate(step: Column, total: int, kind: str = "linear") -> Column:
    """Multiplier of a schedule, never below zero."""
    return F.greatest(F.lit(0.0), 1 - step / total) if kind == "linear" else F.lit(1.0)


def batch_size(n: Column, requested: Column, workers: int) -> Column:
    """The requested size or four a worker, between 1 and n."""
    return F.greatest(F.lit(1), F.least(F.coalesce(requested, F.lit(4 * workers)), n))


def backoff(attempt: Column, base: float = 1.0, factor: float = 1.5, most: float = 30.0) -> Column:
    """Seconds before an attempt."""
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(factor), attempt))


def adapter_parameters(rows: Column, cols: Column, rank: int) -> Column:
    """Parameters of a low-rank adapter of a matrix."""
    return (rows + cols) * rank
