"""Logs of events, in batch and as streams: offsets, ring buffers, cursors, staleness, count windows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import numbered_within

#: Events that a job's buffer keeps.
RING = 200


def offsets(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """events with `offset`, from 0 within each key."""
    return numbered_within(events, key, [F.col(c) for c in order], "offset")


def ring(events: DataFrame, key: str, offset: str, size: int = RING) -> DataFrame:
    """The newest `size` events of each key. The newest offset is aggregated and joined back, so a key of any size is spread over tasks."""
    last = events.groupBy(key).agg(F.max(offset).alias("_last"))
    return events.join(last, key).where(F.col(offset) > F.col("_last") - size).drop("_last")


def since(events: DataFrame, key: str, offset: str, cursor: int, size: int = RING) -> DataFrame:
    """(key, n, next, truncated): what a reader at the cursor gets from the buffer; truncated if the buffer begins after it."""
    kept = ring(events, key, offset, size)
    return kept.groupBy(key).agg(F.count(F.when(F.col(offset) >= cursor, 1)).alias("n"), (F.max(offset) + 1).alias("next"), (F.min(offset) > cursor).alias("truncated"))


def fresh(groups: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(kept, requeued): groups whose sample is at most `most` steps old, and the others, which go back to the queue."""
    late = F.col("step") - F.col("sampler_step") > most
    return groups.where(~late), groups.where(late)


def windowed(stream: DataFrame, at: str, length: str, late: str, *by: str) -> DataFrame:
    """Counts and sums per window of event time, with a watermark: the same frame in batch and as a stream."""
    timed = stream.withColumn("_at", F.col(at).cast("timestamp"))
    return timed.withWatermark("_at", late).groupBy(F.window("_at", length), *by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), *by, "n", "total")


def count_windows(stream: DataFrame, key: str, item: str, size: int) -> DataFrame:
    """A row (key, batch, first, n) whenever `size` items of a key have come in; an incomplete rest is kept in the state."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        batch, kept = (state.get[0], list(state.get[1])) if state.exists else (0, [])
        out = []
        for f in frames:
            kept += f[item].sort_values().tolist()
            while len(kept) >= size:
                out.append((k[0], batch, kept[0], size))
                kept, batch = kept[size:], batch + 1
        state.update((batch, kept))
        yield pd.DataFrame(out, columns=["key", "batch", "first", "n"])

    return stream.groupBy(key).applyInPandasWithState(step, "key string, batch bigint, first bigint, n bigint", "batch bigint, kept array<bigint>", "append", "NoTimeout")
