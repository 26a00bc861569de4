"""Long exact spans shared between records.

Compact windows: every stretch of `span` characters has a token (a run of `gram` characters) with the smallest hash; the
stretches of a text that share that token form one compact window, the node of the Cartesian tree over the token hashes
that still holds `span` characters. Equal stretches of two texts have the same smallest token at the same place, so one hash
function finds all of them: windows are joined on that token's hash, and two windows are compared where they overlap.

- windows of equal text (hash of the window, the token and the place) are one class; a class from two records is shared as
  a whole. Classes are aggregated before anything is compared, so copies cost one row each however many they are;
- of the other classes every start is looked up by the hash of its `span` characters and its place relative to the
  token: within a task while a token has few classes (`few`), by a shuffle beyond, which spreads a hot token over all tasks.
  Both are linear in the text and exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import keep
from .arrays import BASE, CHUNK, Prefix, U, chunks, ends_of, mixed, points, sliding_min

#: Characters of a token; shorter tokens repeat more often, longer ones leave fewer places for the smallest hash.
GRAM = 32
#: Classes of one token that one task looks through (under 1 KB each).
FEW = 2048
#: Up to so many classes (under 100 bytes each) go to the texts; beyond, the join shuffles.
BROADCAST_CLASSES = 500_000
_POSTING = pa.schema([("id", pa.int64()), ("token", pa.int64()), ("whole", pa.int64()), ("at", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])


def windows_of(texts: list[str], span: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, token hash, window hash, token's place, window's start and end) of all compact windows."""
    x, ends = points(texts), ends_of(texts)
    prefix = Prefix(x)
    grams = prefix.every(gram)
    place = max(28, len(x).bit_length())
    # ties go to the leftmost: equal stretches hold the same tokens in the same order, so they agree
    low = sliding_min((grams >> U(place) << U(place)) | np.arange(len(grams), dtype=U), span - gram + 1)
    starts = np.arange(len(low))
    row = np.searchsorted(ends, starts, "right")
    ok = starts + span <= ends[np.minimum(row, len(ends) - 1)] if len(ends) else starts < 0
    starts, row, at = starts[ok], row[ok], (low[ok] & U((1 << place) - 1)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(first) else first
    lo, hi, at, row = starts[first], starts[last] + span, at[first], row[first]
    begin = ends[row] - np.array([len(t) for t in texts], np.int64)[row] if len(row) else row
    whole = mixed(prefix.of(lo, hi) + ((hi - lo).astype(U) << U(32)) + (at - lo).astype(U))
    return row, grams[at].view(np.int64), whole.view(np.int64), at - begin, lo - begin, hi - begin


def compact_windows(docs: DataFrame, span: int, gram: int = GRAM) -> DataFrame:
    """(id, token, whole, at, lo, hi) per compact window of docs (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for first, texts in chunks(batch):
                row, *rest = windows_of(texts, span, gram)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids[first + row], *rest), _POSTING)], schema=_POSTING)

    return docs.mapInArrow(run, "id bigint, token bigint, whole bigint, at int, lo int, hi int")


_KEYS = ["token", "whole"]
_SINGLE = "token bigint, whole bigint, `from` int, `to` int"


def starts_of(texts: list[str], left: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start relative to the token, hash) of every stretch of `span` characters."""
    lengths = np.array([len(t) for t in texts], np.int64)
    begin = ends_of(texts) - lengths
    n = np.maximum(lengths - span + 1, 0)
    row = np.repeat(np.arange(len(texts)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return row, start - left[row], Prefix(points(texts)).of(begin[row] + start, begin[row] + start + span)


def compared(rows: list[tuple], span: int) -> list[tuple]:
    """(token, whole, from, to), relative to the token, of what classes of one record share with other classes of their token."""
    token, whole, least, most = (np.array([r[i] for r in rows], np.int64) for i in (0, 1, 3, 4))
    row, offset, h = starts_of([r[5] for r in rows], np.array([r[2] for r in rows], np.int64), span)
    if not len(row):
        return []
    key = mixed(h ^ mixed(token.view(U)[row] + U(BASE) * offset.astype(U)))
    order = np.argsort(key)
    first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    apart = np.minimum.reduceat(least[row][order], first) != np.maximum.reduceat(most[row][order], first)
    shared = np.empty(len(key), bool)
    shared[order] = np.repeat(apart, np.diff(np.append(first, len(key))))
    at = np.flatnonzero(shared & (least == most)[row])
    if not len(at):
        return []
    new = np.append(True, (at[1:] != at[:-1] + 1) | (row[at][1:] != row[at][:-1]))
    a, b = at[new], at[np.append(new[1:], True)]
    return list(zip(token[row[a]].tolist(), whole[row[a]].tolist(), offset[a].tolist(), (offset[b] + span).tolist()))


def in_tasks(live: DataFrame, span: int) -> DataFrame:
    """Looks every start of a class up among the other classes of its token, which lie in the same task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[tuple] = []
        size = 0
        for frame in frames:
            out = []
            for r in zip(*(frame[c].tolist() for c in [*_KEYS, "left", "least", "most", "text"])):
                if size > CHUNK and kept[-1][0] != r[0]:
                    out += compared(kept, span)
                    kept, size = [], 0
                kept.append(r)
                size += len(r[5])
            yield pd.DataFrame(out, columns=["token", "whole", "from", "to"])
        yield pd.DataFrame(compared(kept, span) if kept else [], columns=["token", "whole", "from", "to"])

    return live.repartition("token").sortWithinPartitions("token").mapInPandas(run, _SINGLE)


def across_tasks(live: DataFrame, span: int) -> DataFrame:
    """The same for tokens of any number of classes: the starts are rows, aggregated before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch):
                left = batch.column("left").to_numpy()[first : first + len(texts)]
                row, offset, h = starts_of(texts, left, span)
                part = pa.Table.from_batches([batch.select([*_KEYS, "least", "most"])]).take(pa.array(first + row))
                yield from part.append_column("offset", pa.array(offset, pa.int32())).append_column("h", pa.array(h.view(np.int64))).combine_chunks().to_batches()

    every = live.mapInArrow(run, "token bigint, whole bigint, least bigint, most bigint, offset int, h bigint")
    key = ["token", "offset", "h"]
    shared = every.groupBy(key).agg(F.min("least").alias("a"), F.max("most").alias("b")).where("a <> b").select(key)
    single = every.where("least = most")
    return single.join(shared, key).select(*_KEYS, F.col("offset").alias("from"), (F.col("offset") + span).alias("to"))


def shared_spans(docs: DataFrame, id_col: str, text_col: str, span: int = 400, gram: int = GRAM, few: int = FEW) -> DataFrame:
    """(id, span_from, span_to): the longest unbroken stretches of characters that lie in a stretch of at least `span`
    characters that occurs verbatim in another record. Exact: no stretch is missed, none is reported that isn't shared.

    A null, empty or shorter text has none. Records with a null id are left out. A stretch that occurs twice in one record
    only isn't shared. Other columns of docs are not read.
    """
    docs = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    windows = keep(compact_windows(docs, span, min(gram, span)))
    classes = windows.groupBy(_KEYS).agg(F.min(F.struct("id", "lo", "at", "hi")).alias("one"), F.max("id").alias("most"))
    classes = classes.select(*_KEYS, F.col("one.id").alias("least"), "most", "one.lo", "one.at", "one.hi")
    tokens = classes.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("least").alias("a"), F.max("most").alias("b")).where("a <> b").select("token", "n")
    live = keep(classes.join(tokens, "token"))
    found = live.where("least <> most").select(*_KEYS, (F.col("lo") - F.col("at")).alias("from"), (F.col("hi") - F.col("at")).alias("to"))
    # every other class is read from the text of its least record
    several = live.where("n > 1").select(F.col("least").alias("id"), *_KEYS, "most", "lo", "at", "hi", "n")
    if several.limit(BROADCAST_CLASSES + 1).count() <= BROADCAST_CLASSES:
        several = F.broadcast(several)
    texts = docs.join(several, "id").select(*_KEYS, (F.col("at") - F.col("lo")).alias("left"), F.col("id").alias("least"), "most", "n", F.substring("text", F.col("lo") + 1, F.col("hi") - F.col("lo")).alias("text"))
    found = found.unionByName(in_tasks(texts.where(F.col("n") <= few).drop("n"), span))
    if live.where(F.col("n") > few).limit(1).count():
        found = found.unionByName(across_tasks(texts.where(F.col("n") > few).drop("n"), span))
    parts = windows.join(found, _KEYS).select("id", (F.col("at") + F.col("from")).alias("a"), (F.col("at") + F.col("to")).alias("b"))
    return stretches(parts)


def stretches(parts: DataFrame) -> DataFrame:
    """The union of [a, b) per id as its longest unbroken stretches; pre-aggregated by start."""
    parts = parts.groupBy("id", "a").agg(F.max("b").alias("b"))
    order = Window.partitionBy("id").orderBy("a")
    before = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = parts.withColumn("new", F.coalesce((F.col("a") > before).cast("int"), F.lit(1)))
    numbered = marked.withColumn("n", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("id", "n").agg(F.min("a").cast("int").alias("span_from"), F.max("b").cast("int").alias("span_to")).drop("n")


def shared_part(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_chars, n_shared, n_spans) of every record with an id."""
    per = spans.groupBy("id").agg(F.sum(F.col("span_to") - F.col("span_from")).alias("n_shared"), F.count(F.lit(1)).alias("n_spans"))
    sized = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.length(text_col), F.lit(0)).alias("n_chars"))
    return sized.join(per, "id", "left").select("id", "n_chars", F.coalesce("n_shared", F.lit(0)).alias("n_shared"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"))
