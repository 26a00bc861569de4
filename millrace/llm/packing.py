"""Filling sequences of fixed capacity with texts.

Lengths are in tokens of a public tokenizer; a text longer than the capacity is cut into full pieces and a rest. Items
are ranked within their class of lengths and placed by arithmetic on that rank, so all tasks fill their sequences
independently: no task sees more than its own rows, and a class that holds a third of all rows is ranked in salted parts.

- `harmonic`: class k holds the lengths in (capacity / (k + 1), capacity / k]; each of its sequences takes k items.
- `planned` (default): the classes are the lengths themselves, and a sequence takes a fixed number of items of each of several
  classes. The numbers come from the histogram of lengths, which has at most `capacity` entries whatever the number of
  texts: sequences are planned from the longest lengths down, each filled up with the longest that still fit.

Items of no tokens need no room; they go into the first sequence.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Vocabulary file (ranks) and the pattern that cuts text before pairs are merged.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Parts in which each class is ranked.
SALTS = 32


@cache
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, id_col: str, text_col: str, tokenizer: str = TOKENIZER, pattern: str = PATTERN) -> DataFrame:
    """(id, n_tokens); a null text has none, strings of special tokens are ordinary text, rows without an id are left out."""
    source = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoding(tokenizer, pattern).encode_ordinary
        for batch in batches:
            counts = pa.array([len(tokens(x)) if x else 0 for x in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), counts], schema=schema)

    return source.mapInArrow(run, "id bigint, n_tokens bigint")


def plan(histogram: dict[int, int], capacity: int) -> tuple[dict[int, tuple[list[int], list[int], list[int]]], int]:
    """For each length the ranks from which on a new kind of sequence takes its items, with the first sequence and the
    items a sequence takes; and the number of sequences."""
    left = {n: c for n, c in histogram.items() if n > 0 and c > 0}
    lengths = sorted(left)
    used = dict.fromkeys(left, 0)
    slots: dict[int, tuple[list[int], list[int], list[int]]] = {n: ([], [], []) for n in left}
    sequences = 0
    while lengths:
        room, own = capacity, []
        at = len(lengths)
        while room and (at := bisect.bisect_right(lengths, room, 0, at)):
            n = lengths[at - 1]
            own.append((n, min(left[n], room // n)))
            room -= n * own[-1][1]
            at -= 1
        times = min(left[n] // m for n, m in own)
        for n, m in own:
            for values, x in zip(slots[n], (used[n], sequences, m)):
                values.append(x)
            used[n] += m * times
            left[n] -= m * times
            if not left[n]:
                lengths.pop(bisect.bisect_left(lengths, n))
        sequences += times
    return slots, sequences


def ranked(items: DataFrame, classes: list[str], order: list[str], salts: int) -> DataFrame:
    """items with `rank`, from 0, within each class; a class is ranked in parts, and the parts' sizes are summed."""
    salted = items.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    own = Window.partitionBy(*classes, "_salt").orderBy(*order)
    local = salted.withColumn("_n", F.row_number().over(own) - 1)
    sizes = salted.groupBy(*classes, "_salt").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.partitionBy(*classes).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_size")
    return local.join(sizes, [*classes, "_salt"]).withColumn("rank", F.col("_n") + F.col("_before")).drop("_salt", "_n", "_before")


def pieces_of(counts: DataFrame, limits: list[tuple[int, int]]) -> DataFrame:
    """(limit_id, capacity, id, piece, from_token, n_tokens): every text, cut where it exceeds the capacity."""
    each = F.array(*[F.struct(F.lit(i).cast("int").alias("limit_id"), F.lit(c).cast("bigint").alias("capacity")) for i, c in limits])
    each = counts.withColumn("limit", F.explode(each)).select("id", "n_tokens", "limit.*")
    full = F.expr("cast(n_tokens div capacity as int)")
    rest = F.col("n_tokens") - full * F.col("capacity")
    count = F.greatest(full + F.when(rest > 0, 1).otherwise(0), F.lit(1))
    each = each.withColumn("piece", F.explode(F.sequence(F.lit(0), count - 1)))
    return each.select("limit_id", "capacity", "id", "piece", (F.col("piece") * F.col("capacity")).alias("from_token"), F.least(F.col("capacity"), F.col("n_tokens") - F.col("piece") * F.col("capacity")).alias("n_tokens"))


def pack(counts: DataFrame, limits: DataFrame, method: str = "planned", salts: int = SALTS, most_limits: int = 64) -> DataFrame:
    """(limit_id, id, piece, from_token, n_tokens, seq): for each limit (limit_id, capacity) the sequence of every piece.

    Limits of no or null capacity are left out. Of repeated ids each row is an item of its own. The limits and, for
    `planned`, the histograms of lengths are read to the driver: at most `most_limits` rows and the sum of the capacities.
    """
    wanted = [tuple(r) for r in limits.where(F.col("limit_id").isNotNull() & (F.col("capacity") > 0)).select("limit_id", F.col("capacity").cast("bigint")).distinct().limit(most_limits + 1).collect()]
    if len(wanted) > most_limits:
        raise ValueError(f"more than {most_limits} limits")
    spark = counts.sparkSession
    if not wanted:
        return spark.createDataFrame([], "limit_id int, id bigint, piece int, from_token bigint, n_tokens bigint, seq bigint")
    items = pieces_of(counts, wanted)
    empty = items.where("n_tokens <= 0").withColumn("seq", F.lit(0).cast("bigint"))
    items = items.where("n_tokens > 0")
    if method == "harmonic":
        items = items.withColumn("class", F.expr("cast(capacity div n_tokens as bigint)"))
        ranks = ranked(items, ["limit_id", "class"], ["id", "piece", "n_tokens"], salts).withColumn("in_class", F.expr("rank div class"))
        sizes = items.groupBy("limit_id", "class").agg(F.count(F.lit(1)).alias("n")).withColumn("seqs", F.expr("(n + class - 1) div class"))
        before = F.sum("seqs").over(Window.partitionBy("limit_id").orderBy("class").rowsBetween(Window.unboundedPreceding, -1))
        placed = ranks.join(sizes.select("limit_id", "class", F.coalesce(before, F.lit(0)).alias("before")), ["limit_id", "class"]).withColumn("seq", F.col("in_class") + F.col("before"))
    elif method == "planned":
        histograms: dict[int, dict[int, int]] = {}
        for limit, n, c in items.groupBy("limit_id", "n_tokens").count().toLocalIterator():
            histograms.setdefault(limit, {})[n] = c
        slots = {k: {n: tuple(np.array(v, np.int64) for v in x) for n, x in plan(h, dict(wanted)[k])[0].items()} for k, h in histograms.items()}
        shared = spark.sparkContext.broadcast(slots)
        ranks = ranked(items, ["limit_id", "n_tokens"], ["id", "piece"], salts).select("limit_id", "capacity", "id", "piece", "from_token", "n_tokens", "rank")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                limit, n, rank = (batch.column(c).to_numpy() for c in ("limit_id", "n_tokens", "rank"))
                seq = np.zeros(batch.num_rows, np.int64)
                order = np.lexsort((n, limit))
                new = np.flatnonzero(np.diff(limit[order], prepend=-1) | np.diff(n[order], prepend=-1))
                for own in np.split(order, new[1:]) if len(order) else ():
                    start, first, each = known[int(limit[own[0]])][int(n[own[0]])]
                    at = np.searchsorted(start, rank[own], "right") - 1
                    seq[own] = first[at] + (rank[own] - start[at]) // each[at]
                yield batch.drop_columns(["rank", "capacity"]).append_column("seq", pa.array(seq))

        placed = ranks.mapInArrow(run, "limit_id int, id bigint, piece int, from_token bigint, n_tokens bigint, seq bigint")
    else:
        raise ValueError(f"unknown method {method}")
    columns = ["limit_id", "id", "piece", "from_token", "n_tokens", "seq"]
    return placed.select(columns).unionByName(empty.select(columns))


def use(packed: DataFrame, limits: DataFrame) -> DataFrame:
    """(limit_id, capacity, n_texts, n_tokens, n_seqs, used): the share of the sequences' room that is used."""
    per = packed.groupBy("limit_id").agg(F.count(F.when(F.col("piece") == 0, 1)).alias("n_texts"), F.sum("n_tokens").alias("n_tokens"), F.max("seq").alias("last"))
    per = per.withColumn("n_seqs", F.col("last") + 1).drop("last")
    return limits.join(per, "limit_id").select("limit_id", "capacity", "n_texts", "n_tokens", "n_seqs", F.round(F.col("n_tokens") / (F.col("n_seqs") * F.col("capacity")), 6).alias("used"))


def counted(docs: DataFrame, id_col: str, text_col: str, **how: str) -> DataFrame:
    """Token counts, kept in the shared folder: texts are tokenized once."""
    return cut(token_counts(docs, id_col, text_col, **how))
