"""Exact nearest neighbours of a stated set of queries, in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Query vectors that go to the tasks at once (at most 8 KB each in a thousand dimensions).
BLOCK = 4096


def nearest(queries: DataFrame, rows: DataFrame, key: str, vector: str, k: int, block: int = BLOCK) -> DataFrame:
    """(query_id, neighbour_id, rank, score): the k rows most alike by cosine, the query itself left out; ties by id.

    Queries go to the tasks in blocks of bounded size, each a pass over the rows, which aren't shuffled; every task keeps k rows a query, so what
    is shuffled is k rows for each query and task. Null or zero vectors, and those of another length, have no neighbours.
    """
    spark = rows.sparkSession
    q = queries.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("bigint").alias("q"), F.col(vector).cast("array<double>").alias("v"))
    blocks = max(1, -(-q.count() // block))
    source = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    found = None
    for b in range(blocks):
        own = q.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b) if blocks > 1 else q
        shared = spark.sparkContext.broadcast([(r[0], np.array(r[1], float)) for r in own.toLocalIterator()])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            sizes = {len(v) for _, v in shared.value}
            sets = {n: ([i for i, v in shared.value if len(v) == n], np.array([v for _, v in shared.value if len(v) == n])) for n in sizes}
            best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for batch in batches:
                ids, lists = batch.column("id").to_numpy(), batch.column("v")
                lengths = np.diff(lists.offsets.to_numpy())
                for n, (qid, m) in sets.items():
                    mine = np.flatnonzero(lengths == n)
                    if not len(mine) or not n:
                        continue
                    x = np.array(lists.take(pa.array(mine)).flatten().to_numpy(zero_copy_only=False), float).reshape(-1, n)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        s = (m / np.linalg.norm(m, axis=1, keepdims=True)) @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T
                    for r, i in enumerate(qid):
                        own_ids, own_s = ids[mine], s[r]
                        ok = (own_ids != i) & np.isfinite(own_s)
                        a, c = best.get(i, (np.zeros(0, np.int64), np.zeros(0)))
                        a, c = np.append(a, own_ids[ok]), np.append(c, own_s[ok])
                        top = np.lexsort((a, -c))[:k]
                        best[i] = a[top], c[top]
            for i, (a, c) in best.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), i)), pa.array(a), pa.array(c)], names=["query_id", "neighbour_id", "score"])

        part = source.mapInArrow(run, "query_id bigint, neighbour_id bigint, score double")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "neighbour_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
