"""Near-equal records with small edits: groups of records linked by the similarity of their word shingles.

Signature: min-hashes of the shingles, one symbol a lane. It is cut into so few segments that the segments of two linked records
differ by at most one symbol in several of them; each segment is indexed once per wildcard (the segment without one of
its symbols), and records that agree on such a variant are candidates. Candidates are held against each other on four
bits of every lane, the rest on the shingles themselves, so no group is formed by chance.

Shape: equal texts are one class before anything is indexed. In each bucket of a variant the records are first compared with one
of them, which is linear; only what is then still in different components is compared with each other, so a large group of copies
costs no pairs. Links, components and signatures stay distributed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import keep
from .arrays import U, chunks, mixed
from .components import SAMPLED, buckets, components, linked
from .words import words_of

#: Up to so many ids (8 bytes each) are broadcast to select rows; beyond, the join shuffles.
BROADCAST_IDS = 2_000_000
_NIBBLES = 0x1111111111111111


@dataclass(frozen=True)
class Likeness:
    """shingle: words; threshold: least share of common shingles; segments of `width` symbols, each with one wildcard."""

    shingle: int = 3
    threshold: float = 0.6
    segments: int = 12
    width: int = 5
    #: Lanes of two records that must agree in four bits: four deviations under what the threshold leads to expect.
    spread: float = 4.0

    @property
    def lanes(self) -> int:
        return self.segments * self.width

    @property
    def least_equal(self) -> int:
        p = self.threshold + (1 - self.threshold) / 16
        return max(0, int(self.lanes * p - self.spread * (self.lanes * p * (1 - p)) ** 0.5))


def shingles_of(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all runs of k words, first of each text, number in each text)."""
    words, first, count = words_of(texts)
    n = np.maximum(count - k + 1, 0)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    h = np.zeros(len(start), U)
    for j in range(k):
        h = mixed(h * U(0x100000001B3) + words[start + j]) if len(start) else h
    return h, np.cumsum(n) - n, n


def lanes_of(h: np.ndarray, first: np.ndarray, n: np.ndarray, lanes: int) -> np.ndarray:
    """Min-hashes, a row for each text that has shingles."""
    factors = np.random.default_rng(20250611).integers(1, 1 << 63, lanes, dtype=np.uint64) * U(2) + U(1)
    has = first[n > 0]
    out = np.empty((len(has), lanes), U)
    for j, a in enumerate(factors if len(has) else ()):
        out[:, j] = np.minimum.reduceat(h * a, has)
    return mixed(out)


def keys_of(lanes: np.ndarray, how: Likeness) -> np.ndarray:
    """One key for each segment and wildcard."""
    at = lanes.reshape(len(lanes), how.segments, how.width)
    places = mixed(np.arange(1, how.lanes + 1, dtype=U)).reshape(how.segments, how.width)
    parts = mixed(at + places)
    whole = parts.sum(axis=2, dtype=U)
    return mixed(whole[:, :, None] - parts + places).reshape(len(lanes), -1)


def digest_of(lanes: np.ndarray) -> np.ndarray:
    """Four bits of every lane, sixteen lanes a word."""
    nibbles = np.zeros((len(lanes), -(-lanes.shape[1] // 16) * 16), U)
    nibbles[:, : lanes.shape[1]] = lanes >> U(60)
    return np.bitwise_or.reduce(nibbles.reshape(len(lanes), -1, 16) << (U(4) * np.arange(16, dtype=U)), axis=2)


def signatures(texts: DataFrame, how: Likeness, keys: bool) -> DataFrame:
    """(id, keys) or (id, digest) of texts (id, text); texts without shingles have none."""
    kind = pa.list_(pa.int64())
    schema = pa.schema([("id", pa.int64()), ("x", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for at, part in chunks(batch):
                h, first, n = shingles_of([t.lower() for t in part], how.shingle)
                lanes = lanes_of(h, first, n, how.lanes)
                made = keys_of(lanes, how) if keys else digest_of(lanes)
                offsets = pa.array(np.arange(len(made) + 1) * made.shape[1], pa.int32())
                x = pa.ListArray.from_arrays(offsets, pa.array(made.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + len(part)][n > 0]), x], schema=schema)

    return texts.mapInArrow(run, "id bigint, x array<bigint>")


def equal_lanes(x: str, y: str, how: Likeness) -> Column:
    """How many lanes agree in four bits."""
    differ = None
    for i in range(-(-how.lanes // 16)):
        d = F.col(x)[i].bitwiseXOR(F.col(y)[i])
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        n = F.bit_count(d.bitwiseAND(F.lit(_NIBBLES)))
        differ = n if differ is None else differ + n
    return how.lanes - differ


def chosen(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of texts whose id is among ids (id), which are distinct."""
    ids = keep(ids)
    return texts.join(F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids, "id", "left_semi")


def verified(pairs: DataFrame, digests: DataFrame, texts: DataFrame, how: Likeness) -> DataFrame:
    """(a, b, similarity) of the pairs (a, b) that reach the threshold."""
    a, b = (digests.select(F.col("id").alias(x), F.col("x").alias(f"d{x}")) for x in "ab")
    near = pairs.join(a, "a").join(b, "b").where(equal_lanes("da", "db", how) >= how.least_equal).select("a", "b")
    near = keep(near)
    own = chosen(texts, near.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    schema = pa.schema([("id", pa.int64()), ("s", pa.binary())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for at, part in chunks(batch):
                h, first, n = shingles_of([t.lower() for t in part], how.shingle)
                blobs = [np.unique(h[i : i + k]).tobytes() for i, k in zip(first, n)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + len(part)], pa.int64()), pa.array(blobs, pa.binary())], schema=schema)

    bags = own.mapInArrow(sets, "id bigint, s binary")
    both = near.join(bags.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(bags.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            share = []
            for x, y in zip(f["sa"], f["sb"]):
                x, y = np.frombuffer(x, U), np.frombuffer(y, U)
                common = len(np.intersect1d(x, y, assume_unique=True))
                share.append(common / max(1, len(x) + len(y) - common))
            out = pd.DataFrame({"a": f["a"], "b": f["b"], "similarity": np.array(share, float)})
            yield out[out["similarity"] >= how.threshold]

    return both.mapInPandas(compare, "a bigint, b bigint, similarity double")


def groups(texts: DataFrame, how: Likeness = Likeness()) -> DataFrame:
    """(id, group): every record of texts (id, text) that is linked to another, directly or through others; group is the least id.

    Text is compared in lower case; words are the longest runs of letters or digits. A null text is empty; texts of fewer
    words than a shingle have no shingles and no links, equal ones included. Rows with a null id are left out; ids are distinct.
    """
    word, gap = r"[\p{L}\p{N}]+", r"[^\p{L}\p{N}]+"
    texts = texts.where(F.col("id").isNotNull()).select(F.col("id").cast("bigint").alias("id"), F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    texts = texts.where(F.col("text").rlike(gap.join([word] * how.shingle)))
    marks = texts.select("id", F.unhex(F.md5("text")).alias("mark"))
    copies = marks.groupBy("mark").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1").select("mark", "rep")
    copies = keep(marks.join(copies, "mark").where("id <> rep").select("id", "rep"))
    few = copies.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    own = texts.join(F.broadcast(copies.select("id")) if few else copies.select("id"), "id", "left_anti")

    posted = lambda rows: signatures(rows, how, keys=True).select("id", F.explode("x").alias("key"))
    met = keep(buckets(posted(own), posted(own.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLED)) == 0))))
    digests = keep(chosen_digests(own, met, how))
    links = linked(met, lambda pairs: verified(pairs, digests, own, how))
    every = links.union(copies.select(F.col("rep").alias("a"), F.col("id").alias("b")))
    return components(every).select("id", F.col("comp").alias("group"))


def chosen_digests(texts: DataFrame, met: DataFrame, how: Likeness) -> DataFrame:
    """Digests of the records that met another."""
    return signatures(chosen(texts, met.select("id").distinct()), how, keys=False)


def pairs_of(grouped: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of each group, for results that ask for them."""
    x, y = grouped.select("group", F.col("id").alias("a")), grouped.select("group", F.col("id").alias("b"))
    return x.join(y, "group").where("a < b").select("a", "b")
