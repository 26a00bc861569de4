"""What tasks look values up in: written by executors in the shared folder and mapped or read from there, so that the driver holds none of it.

The folder must be one that pyarrow can open (files, HDFS, object stores); files are mapped, so a machine's workers share them.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh
from .arrays import MIX, U

#: Values in a file, about: a task sorts those of one.
PART = 1 << 21
#: Bits of the filter before the search: so many a value, within these powers of two. The smallest is held as bytes, which are faster.
#: Below the largest a value has two bits, so that few of a large set's other values are searched for.
FILTER, LEAST, MOST = 32, 22, 29


def place(at: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI, and the folder there."""
    return fs.FileSystem.from_uri("file://" + at[5:] if at.startswith("file:/") and not at.startswith("file://") else at)


def written(values: DataFrame, about: int) -> str:
    """The folder of the values of the only column (bigint), about so many of them: sorted, each once, a file for each range of their high bits."""
    at = fresh(values.sparkSession)
    bits = (max(0, about - 1) // PART).bit_length()
    part = F.shiftrightunsigned("v", 64 - bits).cast("int") if bits else F.lit(0)

    def write(table: pa.Table) -> pa.Table:
        system, folder = place(at)
        system.create_dir(folder)
        own = np.unique(table["v"].to_numpy().view(U))
        draft = f"{folder}/_{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as f:
            f.write(own)
        system.move(draft, f"{folder}/{table['part'][0].as_py():06d}")  # a repeated task writes the same
        return pa.table({"n": pa.array([len(own)], pa.int64())})

    values.toDF("v").where("v is not null").distinct().withColumn("part", part).groupBy("part").applyInArrow(write, "n bigint").agg(F.sum("n")).collect()
    return at


class Values:
    """A set of 64-bit values that was written so."""

    def __init__(self, at: str) -> None:
        system, folder = place(at)
        names = sorted(x.path for x in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if x.base_name.isdigit())
        local = isinstance(system, fs.LocalFileSystem)
        self.parts = [np.memmap(x, U, "r") if local else np.frombuffer(system.open_input_file(x).read(), U) for x in names]
        self.firsts = np.array([x[0] for x in self.parts], U)
        size = sum(map(len, self.parts))
        self.bits = min(MOST, max(LEAST, (FILTER * size).bit_length()))
        self.flat = self.bits == LEAST
        self.some = np.zeros(1 << self.bits - (0 if self.flat else 3), bool if self.flat else np.uint8)
        self.twice = self.bits < MOST
        for x in self.parts:
            for i in range(0, len(x), 1 << 20):
                own = x[i : i + (1 << 20)]
                self.note(own)
                if self.twice:
                    self.note(np.sort(own * U(MIX[0])))

    def note(self, x: np.ndarray) -> None:
        """Sets the bits of sorted values."""
        top = x >> U(64 - self.bits)
        if self.flat:
            self.some[top.astype(np.int64)] = True
        elif len(x):
            byte = (top >> U(3)).astype(np.int64)
            first = np.flatnonzero(np.diff(byte, prepend=-1))
            self.some[byte[first]] |= np.bitwise_or.reduceat(np.uint8(1) << (top & U(7)).astype(np.uint8), first)

    def maybe(self, x: np.ndarray) -> np.ndarray:
        """For each of x whether it may be in the set; false where it is certainly not."""
        top = (x >> U(64 - self.bits)).astype(np.int64)
        return self.some[top] if self.flat else (self.some[top >> 3] >> (top & 7).astype(np.uint8)) & 1 != 0

    def among(self, x: np.ndarray) -> np.ndarray:
        """The indices of those of x that are in the set."""
        at = np.flatnonzero(self.maybe(x))
        own = x[at]
        if self.twice:
            ok = self.maybe(own * U(MIX[0]))
            at, own = at[ok], own[ok]
        if len(self.parts) == 1:
            return at[self.parts[0][np.minimum(np.searchsorted(self.parts[0], own), len(self.parts[0]) - 1)] == own]
        part, here = np.searchsorted(self.firsts, own, "right") - 1, np.zeros(len(own), bool)
        for k in np.unique(part[part >= 0]):
            rows, known = np.flatnonzero(part == k), self.parts[k]
            here[rows] = known[np.minimum(np.searchsorted(known, own[rows]), len(known) - 1)] == own[rows]
        return at[here]


@lru_cache(2)
def values(at: str) -> Values:
    """The set of a folder, kept by a worker for its next tasks."""
    return Values(at)


@lru_cache(1)
def lines(at: str, i: int, passes: int) -> tuple[list[str], list[int]]:
    """Of the table (line, key) in a folder the sorted lines, with their keys, whose key is i modulo passes."""
    system, folder = place(at)
    own = []
    for batch in ds.dataset(folder, filesystem=system, format="parquet").to_batches(columns=["line", "key"]):
        own += [r for r in zip(*(batch.column(c).to_pylist() for c in ("line", "key"))) if r[1] % passes == i]
    own.sort()
    return [x for x, _ in own], [k for _, k in own]
