"""Texts of a batch as flat code-point arrays, with hashes of any stretch of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Base of the polynomial hash (odd, so that powers can be inverted) and mixing constants of splitmix64.
BASE, MIX = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
INVERSE = pow(BASE, -1, 1 << 64)
#: Code points worked on at once; a longer text is worked on alone.
CHUNK = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(MIX[0])
    x = x ^ (x >> U(27))
    x = x * U(MIX[1])
    return x ^ (x >> U(31))


class Powers:
    """Powers of BASE and of its inverse, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            grow = np.full(n, BASE, U)
            grow[0] = 1
            self.up = np.cumprod(grow)
            grow = np.full(n, INVERSE, U)
            grow[0] = 1
            self.down = np.cumprod(grow)
        return self.up[:n], self.down[:n]


POWERS = Powers()


class Prefix:
    """Hash of x[a:b] for any a <= b in constant time."""

    def __init__(self, x: np.ndarray) -> None:
        up, self.down = POWERS.to(len(x) + 1)
        self.sums = np.zeros(len(x) + 1, U)
        np.cumsum(mixed(x.astype(U) + U(1)) * up[: len(x)], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((self.sums[b] - self.sums[a]) * self.down[a])

    def every(self, width: int) -> np.ndarray:
        """Of all stretches of one width, by start."""
        n = max(0, len(self.sums) - width)
        return mixed((self.sums[width:] - self.sums[:n]) * self.down[:n]) if n else np.zeros(0, U)


def points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def chunks(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows of at most `most` code points each, nulls as empty."""
    texts = [x or "" for x in batch.column(column).to_pylist()]
    at = size = 0
    for i, x in enumerate(texts):
        if size and size + len(x) > most:
            yield at, texts[at:i]
            at, size = i, 0
        size += len(x)
    if at < len(texts):
        yield at, texts[at:]


def ends_of(texts: list[str]) -> np.ndarray:
    return np.cumsum([len(x) for x in texts])


def sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of one width, by start, from prefix and suffix minima of blocks."""
    n = len(key) - width + 1
    if n <= 0:
        return key[:0]
    padded = np.full(-(-len(key) // width) * width, np.iinfo(U).max, U)
    padded[: len(key)] = key
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
