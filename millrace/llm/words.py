"""Words of many texts at once: hashes of the longest runs of letters or digits."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

import numpy as np

from .arrays import Prefix, ends_of, points


#: Planes from here on hold ideographs only.
PLANES = 0x20000


def table(test: Callable[[str], bool]) -> np.ndarray:
    """The test of every code point; beyond the first planes, of the two planes of ideographs as a whole."""
    out = np.zeros(0x110000, bool)
    out[:PLANES] = np.fromiter(map(test, map(chr, range(PLANES))), bool, PLANES)
    out[PLANES : 2 * PLANES] = test(chr(PLANES))
    return out


@cache
def alnum() -> np.ndarray:
    """By code point: whether it is a letter or digit."""
    return table(str.isalnum)


@cache
def digits() -> np.ndarray:
    return table(str.isdigit)


def nfkc_lower(text: str | None) -> str:
    if not text:
        return ""
    return text.lower() if text.isascii() else unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).lower())


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes of all texts in order, first word of each text, number of words of each text)."""
    x = points([t + "\n" for t in texts])  # the line end keeps words of neighbouring texts apart
    inside = np.zeros(len(x) + 1, np.int8)
    inside[1:] = alnum()[x]
    step = np.diff(inside)
    start, stop = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    ends = ends_of(texts) + np.arange(1, len(texts) + 1)
    last = np.searchsorted(start, ends, "left")
    first = np.concatenate([[0], last[:-1]])
    return Prefix(x).of(start, stop), first, last - first
