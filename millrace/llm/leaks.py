"""Evaluation texts leaking into training text.

Every run of `run` words of an item is a passage. Windows of words are embedded by the CGK random walk, which turns an edit
distance of e words into a Hamming distance of order e squared: a walk copies the word it stands on and moves on by a random bit of
that word. Of each embedding a few places are sampled; windows whose samples agree are candidates, over as many independent walks as the
recall needs, and candidates are verified on the words themselves.

For passages without edits the embeddings are equal, so one walk finds all of them. Then a shorter window suffices
at every `stride`-th word of the texts: any run of `run` words holds a whole one, and verification extends it to both sides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, chunks, mixed
from .words import nfkc_lower, words_of

#: Windows of items that are held in one block (each about 32 bytes a walk); more items make more blocks, each a pass over the texts.
BLOCK = 2_000_000


@dataclass(frozen=True)
class Search:
    """run: words of a passage; edits: words that may be inserted, deleted or replaced; walks, samples: of the embedding."""

    run: int = 12
    edits: int = 0
    walks: int = 1
    samples: int = 6
    stride: int = 5

    @property
    def step(self) -> int:
        return 1 if self.edits else min(self.stride, self.run)

    @property
    def window(self) -> int:
        return self.run - self.step + 1


def sampled(words: np.ndarray, at: np.ndarray, how: Search, walk: int) -> np.ndarray:
    """Key of each window's embedding at the sampled places; words past the window's end are blanks."""
    width = min(how.window, 21)  # three steps a word, one bit of 64 a step
    rng = np.random.default_rng(7919 + walk)
    # a walk needs two steps a word on average; passages without edits lose nothing by more samples, so all steps count
    steps = 2 * width
    places = set(rng.choice(steps, min(how.samples, steps), replace=False).tolist()) if how.edits else set(range(steps))
    bits = mixed(words ^ U(rng.integers(1 << 63)))
    i = at.copy()
    end = at + how.window
    key = np.full(len(at), walk + 1, U)
    blank = U(0)
    for j in range(max(places) + 1):
        here = np.minimum(i, len(words) - 1)
        out = i >= end
        if j in places:
            key = mixed(key * U(0x100000001B3) + np.where(out, blank, words[here]))
        i += ((bits[here] >> U(j)) & U(1)).astype(np.int64) * ~out
    return key


@dataclass
class Index:
    """Passages of a block of items."""

    words: np.ndarray
    first: np.ndarray
    count: np.ndarray
    ids: np.ndarray
    keys: list[np.ndarray]
    item: list[np.ndarray]
    place: list[np.ndarray]


def index_of(items: list[tuple[int, str | None]], how: Search) -> Index:
    texts = [nfkc_lower(t) for _, t in items] or [""]
    words, first, count = words_of(texts)
    n = np.maximum(count - how.window + 1, 0) * (count >= how.run)
    item = np.repeat(np.arange(len(texts)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[item]
    made = Index(words, first, count, np.array([i for i, _ in items], np.int64), [], [], [])
    for walk in range(how.walks):
        key = sampled(words, at, how, walk) if len(at) else np.zeros(0, U)
        order = np.argsort(key, kind="stable")
        made.keys.append(key[order])
        made.item.append(item[order])
        made.place.append(at[order])
    return made


def edits_between(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Fewest word edits that turn a into some start of b, or most + 1."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
        if min(row) > most:
            return most + 1
    return min(row)


def common(a: np.ndarray, at: np.ndarray, b: np.ndarray, place: np.ndarray, how: Search) -> np.ndarray:
    """How many words of each window of b stand in the window of a, without edits at the same place."""
    reach = np.arange(how.window + how.edits)
    x = a[np.minimum(at[:, None] + reach, len(a) - 1)]
    y = b[np.minimum(place[:, None] + np.arange(how.window), len(b) - 1)]
    if not how.edits:
        return (x == y).sum(axis=1)
    return (x[:, None, :] == y[:, :, None]).any(axis=2).sum(axis=1)


def same(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def hits_in(texts: list[str], index: Index, how: Search) -> dict[tuple[int, int], tuple[int, int]]:
    """(text, item) -> (words of the longest exact run, fewest edits of a passage)."""
    words, first, count = words_of(texts)
    n = np.maximum(count - how.window + how.step, 0) // how.step
    text = np.repeat(np.arange(len(texts)), n)
    at = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * how.step + first[text]
    best: dict[tuple[int, int], tuple[int, int]] = {}
    if not len(at):
        return best
    for walk in range(how.walks):
        key = sampled(words, at, how, walk)
        if not len(index.keys[walk]):
            continue
        lo, hi = np.searchsorted(index.keys[walk], key, "left"), np.searchsorted(index.keys[walk], key, "right")
        near = np.flatnonzero(hi > lo)
        windows = np.repeat(near, (hi - lo)[near])
        entries = np.arange(len(windows)) - np.repeat(np.cumsum((hi - lo)[near]) - (hi - lo)[near], (hi - lo)[near]) + lo[windows]
        for part in range(0, len(windows), 50_000):
            w, c = windows[part : part + 50_000], entries[part : part + 50_000]
            alike = common(words, at[w], index.words, index.place[walk][c], how) >= how.window - how.edits
            for w, c in zip(w[alike].tolist(), c[alike].tolist()):
                d, p = int(text[w]), int(at[w])
                begin, end = int(first[d]), int(first[d] + count[d])
                t, q = int(index.item[walk][c]), int(index.place[walk][c])
                start, stop = int(index.first[t]), int(index.first[t] + index.count[t])
                left = same(words[begin:p][::-1], index.words[start:q][::-1])
                run = same(words[p:end], index.words[q:stop])
                length = left + run if run else 0
                if length >= how.run:
                    e = 0
                elif how.edits:
                    e = edits_between(index.words[q : q + how.run], words[p : min(end, p + how.run + how.edits)], how.edits)
                else:
                    e = 1
                if e <= how.edits:
                    old = best.get((d, t), (0, e))
                    best[d, t] = (max(old[0], length), min(old[1], e))
    return best


_HIT = pa.schema([("doc", pa.int64()), ("item", pa.int64()), ("run", pa.int32()), ("edits", pa.int32())])


def leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, question: str, how: Search = Search(), block: int = BLOCK) -> DataFrame:
    """(doc, item, run, edits): texts that hold a passage of an item, with the longest exact run of words seen around a candidate and the
    fewest edits of a passage. With edits=0 exact and complete; otherwise complete for exact passages and as complete as
    the walks make it for edited ones.

    Words are the longest runs of letters or digits, in lower case and NFKC. Items of fewer words than `run` have no
    passage; null or empty texts hold none; rows without an id are left out; each pair is given once however often it
    occurs. Texts aren't shuffled: the items, read in blocks of bounded size, go to every task.
    """
    picked = items.where(F.col(item_id).isNotNull() & F.col(question).isNotNull()).select(F.col(item_id).cast("bigint").alias("id"), F.col(question).alias("q"))
    sizes = picked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(F.split("q", "\\s+"))), F.lit(0))).first()
    blocks = max(1, -(-int(sizes[1]) * how.walks // block))
    source = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    found = None
    for b in range(blocks):
        own = picked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b) if blocks > 1 else picked
        shared = source.sparkSession.sparkContext.broadcast([tuple(r) for r in own.toLocalIterator()])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = None
            for batch in batches:
                index = index or index_of(shared.value, how)
                ids = batch.column("id").to_pylist()
                for first, texts in chunks(batch):
                    hits = hits_in([nfkc_lower(t) for t in texts], index, how)
                    if hits:
                        rows = [(ids[first + d], int(index.ids[t]), *x) for (d, t), x in hits.items()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _HIT)], schema=_HIT)

        part = source.mapInArrow(run, "doc bigint, item bigint, run int, edits int")
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc", "item").agg(F.max("run").alias("run"), F.min("edits").alias("edits"))
