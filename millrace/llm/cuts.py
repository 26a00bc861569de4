"""Texts cut off by field limits or mid-transfer.

1. Near-copies: what a cut copy keeps is all that comes before its end. Openings of 6, 16 and 40 words, and all words up to a place, have
   bands of min-hashes over runs of three words; an open text has those of the longest opening it has and of all its words. Two
   stretches of 32 characters before an open text's end are looked up at all places of all texts, and a place is met where a band of the
   openings or of all words before it agrees too, so a copy is met however much longer it is and wherever it differs. Only a place where
   the longer goes on inside the word or sentence, after the last characters of the shorter, is written, and of places that the same
   words come before only the first and last text. Pairs that sizes and bitmaps of shingles leave are verified on all words up to the place.
2. The others are scored by how terminal their closing words are. Marks, fences and JSON decide most; an open list item is judged by
   how often its last word ends an item in all texts, an open last line by how often such a line (names and
   numbers alike) ends a text and in how many texts a line begins with it and goes on, be it inside its last word, and any open end by whether its length is one that texts were cut to.

All counts are over all texts, pre-aggregated before they are shuffled.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import cache, cached_property, lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fresh, keep
from . import endings, lookups
from .arrays import POWERS, Prefix, U, chunks, ends_of, mixed, points
from .residue_rules import told
from .similar import BROADCAST_IDS
from .words import PLANES, alnum

SHINGLE, BANDS, ROWS, ALIKE = 5, 6, 2, 0.8
#: Words of the openings that are compared, and the salt of what is compared besides: all words up to a place.
OPENINGS, WHOLE = (6, 16, 40), 1
#: Characters looked up in other texts, and how far from the end they stop: an edit in one stretch leaves the other.
STRETCH, BEFORE = 32, (0, 32)
#: Ids of texts in pairs that are broadcast (some 100 bytes each in the driver); more are looked up, and their texts written.
PAIRED = 250_000
#: Last characters of a cut text, which its copy holds where it goes on, at most so far from where an edit leads to expect it.
TAIL, SHIFT = 15, 12
#: Words of 64 bits of a bitmap of shingles.
BITMAP = 8
#: An item's last word ends so large a share of the items it is in; a name's letters so large a share of names.
WORD_ENDS, NAME_ENDS, KNOWN = 0.1, 0.3, 5
#: Words of the longest last line that needs no closing mark, and what such lines' counts must show.
LINE_WORDS, LINE_ENDS, LINE_SHARE = 8, 0.2, 0.02
#: The share of texts that end with a line is taken as the lower bound (Wilson) of so many deviations: more data make it surer, not easier.
SURE = 2.9
#: Lines held against all texts at once (some 200 bytes each in a task); more are taken in several passes.
LINES_AT_ONCE = 1_000_000
#: A limit's length has so many open texts, and so many times its neighbours'.
SPIKE, SPIKE_TEXTS, AROUND = 6.0, 8, 8

_VERDICT = pa.schema([("id", pa.int64()), ("kind", pa.string()), ("n", pa.int32()), ("word", pa.string()), ("tail", pa.string()), ("line", pa.string()), ("mark", pa.int64())])


def mark_of(text: str) -> int:
    """The same for equal texts."""
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def verdicts(texts: DataFrame) -> DataFrame:
    """(id, kind, n, word, tail, line, mark) of texts (id, role, text) that are cut for certain or open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, role, text in zip(*(batch.column(c).to_pylist() for c in ("id", "role", "text"))):
                kind, last = endings.judge(role, text)
                if kind == "item":
                    word = endings.word_of(last)
                    rows.append((i, kind, len(text), word, endings.tail(word), None, None))
                elif kind == "line":
                    words = endings.parts(last)
                    rows.append((i, kind, len(text), None, None, *((" ".join(words), mark_of(text)) if len(words) <= LINE_WORDS else (None, None))))
                elif kind == "cut":
                    rows.append((i, kind, len(text), None, None, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else [[]] * 7, _VERDICT)], schema=_VERDICT)

    return texts.mapInArrow(run, "id bigint, kind string, n int, word string, tail string, line string, mark bigint")


def word_ends(texts: DataFrame) -> DataFrame:
    """(word, ends, goes): how often a word, or a name's letters, ends a list item or stands within one."""
    schema = pa.schema([("word", pa.string()), ("ends", pa.int64()), ("goes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, goes = Counter(), Counter()
            for text in batch.column("text").to_pylist():
                for words in endings.items_of(text) if text else ():
                    if len(words) < 2:
                        continue
                    ends[endings.word_of(words[-1])] += 1
                    goes.update(map(endings.word_of, words[1:-1]))
                    if t := endings.tail(words[-1]):
                        ends[t] += 1
                        goes.update("^" + words[-1][i : i + 3] for i in range(1, len(words[-1]) - 3))
            keys = list(ends.keys() | goes.keys())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([ends[k] for k in keys], pa.int64()), pa.array([goes[k] for k in keys], pa.int64())], schema=schema)

    listed = texts.where(F.col("text").rlike(r"(?m)^\s*(?:[-*•+]|\d+[.)])\s"))
    return listed.select("text").mapInArrow(run, "word string, ends bigint, goes bigint").groupBy("word").agg(F.sum("ends").alias("ends"), F.sum("goes").alias("goes"))


#: The first words of a line, more than those of any line it is compared with.
_WORD = re.compile(r"[\s/]*([^\s/]*)")
_FIRST = re.compile(rf"[\s/]*(?:[^\s/]+[\s/]*){{0,{LINE_WORDS + 4}}}")


@lru_cache(1 << 16)
def first_word(word: str) -> str:
    return endings.shape(word)


def heads_of(lines: list[str]) -> tuple[set[str], set[str]]:
    """The first words of lines that have several, and the lines of one word, which a longer word may begin with."""
    return {x.split(" ", 1)[0] for x in lines if " " in x}, {x for x in lines if " " not in x}


def begins(lines: list[str], text: str, heads: tuple[set[str], set[str]] | None = None) -> set[int]:
    """Which of the sorted lines a line of the text begins with and goes on after, within the last word or behind it."""
    found: set[int] = set()
    words, alone = heads or heads_of(lines)
    for x in text.split("\n"):
        first = first_word(_WORD.match(x)[1])
        if first not in words and not (alone and any(first[:i] in alone for i in range(1, len(first) + 1))):
            continue
        x = " ".join(endings.parts(_FIRST.match(x)[0]))
        at = bisect_right(lines, x) - 1
        # what begins x is no greater than x and begins whatever lies between
        while at >= 0:
            y = lines[at]
            if x.startswith(y):
                if any(map(str.isalnum, x[len(y) :])):
                    found.add(at)
                y = y[:-1]
            else:
                n = next((i for i, (c, d) in enumerate(zip(x, y)) if c != d), min(len(x), len(y)))
                y = y[:n]
            if not y:
                break
            at = bisect_right(lines, y, hi=at) - 1
    return found


def continued(texts: DataFrame, lines: DataFrame) -> DataFrame:
    """(line, goes): in how many different texts a line begins with the line (line) and goes on."""
    spark, schema = texts.sparkSession, pa.schema([("key", pa.int64()), ("mark", pa.int64())])
    at = fresh(spark)
    keyed = keep(lines.select("line", F.xxhash64("line").alias("key")), at)
    passes = -(-keyed.count() // LINES_AT_ONCE)
    met = spark.createDataFrame([], "key bigint, mark bigint")
    for i in range(passes):

        def run(batches: Iterator[pa.RecordBatch], i=i) -> Iterator[pa.RecordBatch]:
            known, keys = lookups.lines(at, i, passes)
            heads = heads_of(known)
            for batch in batches:
                hits = [(keys[at], mark) for text in batch.column("text").to_pylist() if text and (got := begins(known, text, heads)) for mark in (mark_of(text),) for at in got]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*hits) if hits else [[]] * 2, schema)], schema=schema)

        met = met.union(texts.select("text").mapInArrow(run, "key bigint, mark bigint"))
    return met.distinct().groupBy("key").agg(F.count(F.lit(1)).alias("goes")).join(keyed, "key").select("line", "goes")


def line_ends(texts: DataFrame, open_: DataFrame) -> DataFrame:
    """(line, good): whether a text may end with such a line; equal texts count once.

    A line with words of its own goes on wherever a line of any text does. One of names and numbers only goes on in
    last lines, as any sentence may begin with a name.
    """
    own = keep(open_.where("kind = 'line' and line is not null").groupBy("line").agg(F.countDistinct("mark").alias("n"))).withColumn("w", F.split("line", " "))
    bare = ~F.col("line").rlike(r"[a-zß-ÿ]")
    longer = own.select(F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 1, F.lit(1))), lambda i: F.array_join(F.slice("w", 1, i), " "))).alias("start"), "n", "line").where("start <> line")
    longer = longer.groupBy(F.col("start").alias("line")).agg(F.sum("n").alias("goes")).where(bare)
    longer = longer.union(continued(texts, own.where(~bare).select("line")))
    begun = own.groupBy(F.array_join(F.slice("w", 1, 2), " ").alias("begin")).agg(F.sum("n").alias("group_n"))
    seen = own.withColumn("begin", F.array_join(F.slice("w", 1, 2), " ")).join(begun, "begin").join(longer, "line", "left").na.fill(0, ["goes"])
    every, zz = F.col("n") + F.col("goes"), F.lit(SURE * SURE)
    share = F.col("n") / every
    least = (share + zz / (2 * every) - SURE * F.sqrt(share * (1 - share) / every + zz / (4 * every * every))) / (1 + zz / every)
    return seen.select("line", ((least >= LINE_ENDS) & (F.col("n") / F.col("group_n") >= LINE_SHARE)).alias("good"))


def limits(open_: DataFrame) -> DataFrame:
    """(n, limit): lengths at which far more open texts end than around them."""
    sizes = open_.groupBy("n").agg(F.count(F.lit(1)).alias("own"))
    near = sizes.select(F.explode(F.sequence(F.col("n") - AROUND, F.col("n") + AROUND)).alias("n"), F.col("n").alias("m"), F.col("own").alias("c")).where("n <> m")
    near = near.groupBy("n").agg(F.sum("c").alias("c"))
    spikes = sizes.join(near, "n", "left").where((F.col("own") >= SPIKE_TEXTS) & (F.col("own") >= SPIKE * F.greatest(F.coalesce("c", F.lit(0)) / (2 * AROUND), F.lit(1.0))))
    return spikes.select("n", F.lit(True).alias("limit"))


def statistics(texts: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What ends items, what ends texts, and the lengths of limits, over all texts; found are their verdicts."""
    open_ = found.where("kind <> 'cut'")
    return keep(word_ends(texts)), keep(line_ends(texts, open_)), keep(limits(open_))


def scored(found: DataFrame, known: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """(id): texts whose own end shows that they were cut, from their verdicts."""
    counts, lines, lengths = known
    sure = found.where("kind = 'cut'").select("id")
    rated = found.where("kind <> 'cut'").join(counts, "word", "left").withColumnsRenamed({"ends": "we", "goes": "wg"})
    names = counts.where(F.col("word").startswith("^")).select(F.col("word").alias("tail"), F.col("ends").alias("te"), F.col("goes").alias("tg"))
    rated = rated.join(names, "tail", "left").join(lines, "line", "left").join(lengths, "n", "left").na.fill(0, ["we", "wg", "te", "tg"])
    seen = F.col("we") + F.col("wg") >= KNOWN
    word = F.when(seen, F.col("we") / (F.col("we") + F.col("wg")) >= WORD_ENDS).otherwise(F.coalesce(F.try_divide(F.col("te"), F.col("te") + F.col("tg")) >= NAME_ENDS, F.lit(False)))
    good = F.when(F.col("kind") == "item", word).otherwise(F.coalesce("good", F.lit(False)))
    return sure.union(rated.where(~good | F.coalesce("limit", F.lit(False))).select("id"))


def stem(text: str) -> str:
    """The text without blanks and an ellipsis at its end."""
    s = text.rstrip()
    return s[:-1] if s.endswith("…") else s[:-3] if s.endswith("...") else s


def ends_open(s: str) -> bool:
    """Whether s may have been cut where it ends; filler and lines of pages are not texts that were."""
    return len(s) >= TAIL and (s[-1].isalnum() or s[-1] in ",;-") and not told(s[s.rfind("\n") + 1 :])


def goes_on(s: str, long: str, at: int) -> bool:
    """Whether `long` goes on at a place inside the word or line where s ends."""
    if at >= len(long):
        return False
    stop = at
    while stop < len(long) and long[stop] == " ":
        stop += 1
    return s[-1].isalnum() and long[at].isalnum() or stop < len(long) and (long[stop].isalnum() or long[stop] in ",;")


@cache
def lowered() -> np.ndarray:
    """By code point: its lower case, where that is one; so places stay what they are."""
    out = np.arange(0x110000, dtype=np.uint32)
    out[:PLANES] = np.fromiter((ord(y) if len(y := chr(c).lower()) == 1 else c for c in range(PLANES)), np.uint32, PLANES)
    return out


class Sketches:
    """Texts' words, and bands of min-hashes over runs of three of the words that a text, or a text up to a place, begins with. A word that may be a part of one is in none."""

    def __init__(self, texts: list[str]) -> None:
        x = lowered()[points([t + "\n" for t in texts])]
        inside = np.zeros(len(x) + 1, np.int8)
        inside[1:] = alnum()[x]
        step = np.diff(inside)
        self.start, b = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        stop = ends_of(texts) + np.arange(1, len(texts) + 1)
        self.text = np.concatenate([[0], stop[:-1]])
        self.first = np.searchsorted(self.start, self.text, "left")
        #: Words of each text.
        self.size = np.searchsorted(self.start, stop, "left") - self.first
        words = Prefix(x).of(self.start, b)
        runs = np.zeros(len(words) + 1, U)
        if len(words) > 2:
            runs[: len(words) - 2] = words[2:] + U(3) * words[1:-1] + U(9) * words[:-2]
        runs = (mixed(runs) >> U(32)).astype(np.uint32)
        # the least from a text's first run on: a later text's values are all less than an earlier one's
        floor = np.repeat(np.arange(len(texts), 0, -1).astype(U) << U(32), np.append(self.size[:-1], self.size[-1] + 1))
        factors = np.random.default_rng(20250611).integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.least = [np.minimum.accumulate(floor + (runs * k).astype(U)) for k in factors]

    def bands(self, rows: np.ndarray, n: np.ndarray, salt: int) -> np.ndarray:
        """Of the first n words of texts, of more than two."""
        lanes = mixed(np.arange(1, BANDS * ROWS + 1, dtype=U))
        at = self.first[rows] + n - 3
        least = np.stack([x[at] for x in self.least], axis=1) & U(0xFFFFFFFF)
        return mixed(mixed(least + lanes).reshape(-1, BANDS, ROWS).sum(axis=2, dtype=U) + U(salt))

    def before(self, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Numbers of the words of texts up to places, without the last."""
        return np.minimum(np.searchsorted(self.start, self.text[rows] + places, "left") - self.first[rows], self.size[rows]) - 1


class Stretches:
    """Hashes of stretches of texts that are joined by line ends: polynomials of mixed characters, whose high bits are mixed enough."""

    def __init__(self, part: list[str]) -> None:
        self.points = points([t + "\n" for t in part])
        n = len(self.points)
        up, self.down = POWERS.to(n + 1)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(mixed_points()[self.points] * up[:n], out=self.sums[1:])

    def every(self, width: int = STRETCH) -> np.ndarray:
        """Of all of one width, by start."""
        n = max(0, len(self.sums) - width)
        return (self.sums[width:] - self.sums[:n]) * self.down[:n]

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]

    @cached_property
    def goes(self) -> np.ndarray:
        """By place whether goes_on() there, whatever stands before."""
        x = self.points
        out = alnum()[x] | (x == 44) | (x == 59)
        blank, other = np.flatnonzero(x == 32), np.flatnonzero(x != 32)
        out[blank] = out[other[np.searchsorted(other, blank)]]
        return out


@cache
def mixed_points() -> np.ndarray:
    return mixed(np.arange(1, 0x110001, dtype=U))


def ends(texts: DataFrame) -> DataFrame:
    """(id, tails, marks, keys) of the texts that end open: their stretches, these by where they stand and with the last characters, and with the bands of their longest opening and of all words too."""
    many = pa.list_(pa.int64())
    schema = pa.schema([("id", pa.int64()), ("tails", many), ("marks", many), ("keys", many)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for at, part in chunks(batch):
                own = [(i, s) for i, s in enumerate(map(stem, part)) if ends_open(s) and len(s) >= STRETCH]
                if not own:
                    continue
                drawn = Sketches([s for _, s in own])
                n = drawn.size - 1
                has = np.flatnonzero(n >= OPENINGS[0])
                if not len(has):
                    continue
                found = np.stack([Stretches([s[len(s) - STRETCH - k : len(s) - k] if len(s) >= STRETCH + k else s[-STRETCH:] for s in (own[i][1] for i in has)]).every()[:: STRETCH + 1] for k in BEFORE], axis=1)
                placed = found + np.array(BEFORE, U) + U(1)
                ending = placed + mixed(Stretches([own[i][1][-TAIL:] for i in has]).every(TAIL)[:: TAIL + 1])[:, None]
                opening = np.array(OPENINGS)[np.searchsorted(np.array(OPENINGS), n[has], "right") - 1]
                best = drawn.bands(has, opening, 0) + mixed(opening.astype(U))[:, None]
                keys = (np.concatenate([best, drawn.bands(has, n[has], WHOLE)], axis=1)[:, None, :] + ending[:, :, None]).reshape(len(has), -1)
                mine = ids[at : at + len(part)][np.array([own[i][0] for i in has], np.int64)]
                cols = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel().view(np.int64))) for x in (found, np.concatenate([placed, ending], axis=1), keys)]
                yield pa.RecordBatch.from_arrays([pa.array(mine, pa.int64()), *cols], schema=schema)

    return texts.select("id", "text").mapInArrow(run, "id bigint, tails array<bigint>, marks array<bigint>, keys array<bigint>")


#: The places near one, the nearest first, as where_it_goes_on() takes them.
NEAR = np.array(sorted(range(-SHIFT, SHIFT + 1), key=abs))


def going_on(x: Stretches, wanted: lookups.Values, own: np.ndarray, place: np.ndarray, start: np.ndarray, size: np.ndarray, exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the hit, place, hash) where texts (of a start and size) go on near the places of hits, after last characters that are wanted with the hit's stretch (own); exact: these stand at the hit itself."""
    near = place[:, None] + NEAR
    hit, n = np.nonzero((near >= TAIL) & (near < size[:, None]))
    to = near[hit, n]
    g = start[hit] + to
    ok = np.flatnonzero(x.points[g - 1] == x.points[(start + place)[hit] - 1]) if exact else slice(None)
    hit, to, g = hit[ok], to[ok], g[ok]
    ok = x.goes[g]
    hit, to, g = hit[ok], to[ok], g[ok]
    made = own[hit] + mixed(x.of(g - TAIL, g))
    ok = wanted.among(made)
    hit, to, made = hit[ok], to[ok], made[ok]
    # np.nonzero goes by hits and then from the nearest place on: the first of each hash is taken
    first = np.sort(np.unique(mixed(made + hit.astype(U)), return_index=True)[1])
    return hit[first], to[first], made[first]


def shingled(s: str) -> tuple[int, list[int]]:
    """The number of the shingles that ends_early() compares, and a bitmap of them: a bit set here only stands for a shingle at least that is only here."""
    words = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in s.lower().split()], U)
    runs = np.zeros(max(0, len(words) - SHINGLE + 1), U)
    for k in range(SHINGLE):
        runs = mixed(runs + words[k : k + len(runs)])
    runs = np.unique(runs)
    bits = np.zeros(BITMAP * 64, np.uint8)
    bits[(runs % U(BITMAP * 64)).astype(np.int64)] = 1
    return len(runs), np.packbits(bits).view(np.int64).tolist()


_BITS = [f"w{i}" for i in range(BITMAP)]


def places(texts: DataFrame, tails: str, keys: str) -> DataFrame:
    """(key, b, at, same, n, w0, ...): where texts go on, by what leads there: places by one of the stretches, the characters before and the bands, the latter among keys (both written as lookups).

    Equal texts up to a place have the same `same`; n and w0, ... are their shingled().
    """
    schema = pa.schema([("key", pa.int64()), ("b", pa.int64()), ("at", pa.int32()), ("same", pa.int64()), ("n", pa.int32()), *((w, pa.int64()) for w in _BITS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, wanted = lookups.values(tails), lookups.values(keys)
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for first, part in chunks(batch, most=1 << 17):
                x = Stretches(part)
                h = x.every()
                some = known.among(h)
                h = h[some]
                size = np.array([len(t) for t in part], np.int64)
                stop = np.cumsum(size + 1)
                start = stop - size - 1
                hits = []
                for k in BEFORE:
                    own = h + U(k + 1)
                    ok = wanted.among(own)
                    own, hit = own[ok], some[ok]
                    row = np.searchsorted(stop, hit, "right")
                    place = hit + STRETCH + k - start[row]
                    ok = (place < size[row]) if not k else (place != size[row]) & (place - SHIFT < size[row])
                    row, place = row[ok], place[ok]
                    on, to, made = going_on(x, wanted, own[ok], place, start[row], size[row], not k)
                    hits.append((row[on], place[on], to, made))
                row, place, to, own = (np.concatenate(c) for c in zip(*hits))
                if not len(row):
                    continue
                met, local = np.unique(row, return_inverse=True)
                drawn = Sketches([part[i] for i in met])
                found = []
                for n in (*OPENINGS, None):
                    words = drawn.before(local, place) if n is None else np.full(len(row), n)
                    has = np.flatnonzero((words >= OPENINGS[0]) & (words < drawn.size[local]))
                    made = drawn.bands(local[has], words[has], WHOLE) if n is None else drawn.bands(local[has], words[has], 0) + mixed(words[has].astype(U))[:, None]
                    made = (made + own[has][:, None]).ravel()
                    here = wanted.among(made)
                    found.append((made[here], has[here // BANDS]))
                key, i = (np.concatenate(c) for c in zip(*found))
                if not len(i):
                    continue
                at, each = np.unique(np.stack([row[i], to[i]]), axis=1, return_inverse=True)
                at, each = at.T, each.ravel()
                same = mixed(x.of(start[at[:, 0]], start[at[:, 0]] + at[:, 1]) + mixed(at[:, 1].astype(U)))
                counts, bits = zip(*(shingled(part[r][:p]) for r, p in at.tolist()))
                cols = [key.view(np.int64), ids[first : first + len(part)][row[i]], to[i].astype(np.int32), same.view(np.int64)[each], np.array(counts, np.int32)[each], *np.array(bits, np.int64).T[:, each]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return texts.select("id", "text").mapInArrow(run, ", ".join(["key bigint, b bigint, at int, same bigint, n int", *(f"{w} bigint" for w in _BITS)]))


def where_it_goes_on(s: str, long: str, at: int) -> int | None:
    """The place nearest to `at` where `long` goes on after what s ends with."""
    tail, found, i = s[-TAIL:], [], max(0, at - SHIFT - TAIL) - 1
    while (i := long.find(tail, i + 1, at + SHIFT)) >= 0:
        if goes_on(s, long, i + TAIL):
            found.append(i + TAIL)
    return min(found, key=lambda p: abs(p - at), default=None)


def ends_early(short: str, long: str, at: int) -> bool:
    """Whether `long` is a near-copy up to a place at or near `at` and goes on there inside the word, sentence or block where `short` ends."""
    s = stem(short)
    place = where_it_goes_on(s, long, at)
    if place is None:
        return False
    x, y = ({tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)} for w in (s.lower().split(), long[:place].lower().split()))
    # the copy's last word may be a part of one
    return len(x & y) >= ALIKE * max(1, len(x | y) - SHINGLE)


def texts_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, text) of the ids, which are written and distinct."""
    n = ids.count()
    if n <= PAIRED:
        return texts.join(F.broadcast(ids), "id", "left_semi").select("id", "text")
    at = lookups.written(ids, n)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.take(pa.array(lookups.values(at).among(batch.column("id").to_numpy().view(U))))

    return keep(texts.select("id", "text").mapInArrow(wanted, "id bigint, text string"))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(id): the a of those pairs (a, b, at) that hold."""
    pairs = keep(pairs)
    own = texts_of(keep(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()), texts)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f[np.array([ends_early(x, y, p) for x, y, p in zip(f["ta"], f["tb"], f["at"])], bool)][["a"]].rename(columns={"a": "id"})

    ta, tb = (own.select(F.col("id").alias(x), F.col("text").alias(f"t{x}")) for x in "ab")
    return keep(pairs.join(ta, "a").join(tb, "b").select("a", "ta", "tb", "at").mapInPandas(run, "id bigint").distinct())


def sizes(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, own_n, own_w0, ...): shingled() of the texts of the ids."""
    names = ["own_n", *(f"own_{w}" for w in _BITS)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [shingled(stem(t)) for t in f["text"]]
            yield pd.DataFrame([(i, n, *w) for i, (n, w) in zip(f["id"], got)], columns=["a", *names])

    return keep(texts_of(ids, texts).mapInPandas(run, ", ".join(["a bigint, own_n int", *(f"{x} bigint" for x in names[1:])])))


def may_agree() -> Column:
    """Whether no more shingles than a near-copy may have are in one of two bitmaps only: true of all pairs that ends_early() takes."""
    alone = lambda x, y: sum((F.bit_count(F.col(x.format(w)).bitwiseAND(F.bitwise_not(F.col(y.format(w))))) for w in _BITS), F.lit(0))
    both = F.least(F.col("own_n") - alone("own_{}", "{}"), F.col("n") - alone("{}", "own_{}"))
    return both + 1e-6 >= ALIKE * F.greatest(F.lit(1), F.col("own_n") + F.col("n") - both - SHINGLE)


def early_copies(texts: DataFrame) -> DataFrame:
    """(id): texts of which a near-copy goes on where they end; those of fewer than seven words or 32 characters have none.

    An open text is first held against one text of each of its keys, which is linear, and only if none of these goes on, against all
    whose shingles may agree, of equal ones two (the open text may be one of them).
    """
    opened = keep(ends(texts))
    n = opened.count()
    if not n:
        return opened.select("id")
    tails, keys = (lookups.written(opened.select(F.explode(c)), n * len(BEFORE) * each) for c, each in (("tails", 1), (F.concat("marks", "keys"), 2 + 2 * BANDS)))
    met = places(texts, tails, keys)
    met, posted = keep(met), opened.select(F.col("id").alias("a"), F.explode("keys").alias("key"))
    posted = keep(posted.join(met.select("key").distinct(), "key", "left_semi"))
    one = met.groupBy("key").agg(F.max(F.struct("b", "at")).alias("m"), F.min(F.struct("b", "at")).alias("l"))
    one = keep(posted.join(one, "key").select("a", F.explode(F.array("m", "l")).alias("m")).select("a", "m.b", "m.at").where("a <> b").distinct())
    sure = confirmed(one, texts)
    posted = posted.join(sure.withColumnRenamed("id", "a"), "a", "left_anti")
    own = sizes(keep(posted.select(F.col("a").alias("id")).distinct()), texts)
    each = met.groupBy("key", "same").agg(F.max(F.struct("b", "at")).alias("m"), F.min(F.struct("b", "at")).alias("l"), *(F.first(c).alias(c) for c in ("n", *_BITS)))
    left = posted.join(own, "a").join(each, "key").where(may_agree()).select("a", F.explode(F.array("m", "l")).alias("m")).select("a", "m.b", "m.at").where("a <> b").distinct()
    return sure.union(confirmed(left.join(one, ["a", "b", "at"], "left_anti"), texts))


def cut_texts(texts: DataFrame) -> DataFrame:
    """(id): the texts of (id, role, text) that were cut, once each.

    Null and blank texts are not cut; rows with a null id are left out; of repeated ids each text is judged.
    """
    texts = texts.where(F.col("id").isNotNull() & F.col("text").rlike(r"\w"))
    found = keep(verdicts(texts))
    return scored(found, statistics(texts, found)).union(early_copies(texts)).distinct()
