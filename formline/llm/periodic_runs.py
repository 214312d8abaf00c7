"""Periodic runs of words in whole texts, and texts without their repetitions.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) that is at least
2 q and ``min_length`` words long and that no neighbouring word extends. Every run holds two neighbouring
points of the grid 0, q, 2 q, ... of its period, so for each q the neighbouring grid points (n log n pairs in
all) are compared. Where their words are equal, the longest common extensions to the right and left
say how far period q reaches. Stretches found with several periods have the smallest of them.

Extensions use a difference cover modulo ``MODULUS``: for any two places a shift below it takes both to
sampled places. A few words are compared up to there; if they are all equal, the rest is the minimum, from
a sparse table, of the common prefixes of neighbours in the sorted order of the sampled suffixes.
Only those are sorted: by their first words, then by doubling the names of what follows. Texts whose pairs
all differ within a few words, as most do, sort nothing.

Rows are not moved; a task needs memory for one text at a time (about 100 bytes a word).

Defined cases: a null or empty text has no words, no runs and collapses to an empty text; rows with null ids
are treated like any other; repeated rows give repeated results; an empty table gives an empty result; columns
other than the id and the text are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.common import steps, texts_of

#: Every remainder modulo 13 is a difference of two of these.
MODULUS = 13
COVER = (0, 1, 3, 9)
MIN_LENGTH = 12
#: Places whose pairs with earlier grid points are compared together.
GRID_STEP = 1 << 16
_EMPTY = np.zeros((0, 3), np.int64)


def _shifts() -> np.ndarray:
    """Per pair of remainders the least shift that takes both into the cover."""
    inside = np.isin(np.arange(MODULUS), COVER)
    return np.array(
        [
            [next(d for d in range(MODULUS) if inside[(a + d) % MODULUS] and inside[(b + d) % MODULUS]) for b in range(MODULUS)]
            for a in range(MODULUS)
        ]
    )


_SHIFT = _shifts()
_RANK_IN_COVER = np.searchsorted(COVER, np.arange(MODULUS))


class SampledSuffixes:
    """Order of the sampled suffixes of ``symbols`` (integers above 0) and common prefixes of any two of them."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.padded = np.concatenate([symbols.astype(np.int64), np.zeros(2 * MODULUS, np.int64)])
        blocks = -(-n // MODULUS)
        places = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)).ravel()
        self.places = places[places < n]
        levels = self._sorted_names()
        self.rank = levels[-1] - 1
        order = np.empty_like(self.rank)
        order[self.rank] = np.arange(len(order))
        self.table = self._minima(self._neighbours(order, levels))

    def _sorted_names(self) -> list[np.ndarray]:
        """Order-keeping names, from 1, of the first MODULUS words, of twice as many, ... until all differ."""
        bits = max(int(self.padded.max()).bit_length(), 1)
        per_key = 63 // bits
        keys = []
        for first in range(0, MODULUS, per_key):
            key = np.zeros(len(self.places), np.int64)
            for k in range(first, min(first + per_key, MODULUS)):
                key = key << bits | self.padded[self.places + k]
            keys.append(key)
        levels = [self._named(keys)]
        step = len(COVER)
        while len(self.places) and levels[-1].max() < len(self.places):
            names = levels[-1]
            behind = np.zeros_like(names)
            behind[:-step] = names[step:]  # the same remainder, further on by what a name covers
            levels.append(self._named([names * (len(names) + 1) + behind]))
            step *= 2
        return levels

    @staticmethod
    def _named(keys: list[np.ndarray]) -> np.ndarray:
        order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
        fresh = np.zeros(len(order), bool)
        for key in keys:
            fresh[1:] |= key[order[1:]] != key[order[:-1]]
        fresh[:1] = True
        names = np.empty(len(order), np.int64)
        names[order] = np.cumsum(fresh)
        return names

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Words that each suffix, in order, shares with the one before it."""
        a, b = order[:-1].copy(), order[1:].copy()
        shared = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 2, -1, -1):
            names = np.append(levels[level], 0)
            same = (names[a] == names[b]) & (names[a] > 0)
            shared += same * (MODULUS << level)
            move = same * (len(COVER) << level)
            a, b = np.minimum(a + move, len(order)), np.minimum(b + move, len(order))
        places = np.append(self.places, len(self.padded) - 2 * MODULUS)
        x, y = places[a], places[b]
        left = np.arange(len(x))
        for k in range(MODULUS):
            left = left[(self.padded[x[left] + k] == self.padded[y[left] + k]) & (self.padded[x[left] + k] > 0)]
            if not len(left):
                break
            shared[left] += 1
        return np.concatenate([[0], shared])[: len(order)]

    @staticmethod
    def _minima(values: np.ndarray) -> list[np.ndarray]:
        """A sparse table: minima of 1, 2, 4, ... values from each place on."""
        table = [values.astype(np.int32)]
        while 2 << (len(table) - 1) <= len(values):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return table

    def shared(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common prefixes of the suffixes at the sampled places ``x`` and ``y`` (not equal)."""
        blocks, rest = np.divmod(np.stack([x, y]), MODULUS)
        ranks = self.rank[blocks * len(COVER) + _RANK_IN_COVER[rest]]
        low, high = ranks.min(axis=0) + 1, ranks.max(axis=0) + 1
        width = high - low
        level = np.frexp(width)[1] - 1  # the largest power of two within
        out = np.empty(len(x), np.int64)
        for k in np.unique(level):
            rows = np.flatnonzero(level == k)
            row = self.table[k]
            out[rows] = np.minimum(row[low[rows]], row[high[rows] - (1 << k)])
        return out


class Extensions:
    """Longest common extensions to the right of pairs of places; sorts suffixes when first needed."""

    def __init__(self, symbols: np.ndarray):
        self.symbols = symbols
        self.padded = np.concatenate([symbols, np.zeros(2 * MODULUS, symbols.dtype)])
        self.suffixes: SampledSuffixes | None = None

    def of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For places ``x`` < ``y`` (up to the end) the number of equal words from there on."""
        shift = _SHIFT[x % MODULUS, y % MODULUS] + MODULUS  # so few pairs get there that most texts sort nothing
        out = np.zeros(len(x), np.int64)
        left = np.arange(len(x))
        sampled = []
        for k in range(2 * MODULUS):
            if k >= MODULUS:
                due = shift[left] == k
                sampled.append(left[due])
                left = left[~due]
            if not len(left):
                break
            left = left[self.padded[x[left] + k] == self.padded[y[left] + k]]
            out[left] += 1
        rows = np.concatenate(sampled) if sampled else left
        rows = rows[y[rows] + shift[rows] < len(self.symbols)]
        if len(rows):
            if self.suffixes is None:
                self.suffixes = SampledSuffixes(self.symbols)
            out[rows] += self.suffixes.shared(x[rows] + shift[rows], y[rows] + shift[rows])
        return out


@cache
def _first_grid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _grid(0, GRID_STEP)


def _grid(low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (place, period) with ``low`` <= place < ``high`` and the period dividing the place, by place.

    The third array is the number of pairs before each place.
    """
    periods = np.arange(1, high)
    first = np.maximum(-(-low // periods), 1) * periods
    counts = np.maximum(-(-(high - first) // periods), 0)
    q = np.repeat(periods, counts)
    turn = np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(first, counts) + turn * q
    order = np.argsort(at, kind="stable")
    before = np.concatenate([[0], np.cumsum(np.bincount(at - low, minlength=high - low))])
    return at[order].astype(np.int32), q[order].astype(np.int32), before


def find_runs(symbols: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """All runs of ``symbols`` (integers above 0) as rows (start, length, period), by start, then period."""
    n = len(symbols)
    if n < max(min_length, 2):
        return _EMPTY
    right, left = Extensions(symbols), Extensions(symbols[::-1])
    found = _EMPTY
    for low in range(0, n, GRID_STEP):
        at, q, before = _first_grid() if low == 0 else _grid(low, min(low + GRID_STEP, n))
        end = before[min(n - low, GRID_STEP)]
        at, q = at[:end], q[:end]
        hits = np.flatnonzero(symbols[at] == symbols[at - q])
        hits = hits[q[hits] <= n // 2]
        if not len(hits):
            continue
        y, period = at[hits].astype(np.int64), q[hits].astype(np.int64)
        ahead = right.of(y - period, y)
        behind = left.of(n - y, n - y + period)
        length = ahead + behind + period
        good = length >= np.maximum(2 * period, min_length)
        rows = np.stack([(y - period - behind)[good], length[good], period[good]], axis=1)
        found = _smallest_periods(np.concatenate([found, rows]))
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _smallest_periods(rows: np.ndarray) -> np.ndarray:
    """One row per stretch, with its smallest period."""
    if len(rows) < 2:
        return rows
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    return rows[np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each of ``n`` words stays: not those of a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def runs_of(text: bytes, min_length: int = MIN_LENGTH) -> tuple[int, np.ndarray, bytes]:
    """Number of words, runs, and the words that stay, joined by single spaces."""
    words = text.split()
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words), 1)}
    symbols = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
    runs = find_runs(symbols, min_length)
    if len(runs):
        return len(words), runs, b" ".join(compress(words, kept_words(len(words), runs).tolist()))
    return len(words), runs, b" ".join(words)


RUN = "struct<start: bigint, length: bigint, period: bigint>"


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH
) -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, ``runs`` (by start, then period) and ``collapsed``, the text without repetitions."""
    source = texts_of(docs, id_col, text_col)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in steps(batches, "text"):
            found = [runs_of(t, min_length) for t in raw]
            flat = np.concatenate([r for _, r, _ in found])
            borders = np.concatenate([[0], np.cumsum([len(r) for _, r, _ in found])])
            parts = [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)]
            runs = pa.ListArray.from_arrays(
                pa.array(borders, pa.int32()), pa.StructArray.from_arrays(parts, ["start", "length", "period"])
            )
            collapsed = pa.array([c for _, _, c in found], pa.binary()).cast(pa.string())
            sizes = pa.array([n for n, _, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, runs, collapsed], ["id", "n_words", "runs", "collapsed"])

    fields = f"id {source.schema['id'].dataType.simpleString()}, n_words bigint, runs array<{RUN}>, collapsed string"
    return source.mapInArrow(tasks, fields).select(F.col("id").alias(id_col), "n_words", "runs", "collapsed")


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): every tenth text, by the crc32 of its id, turned periodic from some word on.

    With h the crc32, g = h div 10 and n words, the words from a = g mod n on repeat the first
    p = 1 + (n - a) div (3 + g mod 8) of them. Other texts, those of null ids and those without words stay.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = F.when(h % 10 == 0, words)
    n = F.size("words")
    a = F.pmod("g", n).cast("int")
    p = (F.floor((n - F.col("a")) / (F.pmod("g", F.lit(8)) + 3)) + 1).cast("int")
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    planted = F.array_join(F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), repeated), F.lit(1), n), " ")
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), g.alias("g"), chosen.alias("words"))
        .withColumn("a", F.when(n > 0, a))
        .withColumn("p", p)
        .select(F.col("id").alias(id_col), F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias(text_col))
    )


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the longest run and SHA-256 digests of what ``periodic_runs`` returns."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("best")
    return found.withColumn("best", longest).select(
        id_col,
        F.size("runs").cast("bigint").alias("n_runs"),
        (-best["s"]).alias("start"),
        best["l"].alias("length"),
        (-best["q"]).alias("period"),
        F.floor(1000 * best["l"] / -best["q"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
