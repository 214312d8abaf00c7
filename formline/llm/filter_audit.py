"""Audit of how filters interact: what each removes in every order of application.

Per part of the documents and per filter the failing documents are kept as sorted posting lists, in ranges
of ids. Within a range, galloping k-way merges give the union of every set of filters and galloping
differences what one filter adds to it; the sizes are added up over the ranges. A filter's effect in an order
depends only on the set of filters before it, so n * 2 ** (n - 1) differences serve all n! orders.

``text_failures`` applies five filters to whole texts; ``interactions`` audits any filters whose failures
come as a bit mask; ``audit`` strings them together.

No task holds a part: rows equal in id, part and failures are counted before they are shuffled, lists are
built over runs of at most ``RANGE_ROWS`` rows, and texts equal to a thousandth of all rows or more (a
thousand texts at most) find their first document by a broadcast, others by a join.

Defined cases: a null or empty text has no words (it fails A) and equals all other such texts; a null part is
the empty one; a null id never has a smaller one, is smaller than none and has no labels; repeated rows count as
often as they occur, and equal ids are not smaller than each other; of several labels of a document any that
is 1 counts; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import accumulate, permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from formline.llm.common import steps, written

#: Names of the filters that ``audit`` applies, in the order of their bits.
FILTERS = "ABCDE"
MIN_WORDS = 100
LEAST_DISTINCT = 80
MOST_CAPITALS = 10
#: Filters an audit takes at most: results have a row per part, order and step.
MAX_FILTERS = 6
#: Rows of one posting range, and ids that are shuffled together.
RANGE_ROWS = 8_192
RANGE_IDS = 16_384
#: A text is hot if its copies are at least this share of all rows.
HOT_SHARE = 1_000
#: Bytes of a text that are cut into words at a time.
CUT_BYTES = 1_000_000
_GAP = re.compile(rb"[ \t-\r]")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUED = bytes(range(0x80, 0xC0))
_SYMBOL = re.compile(rb"[#$%&*|]")


def word_numbers(text: bytes) -> tuple[int, int]:
    """Number of words and of distinct words; only the distinct ones of a long text are held."""
    if len(text) <= CUT_BYTES:
        words = text.split()
        return len(words), len(set(words))
    total, distinct, at = 0, set(), 0
    while at < len(text):
        gap = _GAP.search(text, at + CUT_BYTES)
        end = gap.start() if gap else len(text)
        words = text[at:end].split()
        total += len(words)
        distinct.update(words)
        at = end
    return total, len(distinct)


def failures_of(text: bytes) -> int:
    """Bits of the filters A to D that the whole text fails."""
    words, distinct = word_numbers(text)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUED))
    return (
        (words < MIN_WORDS)
        | (100 * distinct < LEAST_DISTINCT * words) << 1
        | (100 * capitals > MOST_CAPITALS * points) << 2
        | (_SYMBOL.search(text) is not None) << 3
    )


def text_failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, fails) of every row of ``docs``: bits 0 to 4 for the filters A to E."""
    source = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).alias("text"),
    )

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in steps(batches, "text"):
            fails = pa.array([failures_of(t) for t in raw], pa.int32())
            digests = pa.array([hashlib.sha256(t).digest() for t in raw], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), fails, digests], ["id", "part", "fails", "digest"]
            )

    fields = f"id {source.schema['id'].dataType.simpleString()}, part string, fails int, digest binary"
    slim = written(source.mapInArrow(tasks, fields), "audit-texts")
    return _with_repeats(slim, 1 << 4)


def _with_repeats(slim: DataFrame, bit: int) -> DataFrame:
    """(id, part, fails) with ``bit`` set where a smaller id has the same digest."""
    copies = (
        slim.groupBy("digest")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
        .where(F.col("first") < F.col("last"))
        .drop("last")
    )
    copies = written(copies, "audit-copies")
    least = slim.count() / HOT_SHARE
    hot = F.broadcast(copies.where(F.col("n") >= least).drop("n"))
    cold = copies.where(F.col("n") < least).drop("n")
    both = slim.join(hot, "digest").unionByName(slim.join(hot, "digest", "left_anti").join(cold, "digest", "left"))
    later = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return both.select("id", "part", F.when(later, F.col("fails").bitwiseOR(bit)).otherwise(F.col("fails")).alias("fails"))


def gallop(values: list[int], least: int, at: int) -> int:
    """First place from ``at`` on whose value is ``least`` or more, found in doubling steps."""
    n, step, low = len(values), 1, at
    while at < n and values[at] < least:
        low, at, step = at + 1, at + step, 2 * step
    return bisect_left(values, least, low, min(at, n))


def union(lists: list[list[int]]) -> list[int]:
    """Sorted distinct values of sorted lists, copied run by run."""
    lists = [v for v in lists if v]
    if len(lists) == 1:
        return lists[0]
    heads = [(v[0], k) for k, v in enumerate(lists)]
    heapify(heads)
    at, out = [0] * len(lists), []
    while heads:
        _, k = heappop(heads)
        values, start = lists[k], at[k]
        if not heads:
            out += values[start:]
            break
        end = gallop(values, heads[0][0], start)
        out += values[start:end]  # nothing where another list holds the same value
        at[k] = end = max(end, start + 1)
        if end < len(values):
            heappush(heads, (values[end], k))
    return out


def difference(values: list[int], without: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of places of ``values`` whose values are not in ``without``."""
    i = j = 0
    while i < len(values):
        j = gallop(without, values[i], j)
        if j == len(without):
            yield i, len(values)
            return
        if without[j] == values[i]:
            i, j = i + 1, j + 1
            continue
        end = gallop(values, without[j], i)
        yield i, end
        i = end


def audited_range(fails: list[int], weights: list[list[int]], n_filters: int) -> list[tuple[int, ...]]:
    """Sizes in one range of documents, numbered in the order of their ids.

    ``weights`` are what a document counts: as a document, as a good one, as a toxic one. Per filter and
    set of filters before it: kept, removed, redundant, failing this filter only, good and toxic removed.
    """
    lists = [[i for i, f in enumerate(fails) if f >> k & 1] for k in range(n_filters)]
    sums = [[[0, *accumulate(w[i] for i in places)] for w in weights] for places in lists]
    every = [0, *accumulate(weights[0])]
    unions, sizes = [], []
    for chosen in range(1 << n_filters):
        unions.append(union([lists[k] for k in range(n_filters) if chosen >> k & 1]))
        sizes.append(sum(map(weights[0].__getitem__, unions[-1])))
    everything = (1 << n_filters) - 1
    rows, alone = [], {}
    for k in range(n_filters):
        for before in range(1 << n_filters):
            if before >> k & 1:
                continue
            spans = list(difference(lists[k], unions[before]))
            removed, good, toxic = (sum(s[b] - s[a] for a, b in spans) for s in sums[k])
            if before == everything - (1 << k):
                alone[k] = removed
            rows.append((k, before, every[-1] - sizes[before | 1 << k], removed, sums[k][0][-1] - removed, good, toxic))
    return [(*r[:5], alone[r[0]], *r[5:]) for r in rows]


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def interactions(failing: DataFrame, labels: DataFrame, names: str = FILTERS, label_id: str = "doc_id") -> DataFrame:
    """Per part, order of the filters and step: what is kept, removed and lost there.

    ``failing`` has the columns id, part and fails (one bit per name), one row per document; ``labels`` the
    id, quality and toxic. The result has a row for every part of ``failing``, order and step.
    """
    n = len(names)
    if not 1 <= n <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters are audited")
    marks = labels.groupBy(F.col(label_id).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    counted = failing.groupBy("id", "part", "fails").agg(F.count("*").alias("n")).join(marks, "id", "left")
    whole = isinstance(failing.schema["id"].dataType, IntegralType)
    of_range = F.floor(F.col("id") / RANGE_IDS) if whole else F.pmod(F.xxhash64("id"), F.lit(RANGE_IDS))
    ordered = (
        counted.select(
            "part", "id", "fails", "n", *(F.coalesce(m, F.lit(0)).alias(m) for m in ("good", "toxic")), of_range.alias("range")
        )
        .repartition("part", "range")
        .sortWithinPartitions("part", "id", "fails")
        .select("part", "fails", "n", "good", "toxic")
    )

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _ranges(batches):
            fails, docs, good, toxic = (list(c) for c in zip(*rows, strict=True))
            weights = [docs, [a * b for a, b in zip(docs, good, strict=True)], [a * b for a, b in zip(docs, toxic, strict=True)]]
            found = audited_range(fails, weights, n)
            columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), [pa.int32()] * 2 + [pa.int64()] * 6, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(found)), *columns], ["part", "filter", "before", *COUNTS])

    fields = "part string, filter int, before int, " + ", ".join(f"{c} bigint" for c in COUNTS)
    sizes = ordered.mapInArrow(tasks, fields).groupBy("part", "filter", "before").agg(*(F.sum(c).alias(c) for c in COUNTS))
    # a set of filters comes first, and the rest last, in so many orders
    times = F.element_at(F.array(*(F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n))), F.bit_count("before") + 1)
    shares = sizes.withColumn("shapley", F.sum(F.col("removed") * times).over(Window.partitionBy("part", "filter")))
    return shares.join(F.broadcast(_orders(failing.sparkSession, names)), ["filter", "before"]).select(
        "part", "filter_order", "step", *COUNTS, "shapley"
    )


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int, int, int]]]]:
    """Runs of rows of one part, ``RANGE_ROWS`` at most, of rows sorted by part and id."""
    now, held = None, []
    for batch in batches:
        parts, *columns = (c.to_pylist() for c in batch.columns)
        for part, row in zip(parts, zip(*columns, strict=True), strict=True):
            if held and (part != now or len(held) >= RANGE_ROWS):
                yield now, held
                held = []
            now = part
            held.append(row)
    if held:
        yield now, held


def _orders(spark: SparkSession, names: str) -> DataFrame:
    """(filter_order, step, filter, before) of every step of every order; its size depends on the names only."""
    rows = []
    for order in permutations(range(len(names))):
        before = 0
        for step, k in enumerate(order, 1):
            rows.append(("".join(names[i] for i in order), step, k, before))
            before |= 1 << k
    return spark.createDataFrame(rows, "filter_order string, step int, filter int, before int")


def audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """``interactions`` of the five filters on whole texts, per value of ``part_col``."""
    return interactions(text_failures(docs, id_col, text_col, part_col), labels, label_id=id_col)
