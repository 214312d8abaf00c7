"""Removal of long byte strings that occur more than once, by distributed suffix sorting.

Every byte covered by a string of ``length`` bytes that also starts anywhere else goes. Suffixes are
sorted by difference covers (``suffix_sort``); how the suffixes of a corpus get into sorts of bounded size:

1. **Owners.** Each string of ``length`` bytes is owned by the ``GRAM``-byte window in it whose hash is
   smallest (leftmost among equals), so equal strings have equal owners. Owners that occur once cannot
   own a repeated string; counting owner hashes leaves the others. Counts are partial before the shuffle.
2. **Pieces.** The strings of one owner occurrence start side by side and form a piece of text. Equal
   pieces are counted and handled once, through one occurrence: all their strings repeat.
3. **Sorting.** Where an owner has different pieces, these go, with their text, to one of many buckets
   by owner. A bucket's suffixes are ranked by difference covers and neighbours' prefixes compared;
   strings of one class occur as often as its pieces do. The pieces of an owner with very many are cut into
   their strings, which are counted by hashes of 128 bits, partial before the shuffle: a string that many
   documents share is a few rows of counts, and no task gathers a common passage.
4. **Spans.** Repeated strings are joined back to all occurrences of their pieces and merged per text.

Texts with repeated owners are stored once, bucketed by text key, and joined there without moving.
Nothing is collected but two numbers.

Defined cases: a null or empty text has no bytes and no spans; texts under ``length`` bytes lose nothing;
identical texts of ``length`` bytes or more lose everything, also when all columns agree (repeated rows);
a null id is kept as it is; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.common import memory_of, steps, unused, written
from formline.llm.suffix_sort import equal_prefix_classes
from formline.session import fresh_path

GRAM = 64
#: Bytes that one vectorised step looks at; longer texts are cut with an overlap.
STEP = 500_000
#: Bytes of pieces per sort, on average, and pieces of one owner beyond which its strings are counted singly.
SORT_BYTES = 500_000
HOT_PIECES = 20_000
_BASE = 0x9E3779B97F4A7C15
_HIGH = np.uint64(0xFFFFFFFF00000000)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


def _window_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``GRAM`` bytes, from prefix sums of a polynomial modulo 2**64."""
    n = len(data)
    powers = memory_of(__name__)
    if not powers or len(powers[0]) < n:
        powers[:] = [_powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)]
    total = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[0][:n])
    h = total[GRAM - 1 :].copy()
    h[1:] -= total[:-GRAM]
    h *= powers[1][: len(h)]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(x) - width + 1
    blocks = np.concatenate([x, np.full(-len(x) % width, np.uint64(2**64 - 1))]).reshape(-1, width)
    forth = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], forth[width - 1 : width - 1 + n])


def owners(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of texts laid end to end: (first start, last start, owner hash, text number).

    ``ends`` are the texts' ends in ``data``. Strings never reach beyond their text.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none.astype(np.uint64), none
    h = _window_hashes(data)
    place = np.arange(len(h), dtype=np.uint64)
    least = _sliding_minimum((h & _HIGH) | place, length - GRAM + 1)
    at = (least & ~_HIGH).astype(np.int64)
    sizes = np.diff(ends, prepend=0)
    text = np.repeat(np.arange(len(ends)), sizes)[: len(at)]
    starts = np.flatnonzero(np.arange(len(at)) + length <= ends[text])
    if not len(starts):
        return none, none, none.astype(np.uint64), none
    owner = at[starts]
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    last = np.append(first[1:], len(starts)) - 1
    return starts[first], starts[last], h[owner[first]], text[starts[first]]


def pieces_of(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, first start, last start, owner hash) of all pieces, starts counted inside the text.

    Texts are looked at together, or, when one is longer than a step, in parts that overlap by ``length``.
    """
    if len(texts) == 1 and len(texts[0]) > STEP + length:
        raw = texts[0]
        for at in range(0, len(raw) - length + 1, STEP):
            part = np.frombuffer(raw, np.uint8, min(STEP + length - 1, len(raw) - at), at)
            first, last, owner, _ = owners(part, np.array([len(part)]), length)
            yield np.zeros(len(first), np.int64), first + at, last + at, owner
        return
    ends = np.cumsum([len(t) for t in texts])
    first, last, owner, text = owners(np.frombuffer(b"".join(texts), np.uint8), ends, length)
    begin = (ends - np.array([len(t) for t in texts]))[text]
    yield text, first - begin, last - begin, owner


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text as bytes, n, k1, k2): equal texts have equal keys of 128 bits."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id", "text", F.octet_length("text").cast("bigint").alias("n"),
        F.xxhash64("text").alias("k1"), F.xxhash64(F.lit("text"), "text").alias("k2"),
    )


def _owner_rows(texts: DataFrame, length: int, keys: bool) -> DataFrame:
    """(h) or (h, k1, k2) per owner occurrence."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in steps(batches, "text", STEP):
            for text, _, _, owner in pieces_of(raw, length):
                columns = [pa.array(owner.view(np.int64))]
                if keys:
                    columns += [batch.column(c).take(pa.array(text)) for c in (1, 2)]
                yield pa.RecordBatch.from_arrays(columns, ["h", "k1", "k2"][: len(columns)])

    columns = ["text", "k1", "k2"] if keys else ["text"]
    return texts.select(*columns).mapInArrow(tasks, "h bigint, k1 bigint, k2 bigint" if keys else "h bigint")


def _piece_rows(stored: DataFrame, length: int) -> DataFrame:
    """(h, p, k1, k2, s0, s1) per piece of an owner that occurs more than once; p is a 128-bit hash."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in steps(batches, "text", STEP):
            repeated = np.unique(batch.column(3).flatten().to_numpy(zero_copy_only=False))
            for text, first, last, owner in pieces_of(raw, length):
                rows = np.flatnonzero(np.isin(owner.view(np.int64), repeated))
                text, first, end = text[rows], first[rows], last[rows] + length
                hashes = [
                    xxhash.xxh128_digest(raw[t][a:b])
                    for t, a, b in zip(text.tolist(), first.tolist(), end.tolist(), strict=True)
                ]
                number = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(owner[rows].view(np.int64)), pa.array(hashes, pa.binary()),
                        batch.column(1).take(number), batch.column(2).take(number),
                        pa.array(first.astype(np.int32)), pa.array(end.astype(np.int32)),
                    ],
                    ["h", "p", "k1", "k2", "s0", "s1"],
                )

    fields = "h bigint, p binary, k1 bigint, k2 bigint, s0 int, s1 int"
    return stored.select("text", "k1", "k2", "hs").mapInArrow(tasks, fields)


def _bucketed(texts: DataFrame, label: str) -> DataFrame:
    """``texts`` stored by (k1, k2) in the shared folder, so that joins on the key do not move them."""
    spark = texts.sparkSession
    name = f"formline_{label}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = texts.write.format("parquet").bucketBy(buckets, "k1", "k2")
    writer.option("path", fresh_path(spark, label)).saveAsTable(name)
    stored = spark.table(name)
    # the plan holds the files and their buckets; the name is needed no more
    spark.sql(f"DROP TABLE {name}")
    return stored


def _single_strings(hot: DataFrame, length: int) -> DataFrame:
    """(s, p, at, n) per string of each piece; s is a 128-bit hash."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = row["data"]
                n = len(raw) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([xxhash.xxh128_digest(raw[i : i + length]) for i in range(n)], pa.binary()),
                        pa.array([row["p"]] * n, pa.binary()),
                        pa.array(range(n), pa.int32()), pa.array([row["n"]] * n, pa.int64()),
                    ],
                    ["s", "p", "at", "n"],
                )

    return hot.select("p", "n", "data").mapInArrow(tasks, "s binary, p binary, at int, n bigint")


def _repeated_singly(hot: DataFrame, length: int) -> DataFrame:
    """(p, a, b) per string of a piece that occurs once, where the string occurs more than once."""
    strings = _single_strings(hot, length)
    often = strings.groupBy("s").agg(F.sum("n").alias("times")).where("times > 1").select("s")
    # the strings of other pieces are known to repeat
    once = strings.where("n = 1").join(often, "s")
    return once.select("p", F.col("at").alias("a"), (F.col("at") + 1).alias("b"))


def repeated_starts(data: list[bytes], times: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """Per piece the runs [a, b) of starts whose string occurs more than once, pieces counted ``times``."""
    sizes = np.array([len(d) for d in data])
    flat = np.frombuffer(b"\0".join(data), np.uint8).astype(np.int64) + 2
    begin = np.cumsum(sizes + 1) - sizes - 1
    flat[(begin + sizes)[:-1]] = 1
    counts = sizes - length + 1
    piece = np.repeat(np.arange(len(data)), counts)
    inside = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
    classes = equal_prefix_classes(flat, begin[piece] + inside, length)
    often = np.bincount(classes, weights=times[piece])[classes] > 1
    edges = np.flatnonzero(often & np.concatenate([[True], ~often[:-1] | (piece[1:] != piece[:-1])]))
    ends = np.flatnonzero(often & np.concatenate([~often[1:] | (piece[1:] != piece[:-1]), [True]]))
    out: list[list[tuple[int, int]]] = [[] for _ in data]
    for a, b in zip(edges.tolist(), ends.tolist(), strict=True):
        out[piece[a]].append((int(inside[a]), int(inside[b]) + 1))
    return out


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """(k1, k2, text, spans) of the distinct texts that lose bytes; ``spans`` are start strings' ranges.

    ``spans`` holds structs (lo, hi) that may overlap and come in no order.
    """
    texts = _keyed(docs, id_col, text_col).where(F.col("n") >= length)
    repeated = _owner_rows(texts, length, keys=False).groupBy("h").agg(F.count("*").alias("times")).where("times > 1")
    repeated = written(repeated.select("h"), "suffix-owners")
    lists = (
        _owner_rows(texts, length, keys=True).join(repeated, "h", "left_semi")
        .groupBy("k1", "k2").agg(F.collect_set("h").alias("hs"))
    )
    once = texts.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    stored = _bucketed(once.join(lists, ["k1", "k2"]), "suffix_texts")

    # equal texts are stored once but occur as often as they are counted
    pieces = _piece_rows(stored, length)
    counted = pieces.join(stored.select("k1", "k2", "copies").where("copies > 1"), ["k1", "k2"], "left")
    distinct = written(
        counted.groupBy("h", "p").agg(
            F.sum(F.coalesce("copies", F.lit(1))).alias("n"), F.min(F.struct("k1", "k2", "s0", "s1")).alias("at")
        ),
        "suffix-pieces",
    )
    size = F.col("at.s1") - F.col("at.s0")
    owned = distinct.groupBy("h").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    disputed = written(owned.where("kinds > 1 and least = 1"), "suffix-disputed")
    to_sort = (
        distinct.join(disputed.select("h", "kinds"), "h")
        .select("h", "p", "n", "kinds", "at.*")
        .join(stored.select("k1", "k2", "text"), ["k1", "k2"])
        .select("h", "p", "n", "kinds", F.expr("substring(text, s0 + 1, s1 - s0)").alias("data"))
    )
    total = distinct.agg(F.sum(size.cast("bigint"))).first()[0]
    most = disputed.agg(F.max("kinds")).first()[0]
    buckets = max(1, -(-(total or 0) // SORT_BYTES))
    shared = to_sort.where(F.col("kinds") <= HOT_PIECES).select(
        F.pmod(F.xxhash64("h"), F.lit(buckets)).alias("bucket"), "p", "n", "data"
    )

    def sort(table: pa.Table) -> pa.Table:
        times = table.column("n").to_numpy()
        found = repeated_starts(table.column("data").to_pylist(), times, length)
        rows = [
            (p, a, b)
            for p, n, runs in zip(table.column("p").to_pylist(), times.tolist(), found, strict=True)
            if n == 1  # the strings of other pieces are known to repeat
            for a, b in runs
        ]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        types = (pa.binary(), pa.int32(), pa.int32())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["p", "a", "b"])

    in_sorts = shared.groupBy("bucket").applyInArrow(sort, "p binary, a int, b int")
    if (most or 0) > HOT_PIECES:
        hot = written(to_sort.where(F.col("kinds") > HOT_PIECES).select("p", "n", "data"), "suffix-hot")
        in_sorts = in_sorts.unionByName(_repeated_singly(hot, length))
    in_copies = distinct.where("n > 1").select("p", F.lit(0).alias("a"), (size - length + 1).alias("b"))
    covered = F.struct(
        (F.col("s0") + F.col("a")).alias("lo"), (F.col("s0") + F.col("b") + (length - 1)).alias("hi")
    )
    spans = (
        _piece_rows(stored, length)
        .join(in_sorts.unionByName(in_copies), "p")
        .groupBy("k1", "k2")
        .agg(F.collect_list(covered).alias("spans"))
    )
    return stored.select("k1", "k2", "text").join(spans, ["k1", "k2"])


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans (touching ones are one run)."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _cut(changed: DataFrame, with_text: bool) -> DataFrame:
    """(k1, k2, n_removed, n_spans, kept_sha256 or the remaining text) per distinct text."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, runs, rest = [], [], []
            for text, spans in zip(batch.column(2), batch.column(3), strict=True):
                raw, cut = text.as_py(), merged(spans.as_py())
                begins, ends = [0, *(b for _, b in cut)], [*(a for a, _ in cut), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(begins, ends, strict=True))
                removed.append(len(raw) - len(kept))
                runs.append(len(cut))
                # a run may begin or end inside a character; what is left of one is dropped from texts
                rest.append(kept.decode(errors="ignore") if with_text else hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(removed, pa.int64()),
                    pa.array(runs, pa.int64()), pa.array(rest, pa.string()),
                ],
                ["k1", "k2", "n_removed", "n_spans", "rest"],
            )

    fields = "k1 bigint, k2 bigint, n_removed bigint, n_spans bigint, rest string"
    return changed.select("k1", "k2", "text", "spans").mapInArrow(tasks, fields)


def repeats_removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``."""
    cut = _cut(repeated_spans(docs, id_col, text_col, length), with_text=False)
    every = _keyed(docs, id_col, text_col).select("id", "n", "k1", "k2", F.sha2("text", 256).alias("whole"))
    zero = F.lit(0).cast("bigint")
    return every.join(cut, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_bytes"),
        F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("rest", "whole").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """``docs`` with the repeated strings cut out of the texts; all rows and other columns stay."""
    cut = _cut(repeated_spans(docs, id_col, text_col, length), with_text=True)
    a, b, k1, k2, rest = unused(docs, "a", "b", "k1", "k2", "rest")
    cut = cut.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("rest").alias(rest))
    raw = F.col(text_col).cast("binary")
    keyed = docs.withColumns({a: F.xxhash64(raw), b: F.xxhash64(F.lit("text"), raw)})
    joined = keyed.join(cut, (keyed[a] == cut[k1]) & (keyed[b] == cut[k2]), "left")
    return joined.withColumn(text_col, F.coalesce(rest, F.col(text_col))).select(*docs.columns)
