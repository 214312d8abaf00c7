"""Mixing sources to target weights by blocks of fixed length.

Every source's words are laid end to end (documents in the order of a hash of their id) and cut into
blocks of ``block_words``. The mix is a sequence of slots in output shards. For each shard the
number of slots per source is drawn from a multinomial whose weights are what the sources still have
to give, so the draws of all shards add up to the targets. The n-th slot of a source in pass e over its
blocks takes the block to which a keyed permutation of the block numbers maps n; slots and blocks
are then joined by source and block number. A source in its third pass has been used up three times,
so no document is taken more than three times as often as it is long.

Weights 5, 2, 1 go to the sources in code-point order, again and again, null last. Targets share the
size of all documents by weight; none exceeds three times its source's size, and what is over is shared
among the others by weight until none is above.

Defined cases: a null or empty text has size 0 and is never taken; a null source is a source of its
own; null ids are ordinary; repeated rows are separate documents; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formline.llm.common import STEP_BYTES, written

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Documents per prefix-sum bucket of each source, were all documents of one source.
BUCKET_ROWS = 4_000
#: Equal rows that one step lays side by side, and slots that one task makes.
REPEAT_ROWS = 4_096
SLOT_ROWS = 2_000_000
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True


def word_counts(column: pa.Array) -> np.ndarray:
    """Number of words of each text of a string column, over the bytes of many texts at once."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    counts = np.zeros(len(column), np.int64)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + STEP_BYTES, side="right")) - 1)
        borders = offsets[at : end + 1] - offsets[at]
        full = np.flatnonzero(np.diff(borders))
        if len(full):
            gap = _GAP[np.frombuffer(column.buffers()[2], np.uint8, int(borders[-1]), int(offsets[at]))]
            start = ~gap
            start[1:] &= gap[:-1]
            first = borders[full]
            start[first] = ~gap[first]  # a text's first byte starts a word whatever ends the text before
            counts[at + full] = np.add.reduceat(start, first, dtype=np.int64)
        at = end
    return counts


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Rows (id, source, size), whole texts counted where they are."""
    slim = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.array(word_counts(batch.column(2)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes], ["id", "source", "size"])

    return slim.mapInArrow(tasks, f"id {slim.schema['id'].dataType.simpleString()}, source string, size bigint")


def target_words(sizes: list[int]) -> list[float]:
    """Targets of sources listed in code-point order, null last."""
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))]
    targets = [0.0] * len(sizes)
    left, active = float(sum(sizes)), list(range(len(sizes)))
    while active:
        total = sum(weights[i] for i in active)
        share = {i: left * weights[i] / total for i in active}
        over = [i for i in active if share[i] > MAX_REPEATS * sizes[i]]
        if not over:
            for i in active:
                targets[i] = share[i]
            break
        for i in over:
            targets[i] = float(MAX_REPEATS * sizes[i])
            left -= targets[i]
        active = [i for i in active if i not in set(over)]
    return targets


def permuted(index: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """A keyed permutation of 0..n-1 (or its inverse): Feistel rounds, walked until inside the range."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    rounds = [np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % 2**64) for r in range(4)]

    def scrambled(x: np.ndarray, salt: np.uint64) -> np.ndarray:
        x = (x ^ salt) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        return (x >> np.uint64(32)) & mask

    def step(x: np.ndarray) -> np.ndarray:
        high, low = x >> shift, x & mask
        for salt in reversed(rounds) if back else rounds:
            if back:
                high, low = low ^ scrambled(high, salt), high
            else:
                high, low = low, high ^ scrambled(low, salt)
        return high << shift | low

    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        out[todo] = step(out[todo])
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


@dataclass
class Source:
    """One source's blocks and what the mix takes of them."""

    code: int
    name: str | None
    size: int
    target: float
    blocks: int = 0
    slots: int = 0


def plan(sizes: list[tuple[str | None, int]], block_words: int, seed: int) -> list[Source]:
    """Targets and numbers of slots of the sources, given in code-point order, null last."""
    out = []
    for code, ((name, size), target) in enumerate(zip(sizes, target_words([s for _, s in sizes]), strict=True)):
        source = Source(code, name, size, target, -(-size // block_words))
        if source.blocks:
            short = source.blocks * block_words - size  # what the last block lacks

            def words(slots: int, source=source, short=short) -> int:
                passes, rest = divmod(slots, source.blocks)
                key = _key(seed, source.code, passes)
                last = permuted(np.array([source.blocks - 1]), source.blocks, key, back=True)[0]
                return slots * block_words - short * (passes + int(last < rest))

            least = int(target // block_words)
            options = range(least, min(least + 2 + MAX_REPEATS, MAX_REPEATS * source.blocks) + 1)
            source.slots = min(options, key=lambda s: (abs(words(s) - target), s))
        out.append(source)
    return out


def _key(seed: int, code: int, passes: int) -> int:
    return (seed * 1_000_003 + code) * 1_000_003 + passes


def shard_counts(sources: list[Source], n_shards: int, seed: int) -> np.ndarray:
    """Slots per (shard, source): multinomial draws over what is left, no source beyond its slots."""
    left = np.array([s.slots for s in sources], np.int64)
    per_shard = -(-int(left.sum()) // n_shards) if left.sum() else 0
    counts = np.zeros((n_shards, len(sources)), np.int64)
    rng = np.random.default_rng(seed)
    for shard in range(n_shards):
        lack = min(per_shard, int(left.sum()))
        while lack:
            drawn = np.minimum(rng.multinomial(lack, left / left.sum()), left)
            counts[shard] += drawn
            left -= drawn
            lack -= int(drawn.sum())
    return counts


def placed(sizes: DataFrame, sources: list[Source], rows: int) -> DataFrame:
    """(id, size, code, at): ``at`` is the number of words of the source before the document.

    Sums per bucket of ids come first, then running sums inside each bucket, so no task holds a source. Rows equal
    in id, source and size are counted beforehand and laid side by side afterwards, so none of this grows with them.
    """
    spark = sizes.sparkSession
    sizes = sizes.groupBy("id", "source", "size").agg(F.count("*").alias("n"))
    names = F.broadcast(spark.createDataFrame([(s.code, s.name) for s in sources], "code int, name string"))
    buckets = max(1, rows // BUCKET_ROWS)
    coded = (
        sizes.join(names, F.col("source").eqNullSafe(F.col("name")))
        .withColumn("order", F.xxhash64(F.col("id").cast("string"), "size"))
        .select("id", "size", "code", "n", "order", F.pmod("order", F.lit(buckets)).alias("bucket"))
    )
    held = F.col("size") * F.col("n")
    if buckets == 1:
        inside = Window.partitionBy("code").orderBy("order", "id").rowsBetween(Window.unboundedPreceding, -1)
        return _side_by_side(coded.withColumn("at", F.coalesce(F.sum(held).over(inside), F.lit(0))))
    earlier = Window.partitionBy("code").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        coded.groupBy("code", "bucket").agg(F.sum(held).alias("words"))
        .select("code", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("code", "bucket").orderBy("order", "id").rowsBetween(Window.unboundedPreceding, -1)
    return _side_by_side(
        coded.withColumn("before", F.coalesce(F.sum(held).over(inside), F.lit(0)))
        .join(bases, ["code", "bucket"])
        .withColumn("at", F.col("base") + F.col("before"))
    )


def _side_by_side(counted: DataFrame) -> DataFrame:
    """(id, size, code, at) per document, from rows that stand for ``n`` documents laid from ``at`` on."""
    counted = written(counted.select("id", "size", "code", "n", "at"), "mix-counted")
    most = counted.agg(F.max("n")).first()[0] or 1
    last = F.floor((F.col("n") - 1) / REPEAT_ROWS)
    parts = counted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    if most > REPEAT_ROWS:
        parts = parts.repartition("id", "size", "part")
    first = F.col("part") * REPEAT_ROWS
    turns = F.sequence(first, F.least(F.col("n"), first + REPEAT_ROWS) - 1)
    return parts.withColumn("turn", F.explode(turns)).select(
        "id", "size", "code", (F.col("at") + F.col("turn") * F.col("size")).alias("at")
    )


def block_pieces(places: DataFrame, block_words: int) -> DataFrame:
    """(code, block, id, size, at, first, words): which words of which document a block holds."""
    end = F.col("at") + F.col("size")
    blocks = F.sequence(F.floor(F.col("at") / block_words), F.floor((end - 1) / block_words))
    start = F.greatest("at", F.col("block") * block_words)
    return (
        places.where("size > 0")
        .select("*", F.explode(blocks).alias("block"))
        .select(
            "code", "block", "id", "size", "at",
            (start - F.col("at")).alias("first"),
            (F.least(end, (F.col("block") + 1) * block_words) - start).alias("words"),
        )
    )


def slots(spark, sources: list[Source], n_shards: int, seed: int) -> DataFrame:
    """(shard, slot, code, block): the block that each slot of each shard takes."""
    counts = shard_counts(sources, n_shards, seed)
    before = np.cumsum(counts, axis=0) - counts
    draws = [
        (
            shard, s.code, int(before[shard, i]) + at, min(SLOT_ROWS, int(counts[shard, i]) - at), s.blocks,
            int(counts[shard, :i].sum()) + at, int(counts[shard].sum()),
        )
        for shard in range(n_shards)
        for i, s in enumerate(sources)
        for at in range(0, int(counts[shard, i]), SLOT_ROWS)
    ]
    schema = "shard int, code int, start bigint, n bigint, blocks bigint, offset bigint, length bigint"
    drawn = spark.createDataFrame(draws, schema)
    chunk = 500_000

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for at in range(0, row["n"], chunk):
                    turn = np.arange(at, min(at + chunk, row["n"]))
                    passes, index = np.divmod(row["start"] + turn, row["blocks"])
                    block = np.empty(len(turn), np.int64)
                    for e in np.unique(passes):
                        now = passes == e
                        block[now] = permuted(index[now], row["blocks"], _key(seed, row["code"], int(e)))
                    place = permuted(row["offset"] + turn, row["length"], _key(seed, -1 - row["shard"], 0) % 2**63)
                    n = len(turn)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, row["shard"], np.int32)), pa.array(place),
                            pa.array(np.full(n, row["code"], np.int32)), pa.array(block),
                        ],
                        ["shard", "slot", "code", "block"],
                    )

    made = sum(n for _, _, _, n, *_ in draws)
    tasks_wanted = max(1, min(len(draws), max(n_shards, -(-made // SLOT_ROWS))))
    return drawn.repartition(tasks_wanted).mapInArrow(tasks, "shard int, slot bigint, code int, block bigint")


@dataclass
class Mix:
    """The parts of one mix; ``sources`` is small, the rest are tables."""

    sources: list[Source]
    places: DataFrame
    pieces: DataFrame
    slots: DataFrame

    def rows(self) -> DataFrame:
        """(shard, slot, source code, id, first, words): the mix itself, as spans of documents."""
        joined = self.slots.join(self.pieces, ["code", "block"])
        return joined.select("shard", "slot", "code", "block", "id", "first", "words")

    def taken(self) -> DataFrame:
        """(id, size, code, taken) of every document."""
        times = self.slots.groupBy("code", "block").agg(F.count("*").alias("times"))
        got = (
            self.pieces.join(times, ["code", "block"], "left")
            .groupBy("code", "at", "id", "size")
            .agg(F.sum(F.col("words") * F.coalesce(F.col("times"), F.lit(0))).alias("taken"))
            .select("id", "size", "code", "taken")
        )
        idle = self.places.where("size = 0").select("id", "size", "code", F.lit(0).cast("bigint").alias("taken"))
        return got.unionByName(idle)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = 32,
    n_shards: int = 64,
    seed: int = 11,
    max_sources: int = 100_000,
) -> Mix:
    """Plans the mix of ``docs``. Only one row per source reaches the driver (refused beyond ``max_sources``)."""
    spark = docs.sparkSession
    sizes = written(sized(docs, id_col, text_col, source_col), "mix-sizes")
    totals = sizes.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    found = totals.limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sources = plan([(r["source"], r["size"]) for r in found], block_words, seed)
    places = written(placed(sizes, sources, sum(r["rows"] for r in found)), "mix-places")
    return Mix(sources, places, block_pieces(places, block_words), slots(spark, sources, n_shards, seed))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """Per document: id, ``size``, ``source_size``, ``target`` and ``taken`` (words, repeats counted)."""
    made = mix(docs, id_col, **settings)
    spark = docs.sparkSession
    table = [(s.code, s.size, s.target) for s in made.sources]
    totals = F.broadcast(spark.createDataFrame(table, "code int, source_size bigint, target double"))
    return made.taken().join(totals, "code").select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")
