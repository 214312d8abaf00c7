"""SimHash near-duplicates, linked through vantage-point trees over fingerprints.

A fingerprint has bit i set if over half of the XXH64 hashes (seed 42) of a text's word shingles have
it. Texts link when their fingerprints differ in at most ``max_distance`` bits. Equal fingerprints are
joined first; links are searched between distinct ones only.

**Trees.** The 64 bits are cut into parts, so many that two linked fingerprints differ in at most one
bit of some part. The bits of one part that differ are a metric too, so each part gets a
vantage-point tree: a node halves its fingerprints by distance to a vantage point. The upper nodes are
learned from a bounded sample and give the shards; each fingerprint is at home in one shard of every tree. By the
triangle bound, partners of an inner fingerprint lie within threshold + radius of the vantage point:
outer fingerprints inside that border visit the inner shard as guests, and guests go wherever the
bound cannot rule out a partner. Inside a shard the tree goes on down to small leaves, where pairs
are compared over all 64 bits. A shard reports a spanning forest of its links, never all pairs.
Shards that the sample shows to be too large are cut into blocks of rows against columns.

Defined cases: a null or empty text, or one of white space, has fingerprint 0 and links like any other;
fewer words than a shingle make one shingle; rows with a null id belong to their group, whose id is the
smallest that is not null (null if there is none); repeated rows share a group; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formline.llm.common import memory_of, steps, unused, written
from formline.llm.components import component_roots
from formline.session import rows_within

SEED = 42
#: Fingerprints in the sample that the upper trees are learned from.
SAMPLE = 40_000
#: Home fingerprints of a shard that need no further split, and sampled ones that a split needs.
SHARD_ROWS = 16_384
LEAF_SAMPLE = 64
#: Fingerprints that one side of a block holds at most, by the sample's estimate.
BLOCK_ROWS = 1_000_000
LEAF_ROWS = 256
_COMPARE = 1_000_000
_CHUNK = 1 << 17


def shingle_hashes(text: bytes, shingle: int) -> list[int]:
    words = text.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    digest, ends = xxhash.xxh64_intdigest, ends[shingle - 1 :].tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)]


def majority_bits(hashes: list[int]) -> int:
    """The fingerprint of one text's hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = np.array(hashes[at : at + _CHUNK], np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    return np.array([majority_bits(shingle_hashes(t, shingle)) for t in texts], np.uint64)


def with_fingerprint(docs: DataFrame, text_col: str, shingle: int, name: str) -> DataFrame:
    """``docs`` with the fingerprint of the text as a signed long ``name``."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory_of(__name__)
        for batch, texts in steps(batches, text_col):
            found = pa.array(fingerprints(texts, shingle).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(tasks, f"{fields}, `{name}` bigint")


@dataclass
class Node:
    """A split by distance to a vantage point, or a leaf (``shard`` set) cut into ``blocks``."""

    vantage: int = 0
    threshold: int = 0
    inner: Node | None = None
    outer: Node | None = None
    shard: int = -1
    blocks: int = 1


def part_masks(max_distance: int) -> list[int]:
    """Bit masks so many that fingerprints within the distance differ by at most one bit in one of them."""
    parts = max(1, (max_distance + 2) // 2)
    borders = [64 * i // parts for i in range(parts + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(borders, borders[1:], strict=False)]


def _distance(points: np.ndarray, vantage: int, mask: int) -> np.ndarray:
    return np.bitwise_count((points ^ np.uint64(vantage)) & np.uint64(mask)).astype(np.int16)


def _split(homes: np.ndarray, mask: int) -> tuple[int, int, np.ndarray] | None:
    """Vantage point, threshold and distances of the most even split among a few points."""
    best = None
    for k in range(1, 4):
        vantage = int(homes[len(homes) * k // 4])
        far = _distance(homes, vantage, mask)
        threshold = int(np.median(far))
        for t in (threshold - 1, threshold):
            inner = int((far <= t).sum())
            lost = abs(2 * inner - len(homes))
            if 0 < inner < len(homes) and (best is None or lost < best[0]):
                best = (lost, vantage, t, far)
    return best[1:] if best else None


def build_tree(
    sample: np.ndarray, total: int, mask: int, radius: int, shard_rows: int = SHARD_ROWS
) -> tuple[Node, int]:
    """The upper tree of ``total`` fingerprints, learned from a sample of them; and its number of shards."""
    scale = total / max(1, len(sample))
    shards = 0

    def grow(homes: np.ndarray, guests: np.ndarray) -> Node:
        nonlocal shards
        cut = _split(homes, mask) if len(homes) >= LEAF_SAMPLE and len(homes) * scale > shard_rows else None
        if cut is None:
            shards += 1
            rows = (len(homes) + len(guests)) * scale
            return Node(shard=shards - 1, blocks=max(1, int(np.ceil(rows / BLOCK_ROWS))))
        vantage, t, far = cut
        visiting = _distance(guests, vantage, mask)
        near = np.concatenate([guests[visiting <= t + radius], homes[(far > t) & (far <= t + radius)]])
        return Node(
            vantage, t, grow(homes[far <= t], near), grow(homes[far > t], guests[visiting > t - radius])
        )

    return grow(sample, sample[:0]), shards


def route(node: Node, homes: np.ndarray, guests: np.ndarray, mask: int, radius: int):
    """Yields (leaf, homes, guests) for the given fingerprints."""
    if node.shard >= 0:
        if len(homes) or len(guests):
            yield node, homes, guests
        return
    far = _distance(homes, node.vantage, mask)
    visiting = _distance(guests, node.vantage, mask)
    t = node.threshold
    near = np.concatenate([guests[visiting <= t + radius], homes[(far > t) & (far <= t + radius)]])
    yield from route(node.inner, homes[far <= t], near, mask, radius)
    yield from route(node.outer, homes[far > t], guests[visiting > t - radius], mask, radius)


class Forest:
    """Components over the sorted distinct fingerprints of one shard."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.parent = np.arange(len(points))

    def tie(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.parent[a], self.parent[b]
            open_ = a != b
            if not open_.any():
                return
            a, b = a[open_], b[open_]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.parent[self.parent]
                if (up == self.parent).all():
                    break
                self.parent = up


def link_shard(
    homes: np.ndarray, guests: np.ndarray, mask: int, radius: int, max_distance: int
) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among homes and between homes and guests."""
    forest = Forest(np.unique(np.concatenate([homes, guests])))
    place = lambda x: np.searchsorted(forest.points, x)
    todo = [(homes, guests)]
    while todo:
        inside, visiting = todo.pop()
        cut = _split(inside, mask) if len(inside) > LEAF_ROWS else None
        if cut is not None:
            vantage, t, far = cut
            v = _distance(visiting, vantage, mask)
            near = np.concatenate([visiting[v <= t + radius], inside[(far > t) & (far <= t + radius)]])
            todo += [(inside[far <= t], near), (inside[far > t], visiting[v > t - radius])]
            continue
        others = np.concatenate([inside, visiting])
        if not len(inside) or len(others) < 2:
            continue
        rows = max(1, _COMPARE // len(others))
        for at in range(0, len(inside), rows):
            left = inside[at : at + rows]
            i, j = np.nonzero(np.bitwise_count(left[:, None] ^ others[None, :]) <= max_distance)
            apart = left[i] != others[j]
            if apart.any():
                forest.tie(place(left[i[apart]]), place(others[j[apart]]))
    moved = np.flatnonzero(forest.parent != np.arange(len(forest.parent)))
    return forest.points[moved], forest.points[forest.parent[moved]]


def links(distinct: DataFrame, max_distance: int) -> DataFrame:
    """Edges (a, b) that connect whatever the distinct fingerprints ``fp`` within the distance connect.

    Only a sample of ``SAMPLE`` fingerprints reaches the driver.
    """
    total = distinct.count()
    masks = part_masks(max_distance)
    radius = max_distance // len(masks)
    share = min(1.0, SAMPLE / max(1, total))
    picked = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * SAMPLE)
    sample = np.sort(picked.toArrow().column("fp").to_numpy()).view(np.uint64)
    np.random.default_rng(SEED).shuffle(sample)
    trees = [build_tree(sample, total, m, radius)[0] for m in masks]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            keys, blocks, values, at_home = [], [], [], []

            def put(tree: int, shard: int, block: np.ndarray, point: np.ndarray, home: bool) -> None:
                keys.append(np.full(len(point), tree << 32 | shard, np.int64))
                blocks.append(block)
                values.append(point)
                at_home.append(np.full(len(point), home))

            for t, (tree, mask) in enumerate(zip(trees, masks, strict=True)):
                for leaf, homes, guests in route(tree, points, points[:0], mask, radius):
                    k = leaf.blocks
                    if k == 1:
                        put(t, leaf.shard, np.zeros(len(homes), np.int64), homes, True)
                        put(t, leaf.shard, np.zeros(len(guests), np.int64), guests, False)
                        continue
                    # block (i, j): homes of salt i against homes and guests of salt j
                    everyone = np.concatenate([homes, guests])
                    salt = (everyone * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % k
                    for other in range(k):
                        put(t, leaf.shard, salt[: len(homes)] * k + other, homes, True)
                        put(t, leaf.shard, other * k + salt, everyone, False)
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys)), pa.array(np.concatenate(blocks)),
                        pa.array(np.concatenate(values).view(np.int64)), pa.array(np.concatenate(at_home)),
                    ],
                    ["shard", "block", "fp", "home"],
                )

    def search(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        points = table.column("fp").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy()
        mask = masks[key[0].as_py() >> 32]
        a, b = link_shard(points[home], points[~home], mask, radius, max_distance)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    spread_out = distinct.select("fp").mapInArrow(spread, "shard bigint, block bigint, fp bigint, home boolean")
    return spread_out.groupBy("shard", "block").applyInArrow(search, "a bigint, b bigint")


def groups(marked: DataFrame, max_distance: int) -> tuple[DataFrame, DataFrame]:
    """From rows (id, fp): a table (fp, component) and a table of one row (id, fp) per component."""
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("least")
    reps = written(marked.groupBy("fp").agg(least), "simhash-distinct")
    roots = component_roots(links(reps, max_distance), "simhash-links")
    rooted = reps.join(roots, reps["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.struct("least.none", "least.id", "fp").alias("least")
    )
    kept = rooted.groupBy("root").agg(F.min("least").alias("least"))
    members = rooted.select("fp", "root").join(kept, "root").select("fp", F.col("least.id").alias("component"))
    return members, kept.select("least.id", "least.fp")


def near_duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_distance: int = 4
) -> DataFrame:
    """Per row of ``docs``: id, ``fingerprint`` (16 hex digits) and ``component_id``."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = written(with_fingerprint(source, "text", shingle, "fp").select("id", "fp"), "simhash")
    members, _ = groups(marked, max_distance)
    return marked.join(members, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def marks_of(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp, text_hash) of every row; texts are read once and do not come back from the workers."""
    source = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text")
    )

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory_of(__name__)
        for batch, texts in steps(batches, "text"):
            found = pa.array(fingerprints(texts, shingle).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], ["id", "text_hash", "fp"])

    return source.mapInArrow(tasks, f"id {source.schema['id'].dataType.simpleString()}, text_hash bigint, fp bigint")


def without_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_distance: int = 4
) -> DataFrame:
    """One row of ``docs`` per group, the one of the smallest id, with its columns as they are.

    Of rows that share this id and the fingerprint, the one of the smallest text hash stays. Only (id, text hash)
    pairs are joined: those of the rows that go are broadcast where they are few, so that texts stay where they
    are; of rows repeated word for word, which alone are moved, one stays.
    """
    marked = written(marks_of(docs, id_col, text_col, shingle), "simhash")
    _, kept = groups(marked.select("id", "fp"), max_distance)
    kept = kept.select(F.col("id").alias("least"), F.col("fp").alias("kept"))
    stays = marked.join(kept, (marked["fp"] == kept["kept"]) & marked["id"].eqNullSafe(kept["least"]))
    stays = stays.groupBy("id", "fp").agg(F.min("text_hash").alias("text_hash")).select("id", "text_hash")
    rows = marked.groupBy("id", "text_hash").agg(F.count("*").alias("n"))
    held = stays.withColumnsRenamed({"id": "held", "text_hash": "held_hash"})
    same = rows["id"].eqNullSafe(held["held"]) & (rows["text_hash"] == held["held_hash"])
    judged = written(rows.join(held, same, "left").select("id", "text_hash", "n", F.col("held_hash").isNotNull().alias("stays")), "simhash-rows")
    once = without_rows(docs, judged.where("not stays or n > 1").select("id", "text_hash"), id_col, text_col)
    again = with_rows(docs, judged.where("stays and n > 1").select("id", "text_hash"), id_col, text_col)
    (turn,) = unused(docs, "turn")
    first = Window.partitionBy(id_col, F.xxhash64(text_col)).orderBy(F.lit(0))
    one = again.withColumn(turn, F.row_number().over(first)).where(F.col(turn) == 1).select(*docs.columns)
    return once.unionByName(one)


def without_rows(docs: DataFrame, marks: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose id and text hash are not among ``marks`` (id, text_hash)."""
    return _joined(docs, marks, id_col, text_col, "left_anti")


def with_rows(docs: DataFrame, marks: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return _joined(docs, marks, id_col, text_col, "left_semi")


def _joined(docs: DataFrame, marks: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    mark_id, mark_hash = unused(docs, "mark_id", "mark_hash")
    few = rows_within(marks)
    renamed = (marks if few is None else F.broadcast(few)).select(F.col("id").alias(mark_id), F.col("text_hash").alias(mark_hash))
    same = docs[id_col].eqNullSafe(renamed[mark_id]) & (F.xxhash64(docs[text_col]) == renamed[mark_hash])
    return docs.join(renamed, same, how)
