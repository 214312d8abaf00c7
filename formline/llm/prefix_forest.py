"""Approximate nearest neighbours by inner product, with a forest of hash-prefix trees.

Rows are dealt to shards of about ``shard_rows``; a shard holds ``trees`` sorted arrays of 64-bit hash
strings (signs of random projections; for inner products every vector is lengthened by one component
that brings it to the largest norm). A query descends in every tree to its longest matching prefix and
then all trees ascend together, one bit at a time, until the matching ranges hold ``share`` times the
shard's rows (a row counts once per tree that holds it). The rows found are scored in double precision on the
original vectors, and the best of all shards are ranked. Every shard is asked and searched to the same depth, so
recall does not depend on how many shards there are.

A shard's vectors and sorted arrays are made once and stored in the shared folder; queries come to a shard in
blocks, and a task maps the shard's files, so the index is never copied for more queries. Only where the
shared folder is not mounted do a shard's vectors travel to each of its blocks.

Recall against brute force with the defaults is measured in ``tests/llm/test_prefix_forest.py`` (at least
0.9 is asserted) and stated in the README.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part,
nor do rows with a null id; rows that repeat an id count once, with the smallest vector; vectors of another
length than the query's are not its candidates; ties go to the smaller id; an empty table finds nothing.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formline.llm.common import mounted_folder, save_array, written

BITS = 64
QUERY_BLOCK = 4096


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, dim): one valid vector of doubles per id."""
    v = F.col("v")
    infinite = F.lit(float("inf"))
    valid = (
        ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite)) & F.exists(v, lambda x: x != 0)
    )
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return (
        rows.where(F.col("id").isNotNull() & v.isNotNull() & valid)
        .groupBy("id").agg(F.min("v").alias("v"))
        .withColumn("dim", F.size("v"))
    )


def hash_strings(points: np.ndarray, norm: float, trees: int, seed: int) -> np.ndarray:
    """(trees, points) hash strings; ``norm`` 0 marks queries, which are not lengthened."""
    rng = np.random.default_rng([seed, points.shape[1]])
    spare = np.sqrt(np.maximum(norm * norm - (points * points).sum(axis=1), 0)) if norm else np.zeros(len(points))
    longer = np.concatenate([points, spare[:, None]], axis=1).astype(np.float32)
    out = np.empty((trees, len(points)), np.uint64)
    for t in range(trees):
        plane = rng.standard_normal((longer.shape[1], BITS), dtype=np.float32)
        out[t] = np.packbits(longer @ plane > 0, axis=1).view(">u8").ravel()
    return out


class Forest:
    """The sorted arrays of one shard."""

    def __init__(self, strings: np.ndarray, rows: np.ndarray):
        self.strings, self.rows = strings, rows

    @staticmethod
    def of(points: np.ndarray, norm: float, trees: int, seed: int) -> Forest:
        strings = hash_strings(points, norm, trees, seed)
        rows = np.argsort(strings, axis=1, kind="stable")
        return Forest(np.take_along_axis(strings, rows, axis=1), rows.astype(np.int32))

    def ranges(self, queries: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """(trees, queries) range borders at the longest prefix where all trees hold ``wanted`` rows."""
        trees, n = queries.shape
        low, high = np.zeros((trees, n), np.int64), np.full((trees, n), self.strings.shape[1])
        todo = np.arange(n)
        for level in range(BITS, 0, -1):
            if not len(todo):
                break
            if level > 1 and 2 ** (level - 1) > 64 * self.strings.shape[1]:
                continue  # prefixes this long hold next to nothing but equal strings, met again further up
            keep = np.uint64((1 << BITS) - (1 << (BITS - level)))
            a = np.empty((trees, len(todo)), np.int64)
            b = np.empty_like(a)
            for t in range(trees):
                asked = queries[t, todo]
                a[t] = np.searchsorted(self.strings[t], asked & keep)
                b[t] = np.searchsorted(self.strings[t], asked | ~keep, side="right")
            done = (b - a).sum(axis=0) >= wanted
            low[:, todo[done]], high[:, todo[done]] = a[:, done], b[:, done]
            todo = todo[~done]
        return low, high


def search_shard(
    ids: np.ndarray, points: np.ndarray, forest: Forest, query_ids: np.ndarray, queries: np.ndarray,
    k: int, share: float, seed: int,
) -> list[tuple[int, int, float]]:
    """(query id, id, score) of the best ``k`` candidates that this shard's forest finds for each query."""
    if not len(ids) or not len(query_ids):
        return []
    trees = len(forest.strings)
    low, high = forest.ranges(hash_strings(queries, 0.0, trees, seed), max(k + 1, int(np.ceil(share * len(ids)))))
    out = []
    for q in range(len(query_ids)):
        found = np.zeros(len(ids), bool)
        for t in range(trees):
            found[forest.rows[t, low[t, q] : high[t, q]]] = True
        others = ids != query_ids[q]
        rows = np.flatnonzero(found & others)
        if len(rows) < k:
            rows = np.flatnonzero(others)  # up to the roots
        if len(rows) > k:
            near = points[rows] @ queries[q]
            least = np.partition(near, len(near) - k)[len(near) - k]
            rows = rows[near >= least - 1e-9 * (1 + abs(least))]
        # summed row by row, so equal vectors have equal scores wherever they stand
        score = (points[rows] * queries[q]).sum(axis=1)
        best = np.lexsort((ids[rows], -score))[:k]
        out += zip([int(query_ids[q])] * len(best), ids[rows[best]].tolist(), score[best].tolist(), strict=True)
    return out


def nearest(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    query_step: int = 20,
    trees: int = 64,
    share: float = 1.0,
    shard_rows: int = 8192,
    seed: int = 17,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows with an id divisible by ``query_step`` the ``k`` nearest found.

    One row per vector length reaches the driver.
    """
    points = written(usable(vectors, id_col, vector_col), "forest")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    dims = points.groupBy("dim").agg(F.count("*").alias("rows"), F.max(norm).alias("norm")).collect()
    norms = {r["dim"]: r["norm"] * (1 + 1e-9) for r in dims}
    rows = sum(r["rows"] for r in dims)
    shards, blocks = max(1, -(-rows // shard_rows)), max(1, -(-rows // query_step // QUERY_BLOCK))
    dealt = F.xxhash64("id", F.lit(seed))
    placed = points.select("id", "v", "dim", F.pmod(dealt, F.lit(shards)).alias("shard"))
    queries = points.where(F.col("id") % query_step == 0).select(
        "id", "v", "dim", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"),
        F.pmod(dealt, F.lit(blocks)).cast("int").alias("block"),
    )
    fields = "query_id bigint, vec_id bigint, score double"

    def vectors_of(table: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
        values = [c.flatten().to_numpy() for c in table.column("v").chunks] or [np.zeros(0)]
        return table.column("id").to_numpy(), np.concatenate(values).reshape(-1, dim)

    def told(found: list[tuple[int, int, float]]) -> pa.Table:
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["query_id", "vec_id", "score"])

    folder = mounted_folder(vectors.sparkSession, "prefix-forest")
    if folder is not None:

        def store(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            dim, shard = key[0].as_py(), key[1].as_py()
            ids, values = vectors_of(table, dim)
            forest = Forest.of(values, norms[dim], trees, seed)
            for name, array in (("ids", ids), ("points", values), ("strings", forest.strings), ("rows", forest.rows)):
                save_array(f"{folder}/{name}-{dim}-{shard:08d}.npy", array)
            return pa.table({"rows": [len(ids)]})

        def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            dim, shard = key[0].as_py(), key[1].as_py()
            if not os.path.exists(f"{folder}/rows-{dim}-{shard:08d}.npy"):
                return told([])  # no row of this length was dealt here
            names = ("ids", "points", "strings", "rows")
            ids, values, strings, order = (np.load(f"{folder}/{n}-{dim}-{shard:08d}.npy", mmap_mode="r") for n in names)
            asked = vectors_of(table, dim)
            return told(search_shard(ids, values, Forest(strings, order), *asked, k, share, seed))

        placed.groupBy("dim", "shard").applyInArrow(store, "rows bigint").agg(F.sum("rows")).collect()
        found = queries.groupBy("dim", "shard", "block").applyInArrow(ask, fields)
    else:

        def search(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            dim = key[0].as_py()
            (ids, values), asked = (vectors_of(table.filter(pc.equal(table["asks"], a)), dim) for a in (False, True))
            forest = Forest.of(values, norms[dim], trees, seed)
            return told(search_shard(ids, values, forest, *asked, k, share, seed))

        every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        both = placed.select("*", F.lit(False).alias("asks"), every_block.alias("block")).unionByName(
            queries.withColumn("asks", F.lit(True))
        )
        found = both.groupBy("dim", "shard", "block").applyInArrow(search, fields)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
