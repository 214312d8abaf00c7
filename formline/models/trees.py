"""Regression trees by criteria that Spark's do not have, grown level by level over binned rows.

Features are cut into bins at quantiles. A pass over the rows adds up, for every node that may still be split, every
feature and bin, what the criterion needs: weights and sums of labels for ``friedman_mse``, weights per
label bin for ``absolute_error``, whose medians and absolute deviations follow from these. Only such sums, whose size
depends on nodes, features and bins, reach the driver; trees that would need more than ``PASS_NUMBERS`` of them
are grown in several passes. Splits are exact where features and labels have no more values than bins.

Boosting on absolute error fits each round's tree to the signs of the residuals and gives every leaf the median of
the residuals in it, so that with all rows in every round the mean absolute error never rises. Rounds follow one another,
and a pass of few rows costs Spark more than it computes: rows of up to ``HELD_BYTES`` are held by one task, which
goes through all rounds by itself. More rows stay where they are and take five passes a round.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.models.svr import _added, _as_batch, gathered
from formline.session import cut_lineage

BINS = 32
LABEL_BINS = 64
#: Label bins that leaf medians are taken from.
LEAF_BINS = 1024
#: Sums of one pass.
PASS_NUMBERS = 8_000_000
#: Binned rows of a partition at least.
PART_ROWS = 10_000
#: Binned rows that are stored and read as one.
BLOCK_ROWS = 16_384
#: Nodes up to which rows go through a tree node by node, all rows at a time.
SMALL_TREE = 256
#: Bins per leaf that a median is looked for in, and rows of a bin that need no finer ones.
MEDIAN_BINS = 1024
MEDIAN_ROWS = 20_000
#: Rounds of boosting after which predictions so far are stored with the rows.
STORED_ROUNDS = 20
#: Bytes of rows up to which one task boosts (about as much again while medians are found), and the rows it takes at a time.
HELD_BYTES = 384_000_000
STEP_ROWS = 65_536
#: Cells of features that are counted as one.
GROUP_CELLS = 1024
#: Weights are counted in these units above sums of signs; both are exact below half as many rows.
UNIT = 2.0**27
CRITERIA = ("friedman_mse", "absolute_error")


@dataclass
class Tree:
    """Nodes in the order of their making; a leaf has feature -1. Rows go left up to the node's bin."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])
    #: Places in a full tree (children of i: 2i and 2i + 1), and the weights of rows where a split was looked for.
    path: list[int] = field(default_factory=lambda: [1])
    weight: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at: int) -> list[int]:
        """Makes two children, the right one behind the left."""
        first = len(self.feature)
        self.feature[node], self.bin[node], self.left[node] = feature, at, first
        for side in range(2):
            self.path.append(2 * self.path[node] + side)
            self.weight.append(0.0)
            self.feature.append(-1)
            self.bin.append(0)
            self.left.append(0)
            self.value.append(0.0)
            self.depth.append(self.depth[node] + 1)
        return [first, first + 1]

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature), np.array(self.bin), np.array(self.left)

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of each row; ``codes`` has a line of bin numbers per feature."""
        if len(self.feature) <= SMALL_TREE:
            leaf = np.zeros(codes.shape[1], np.uint8)
            for node, (f, at, left) in enumerate(zip(self.feature, self.bin, self.left, strict=True)):
                if f >= 0:  # parents come before their children
                    np.copyto(leaf, np.uint8(left) + (codes[f] > at).view(np.uint8), where=leaf == node)
            return leaf.astype(np.int64)
        feature, at, left = self.arrays()
        node = np.zeros(codes.shape[1], np.int64)
        rows = np.arange(codes.shape[1])
        for _ in range(max(self.depth)):
            inner = feature[node] >= 0
            if not inner.any():
                break
            f = np.maximum(feature[node], 0)
            node = np.where(inner, left[node] + (codes[f, rows] > at[node]), node)
        return node


@dataclass
class Block:
    """Binned rows: a line of bin numbers per feature, and numbers, labels and predictions so far of the rows."""

    codes: np.ndarray
    row: np.ndarray
    y: np.ndarray
    done: np.ndarray

    FIELDS = "codes binary, row binary, y binary, done binary"

    def packed(self) -> pa.RecordBatch:
        columns = {f: pa.array([np.ascontiguousarray(getattr(self, f)).tobytes()], pa.binary()) for f in ("codes", "row", "y", "done")}
        return pa.RecordBatch.from_pydict(columns)

    @staticmethod
    def each(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Block]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes, row, y, done = (batch.column(f)[i].as_buffer() for f in ("codes", "row", "y", "done"))
                at = np.frombuffer(codes, np.uint8).reshape(width, -1)
                yield Block(at, np.frombuffer(row, np.int64), np.frombuffer(y), np.frombuffer(done))


def _uniform(row: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) per row, the same whenever it is asked for."""
    x = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt * 0xD1B54A32D192ED03 % 2**64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)).astype(np.float64) / 2**53


def drawn(row: np.ndarray, share: float, salt: int) -> np.ndarray:
    """How often each row is drawn into a sample with replacement of ``share`` of the rows (Poisson)."""
    u, out, chance, sofar = _uniform(row, salt), np.zeros(len(row)), np.exp(-share), np.exp(-share)
    for k in range(1, 30):
        out += u >= sofar
        chance *= share / k
        sofar += chance
    return out


class Groups:
    """Features that are counted as one, their bin numbers combined, where that makes few cells."""

    def __init__(self, binner: Binner, most: int | None = None):
        self.sizes = [len(b) + 1 for b in binner.features]
        self.members: list[list[int]] = []
        for f, size in enumerate(self.sizes):
            if self.members and self.cells(self.members[-1]) * size <= (most or GROUP_CELLS):
                self.members[-1].append(f)
            else:
                self.members.append([f])

    def cells(self, members: list[int]) -> int:
        return int(np.prod([self.sizes[f] for f in members]))

    def code(self, cells: np.ndarray, f: int) -> np.ndarray:
        """The bin numbers of feature ``f`` from the cells of its group."""
        members = self.members[self.group_of(f)]
        below = self.cells(members[members.index(f) + 1 :])
        return cells // np.uint16(below) % np.uint16(self.sizes[f])

    def group_of(self, f: int) -> int:
        return next(g for g, members in enumerate(self.members) if f in members)

    def combined(self, codes: np.ndarray) -> Iterator[np.ndarray]:
        """Per group the cells of the rows."""
        for members in self.members:
            cell = codes[members[0]].astype(np.uint16)
            for f in members[1:]:
                cell = cell * np.uint16(self.sizes[f]) + codes[f]
            yield cell

    def sums(self, cells: Iterable[np.ndarray], place: np.ndarray, weight: np.ndarray, n: int) -> Iterator[np.ndarray]:
        """Per group the weights added up by ``place`` (of ``n``) and cell."""
        for members, cell in zip(self.members, cells, strict=True):
            size = self.cells(members)
            yield np.bincount(place * size + cell, weight, n * size)

    def apart(self, group: int, sums: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """(feature, sums by place, bin and what else is told apart within a cell) of a group's sums."""
        members = self.members[group]
        shape = [self.sizes[f] for f in members]
        cube = sums.reshape(n, *shape, *([] if sums.size == n * np.prod(shape) else [-1]))
        if len(members) == 1:
            yield members[0], cube
            return
        for k, f in enumerate(members):
            yield f, cube.sum(axis=tuple(a for a in range(1, len(members) + 1) if a != k + 1))


def _told_apart(sums: np.ndarray) -> np.ndarray:
    """Weights and sums of signs, in a last axis, from sums of both in one number."""
    weights = np.rint(sums / UNIT)
    return np.stack([weights, sums - weights * UNIT], axis=-1)


class Binner:
    """Quantile borders of features and labels; a value has the number of the first border at or above it."""

    def __init__(self, features: list[list[float]], labels: list[float]):
        self.features = [np.array(f, float) for f in features]
        self.labels = np.array(labels, float)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """A line of bin numbers per feature, of rows ``x``."""
        return np.stack([np.searchsorted(b, x[:, i]) for i, b in enumerate(self.features)]).astype(np.uint8)


def _told(df: DataFrame, features: str, label: str) -> DataFrame:
    """The features and label of rows that have one."""
    rows = df.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"))
    return rows.where(F.col("y").isNotNull())


def in_blocks(told: DataFrame, binner: Binner) -> DataFrame:
    """Rows in blocks of binned ones."""
    numbered, width = told.withColumn("row", F.monotonically_increasing_id()), len(binner.features)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, BLOCK_ROWS):
            x = batch.column("x").combine_chunks().flatten().to_numpy().reshape(batch.num_rows, width)
            y, row = (batch.column(c).to_numpy() for c in ("y", "row"))
            yield Block(binner.codes(x), row, y, np.zeros(len(y))).packed()

    return numbered.mapInArrow(tasks, Block.FIELDS)


def binned(df: DataFrame, features: str, label: str, bins: int = BINS) -> tuple[Binner, DataFrame]:
    """Borders, and the rows in blocks, computed once."""
    rows = _told(df, features, label)
    first = rows.select(F.size("x")).first()
    if first is None:
        raise ValueError("no rows to fit")
    width = first[0]
    shares = [i / bins for i in range(1, bins)]
    finer = [i / LEAF_BINS for i in range(1, LEAF_BINS + 1)]
    asked = [F.percentile_approx(F.col("x")[i], shares, 10 * bins).alias(f"x{i}") for i in range(width)]
    row = rows.agg(*asked, F.percentile_approx("y", finer, 10 * LEAF_BINS).alias("y")).first()
    binner = Binner([sorted(set(row[f"x{i}"] or [])) for i in range(width)], sorted(set(row["y"])))

    stored = cut_lineage(in_blocks(rows, binner))
    # many passes follow, so that few rows are better kept together, and a task is worth its start
    most = 2 * rows.sparkSession.sparkContext.defaultParallelism
    return binner, stored.coalesce(max(1, min(most, -(-_n_rows(stored) // PART_ROWS))))


def _n_rows(blocks: DataFrame) -> int:
    return int(blocks.agg(F.sum(F.octet_length("y") / 8)).first()[0])


def _absolute_cost(hist: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of absolute deviations from the median, over the last axis of weights per label value."""
    weight, weighted = hist.cumsum(axis=-1), (hist * values).cumsum(axis=-1)
    total, whole = weight[..., -1], weighted[..., -1]
    at = (weight * 2 >= total[..., None]).argmax(axis=-1)[..., None]
    below, sum_below = np.take_along_axis(weight, at, -1)[..., 0], np.take_along_axis(weighted, at, -1)[..., 0]
    middle = values[at[..., 0]]
    return middle * below - sum_below + (whole - sum_below) - middle * (total - below)


def best_split(sums: np.ndarray, allowed: np.ndarray, values: np.ndarray | None) -> tuple[float, int, int]:
    """(gain, feature, bin) of one node; gain 0 without a split.

    ``sums`` has (feature, bin, weights and sums of labels), or (feature, bin, label bin) with the label ``values``.
    """
    left = sums[allowed].cumsum(axis=1)
    right = left[:, -1:] - left
    if values is None:
        wl, wr = left[..., 0], right[..., 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            apart = left[..., 1] / wl - right[..., 1] / wr
            gain = wl * wr / (wl + wr) * apart * apart
        gain = np.where((wl > 0) & (wr > 0), gain, 0.0)
    else:
        wl, wr = left.sum(axis=-1), right.sum(axis=-1)
        whole = _absolute_cost(left[:, -1:], values)
        gain = np.where((wl > 0) & (wr > 0), whole - _absolute_cost(left, values) - _absolute_cost(right, values), 0.0)
    f, at = np.unravel_index(gain.argmax(), gain.shape)
    return (float(gain[f, at]), int(allowed[f]), int(at)) if gain[f, at] > 1e-12 else (0.0, -1, 0)


class Grower:
    """Grows trees together, level by level."""

    def __init__(self, rows: DataFrame, binner: Binner, criterion: str, max_depth: int, seed: int):
        self.rows, self.binner, self.max_depth, self.seed = rows, binner, max_depth, seed
        self.width = len(binner.features)
        borders = binner.labels
        if len(borders) > LABEL_BINS:
            borders = borders[np.linspace(0, len(borders) - 1, LABEL_BINS).round().astype(int)]
        self.values = borders if criterion == "absolute_error" else None
        self.groups = Groups(binner)

    def grow(self, n_trees: int, share: float, max_features: float, least_share: float, label=None, first: int = 0) -> list[Tree]:
        """Trees on samples of the rows; ``label`` turns a block into signs that are learned instead of its labels."""
        trees = [Tree() for _ in range(n_trees)]
        active = [[0] for _ in trees]
        cells = self.width * BINS * (2 if self.values is None else len(self.values))
        total: list[float | None] = [None] * n_trees
        self.sampled = share < 1 or n_trees > 1
        for _ in range(self.max_depth):
            going = [t for t in range(n_trees) if active[t]]
            while going:
                group, size = [], 0
                while going and (not group or size + len(active[going[0]]) * cells <= PASS_NUMBERS):
                    size += len(active[going[0]]) * cells
                    group.append(going.pop(0))
                sums = self._totals([trees[t] for t in group], [active[t] for t in group], [first + t for t in group], share, label)
                at = 0
                for t in group:
                    found = sums[at : at + len(active[t]) * cells].reshape(len(active[t]), self.width, BINS, -1)
                    at += len(active[t]) * cells
                    weights = found[:, 0, :, 0].sum(axis=1) if self.values is None else found[:, 0].sum(axis=(1, 2))
                    total[t] = weights.sum() if total[t] is None else total[t]
                    children = []
                    for node, own, weight in zip(active[t], found, weights, strict=True):
                        trees[t].weight[node] = float(weight)
                        if weight < max(2, least_share * total[t]):
                            continue
                        rng = np.random.default_rng([self.seed, first + t, trees[t].path[node]])
                        allowed = np.sort(rng.permutation(self.width)[: max(1, int(max_features * self.width))])
                        gain, f, b = best_split(own, allowed, self.values)
                        if gain:
                            children += trees[t].split(node, f, b)
                    active[t] = children
        return trees

    def _totals(self, trees: list[Tree], active: list[list[int]], salts: list[int], share: float, label) -> np.ndarray:
        return _added(self.rows, self._sums(trees, active, salts, share, label))

    def _sums(self, trees: list[Tree], active: list[list[int]], salts: list[int], share: float, label):
        width, values, seed, groups, sampled = self.width, self.values, self.seed, self.groups, self.sampled
        numbers = []
        for tree, nodes in zip(trees, active, strict=True):
            number = np.full(len(tree.feature), -1)
            number[nodes] = np.arange(len(nodes))
            numbers.append(number)
        depth_values = 2 if values is None else len(values)

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = [np.zeros((len(nodes), width, BINS, depth_values)) for nodes in active]
            for block in Block.each(batches, width):
                y = block.y if label is None else label(block)
                at_value = None if values is None else np.minimum(np.searchsorted(values, y), len(values) - 1)
                for tree, number, salt, sums in zip(trees, numbers, salts, out, strict=True):
                    place, n = number[tree.leaves(block.codes)], len(sums)
                    weight = drawn(block.row, share, seed * 1_000_003 + salt) if sampled else np.ones(len(y))
                    kept = (place >= 0) & (weight > 0)
                    # mostly all rows are kept
                    own = slice(None) if kept.all() else np.flatnonzero(kept)
                    place, weight = place[own], weight[own]
                    if values is None:
                        cells = list(groups.combined(block.codes[:, own]))
                        told = [weight * (UNIT + y[own])] if label else [weight, weight * y[own]]
                        for g, found in enumerate(zip(*(groups.sums(cells, place, w, n) for w in told), strict=True)):
                            both = _told_apart(found[0]) if label else np.stack(found, axis=-1)
                            for k in range(2):
                                for f, by_bin in groups.apart(g, both[:, k], n):
                                    sums[:, f, : by_bin.shape[1], k] += by_bin
                        continue
                    for f in range(width):
                        cell = (place * BINS + block.codes[f][own]) * depth_values + at_value[own]
                        sums[:, f] += np.bincount(cell, weight, n * BINS * depth_values).reshape(n, BINS, -1)
            yield _as_batch(np.concatenate([s.ravel() for s in out]))

        return add_up

    def fill(self, trees: list[Tree], share: float) -> None:
        """Leaf values: means, or medians from a fine histogram of the labels."""
        borders = self.binner.labels if self.values is not None else None
        n_values = 2 if borders is None else len(borders)
        width, seed = self.width, self.seed
        step = max(1, PASS_NUMBERS // (n_values * max(len(t.feature) for t in trees)))
        for start in range(0, len(trees), step):
            group = trees[start : start + step]

            def add_up(batches: Iterator[pa.RecordBatch], group=group, start=start) -> Iterator[pa.RecordBatch]:
                out = [np.zeros((len(t.feature), n_values)) for t in group]
                for block in Block.each(batches, width):
                    row, y = block.row, block.y
                    for k, (tree, sums) in enumerate(zip(group, out, strict=True)):
                        leaf = tree.leaves(block.codes)
                        many = share < 1 or len(trees) > 1
                        weight = drawn(row, share, seed * 1_000_003 + start + k) if many else np.ones(len(row))
                        if borders is None:
                            sums[:, 0] += np.bincount(leaf, weight, len(sums))
                            sums[:, 1] += np.bincount(leaf, weight * y, len(sums))
                        else:
                            at = np.minimum(np.searchsorted(borders, y), n_values - 1)
                            sums += np.bincount(leaf * n_values + at, weight, sums.size).reshape(sums.shape)
                yield _as_batch(np.concatenate([s.ravel() for s in out]))

            sums, at = _added(self.rows, add_up), 0
            for tree in group:
                own = sums[at : at + len(tree.feature) * n_values].reshape(-1, n_values)
                at += own.size
                for node in range(len(tree.feature)):
                    if borders is None:
                        tree.value[node] = float(own[node, 1] / own[node, 0]) if own[node, 0] else 0.0
                    elif own[node].sum():
                        tree.value[node] = float(borders[(own[node].cumsum() * 2 >= own[node].sum()).argmax()])


class Held(Grower):
    """Boosting by a task that holds all rows: the cells of their groups of features, what is left to learn, and their nodes."""

    def __init__(self, blocks: Iterator[Block], n_rows: int, binner: Binner, max_depth: int, seed: int, share: float):
        super().__init__(None, binner, "friedman_mse", max_depth, seed)
        self.share, self.left = share, np.empty(n_rows)
        self.row = np.empty(n_rows if share < 1 else 0, np.int64)
        self.weight = np.empty(len(self.row), np.uint8)
        self.cells = [np.empty(n_rows, np.uint16) for _ in self.groups.members]
        # a tree has fewer nodes than 2 ** (levels + 1), which the type of node numbers has to hold
        self.node = np.zeros(n_rows, np.min_scalar_type(2 ** (max_depth + 1)))
        at = 0
        for block in blocks:
            own = slice(at, at + len(block.y))
            self.left[own] = block.y
            self.row[own] = block.row[: len(self.row[own])]
            for held, cell in zip(self.cells, self.groups.combined(block.codes), strict=True):
                held[own] = cell
            at += len(block.y)

    @staticmethod
    def bytes_of(n_rows: int, binner: Binner) -> int:
        return n_rows * (2 * len(Groups(binner).members) + 18)

    def _steps(self) -> Iterator[slice]:
        for at in range(0, len(self.left), STEP_ROWS):
            yield slice(at, at + STEP_ROWS)

    def _lead(self, tree: Tree, start: int, end: int) -> None:
        """Takes rows from the nodes numbered from ``start`` to before ``end`` to their children."""
        kind = self.node.dtype.type
        for node in range(start, end):
            if (f := tree.feature[node]) >= 0:
                cells = self.cells[self.groups.group_of(f)]
                for own in self._steps():
                    goes = (self.groups.code(cells[own], f) > tree.bin[node]).astype(kind)
                    np.copyto(self.node[own], kind(tree.left[node]) + goes, where=self.node[own] == node)

    def _totals(self, trees: list[Tree], active: list[list[int]], salts: list[int], share: float, label) -> np.ndarray:
        (tree,), (nodes,) = trees, active
        # nodes are numbered level by level, and all before the active ones have their children by now
        self._lead(tree, self.led, nodes[0])
        self.led = nodes[0]
        number, n = np.full(len(tree.feature), -1), len(nodes)
        number[nodes] = np.arange(n)
        out = [0.0] * len(self.cells)
        for own in self._steps():
            place = number[self.node[own]]
            told = UNIT + np.sign(self.left[own])
            if self.share < 1:
                told *= self.weight[own]
            kept = place >= 0
            picked = slice(None) if kept.all() else np.flatnonzero(kept)
            found = self.groups.sums((c[own][picked] for c in self.cells), place[picked], told[picked], n)
            out = [sofar + more for sofar, more in zip(out, found, strict=True)]
        sums = np.zeros((n, self.width, BINS, 2))
        for g, both in enumerate(map(_told_apart, out)):
            for k in range(2):
                for f, by_bin in self.groups.apart(g, both[:, k], n):
                    sums[:, f, : by_bin.shape[1], k] = by_bin
        return sums.ravel()

    def boost(self, n_rounds: int, rate: float) -> tuple[float, list[Tree], list[float]]:
        """(median of the labels, trees, mean absolute error before each round)."""
        start = _lower_median(self.left)
        self.left -= start
        trees, history = [], []
        for turn in range(n_rounds):
            if self.share < 1:
                for own in self._steps():
                    self.weight[own] = drawn(self.row[own], self.share, self.seed * 1_000_003 + turn)
            self.node[:], self.led = 0, 0
            (tree,) = self.grow(1, self.share, 1.0, 0.0, first=turn)
            self._lead(tree, self.led, len(tree.feature))
            history.append(sum(float(np.abs(self.left[own]).sum()) for own in self._steps()) / len(self.left))
            for node in range(len(tree.feature)):
                if tree.feature[node] < 0:
                    inside = self.node == node
                    tree.value[node] = _lower_median(self.left[inside & (self.weight > 0) if self.share < 1 else inside])
            for own in self._steps():
                self.left[own] -= (rate * np.array(tree.value))[self.node[own]]
            trees.append(tree)
        return start, trees, history


def _lower_median(values: np.ndarray) -> float:
    """The lower one of two; 0 without values."""
    if not len(values):
        return 0.0
    middle = (len(values) - 1) // 2
    return float(np.partition(values, middle)[middle])


def _boosted_by_one(rows: DataFrame, binner: Binner, n_rows: int, max_depth: int, seed: int, n_rounds: int, share: float, rate: float) -> tuple[float, list[Tree], list[float]]:
    """What :meth:`Held.boost` gives, by a task that reads all blocks."""
    width = len(binner.features)

    def boost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, trees, history = Held(Block.each(batches, width), n_rows, binner, max_depth, seed, share).boost(n_rounds, rate)
        told = json.dumps({"start": start, "trees": [asdict(t) for t in trees], "history": history})
        yield pa.RecordBatch.from_arrays([pa.array([told])], ["told"])

    told = json.loads(rows.coalesce(1).mapInArrow(boost, "told string").first()[0])
    return told["start"], [Tree(**t) for t in told["trees"]], told["history"]


def _medians(rows: DataFrame, width: int, tree: Tree, left, kept, low: float, high: float) -> tuple[list[float], float, float, float]:
    """(median of each leaf, mean absolute value, least and greatest value) of what ``left`` makes of blocks.

    Medians are exact, the lower one of two: a pass counts values in MEDIAN_BINS bins per leaf between ``low`` and ``high``,
    whose ends are open; further ones cut a median's bin again where it holds too many rows. Then the values in the last
    bins are read, equal ones once. Only rows that are ``kept`` count for medians.
    """
    n_leaves = len(tree.feature)
    lows, steps = np.full(n_leaves, low), np.full(n_leaves, max((high - low) / MEDIAN_BINS, 1e-300))
    chosen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # (lows, steps, bin) per leaf, of the passes so far
    wanted: np.ndarray | None = None

    def bin_of(value: np.ndarray, leaf: np.ndarray, lows: np.ndarray, steps: np.ndarray) -> np.ndarray:
        return np.clip((value - lows[leaf]) / steps[leaf], 0, MEDIAN_BINS - 1).astype(np.int64)

    def sought(block: Block, chosen: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(values, leaves, all values): those that lie in the chosen bins."""
        whole, leaf, mask = left(block), tree.leaves(block.codes), kept(block)
        for lows, steps, at in chosen:
            mask = mask & (bin_of(whole, leaf, lows, steps) == at[leaf])
        return whole[mask], leaf[mask], whole

    while True:

        def count(batches: Iterator[pa.RecordBatch], lows=lows, steps=steps, chosen=tuple(chosen)) -> Iterator[pa.RecordBatch]:
            sums, told = np.zeros(n_leaves * MEDIAN_BINS), np.array([0.0, 0.0])
            for block in Block.each(batches, width):
                value, leaf, whole = sought(block, chosen)
                sums += np.bincount(leaf * MEDIAN_BINS + bin_of(value, leaf, lows, steps), minlength=len(sums))
                told += [np.abs(whole).sum(), len(whole)]
            yield _as_batch(np.concatenate([sums, told]))

        sums = _added(rows, count)
        counts = sums[:-2].reshape(n_leaves, MEDIAN_BINS).astype(np.int64)
        if wanted is None:
            # leaves without rows and inner nodes want none
            error, wanted = float(sums[-2] / sums[-1]), (counts.sum(axis=1) - 1) // 2
            filled = counts.any(axis=0).nonzero()[0]
            reach = (low + filled.min() * steps[0] if filled[0] else None, low + (filled.max() + 1) * steps[0] if filled[-1] < MEDIAN_BINS - 1 else None)
        upto = counts.cumsum(axis=1)
        at = (upto > wanted[:, None]).argmax(axis=1)
        own = np.take_along_axis(counts, at[:, None], 1)[:, 0]
        wanted = wanted - (np.take_along_axis(upto, at[:, None], 1)[:, 0] - own)
        chosen.append((lows, steps, at))
        if own.max() <= MEDIAN_ROWS or len(chosen) == 4:
            break
        lows, steps = lows + at * steps, np.maximum(steps / MEDIAN_BINS, 1e-300)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [sought(block, chosen)[:2] for block in Block.each(batches, width)]
        value, leaf = (np.concatenate(part) for part in zip(*found, strict=True)) if found else (np.zeros(0), np.zeros(0, np.int64))
        for k in np.unique(leaf):
            each, times = np.unique(value[leaf == k], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(each), k, np.int32)), pa.array(each), pa.array(times)], ["leaf", "value", "times"])

    table = rows.mapInArrow(read, "leaf int, value double, times bigint").toArrow()
    leaf, value, times = (table.column(c).to_numpy() for c in ("leaf", "value", "times"))
    medians = [0.0] * n_leaves
    for k in np.unique(leaf):
        order = np.argsort(value[leaf == k])
        upto = times[leaf == k][order].cumsum()
        medians[k] = float(value[leaf == k][order][(upto > wanted[k]).argmax()])
    return medians, error, low if reach[0] is None else reach[0], high if reach[1] is None else reach[1]


class _TreeParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    nTrees = Param(Params._dummy(), "nTrees", "trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)
    share = Param(Params._dummy(), "share", "rows a tree learns from, as a share", TypeConverters.toFloat)


class TreeForest(Estimator, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """A forest by ``criterion``, with scikit-style least shares of rows for a split."""

    criterion = Param(Params._dummy(), "criterion", "friedman_mse or absolute_error", TypeConverters.toString)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "features tried per split, as a share", TypeConverters.toFloat)
    minSplit = Param(Params._dummy(), "minSplit", "rows a node needs to be split, as a share", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction", seed: int = 42,
        nTrees: int = 100, maxDepth: int = 5, share: float = 1.0, criterion: str = "friedman_mse", maxFeatures: float = 1.0,
        minSplit: float = 0.0,
    ):
        super().__init__()
        if criterion not in CRITERIA:
            raise ValueError(f"criterion must be one of {CRITERIA}")
        self._set(featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol, seed=seed, nTrees=nTrees,
                  maxDepth=maxDepth, share=share, criterion=criterion, maxFeatures=maxFeatures, minSplit=minSplit)

    def _fit(self, df: DataFrame) -> TreeModel:
        get = self.getOrDefault
        binner, rows = binned(df, self.getFeaturesCol(), self.getLabelCol())
        grower = Grower(rows, binner, get(self.criterion), get(self.maxDepth), self.getSeed())
        trees = grower.grow(get(self.nTrees), get(self.share), get(self.maxFeatures), get(self.minSplit))
        grower.fill(trees, get(self.share))
        return _model(self, binner, trees, 0.0, [1.0 / len(trees)] * len(trees), [])


class AbsoluteBoosting(Estimator, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees on absolute error whose leaves hold medians of the residuals."""

    rate = Param(Params._dummy(), "rate", "share of a leaf's median that is added", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction", seed: int = 42,
        nTrees: int = 100, maxDepth: int = 3, share: float = 1.0, rate: float = 0.1,
    ):
        super().__init__()
        self._set(featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol, seed=seed, nTrees=nTrees,
                  maxDepth=maxDepth, share=share, rate=rate)

    def _fit(self, df: DataFrame) -> TreeModel:
        get = self.getOrDefault
        n_rounds, share, rate = get(self.nTrees), get(self.share), get(self.rate)
        binner, rows = binned(df, self.getFeaturesCol(), self.getLabelCol())
        width, seed = len(binner.features), self.getSeed()
        n_rows = _n_rows(rows)
        if Held.bytes_of(n_rows, binner) <= HELD_BYTES:
            start, trees, history = _boosted_by_one(rows, binner, n_rows, get(self.maxDepth), seed, n_rounds, share, rate)
            return _model(self, binner, trees, start, [rate] * len(trees), history)
        # the median of the labels is that of the residuals in a tree of one leaf
        low, high = float(binner.labels[0]), float(binner.labels[-1])
        (start,), _, low, high = _medians(rows, width, Tree(), lambda b: b.y, lambda b: np.ones(len(b.y), bool), low, high)
        low, high = low - start, high - start
        trees, history = [], []
        stored = 0  # trees whose share is in "done"
        n_parts = max(1, rows.rdd.getNumPartitions())

        def residual(block: Block, since: list[Tree]) -> np.ndarray:
            left = block.y - start - block.done
            for tree in since:
                left = left - (rate * np.array(tree.value))[tree.leaves(block.codes)]
            return left

        for turn in range(n_rounds):
            since = trees[stored:]
            left = lambda block, since=since: residual(block, since)
            kept = lambda block, turn=turn: drawn(block.row, share, seed * 1_000_003 + turn) > 0 if share < 1 else np.ones(len(block.y), bool)
            grower = Grower(rows, binner, "friedman_mse", get(self.maxDepth), seed)
            (tree,) = grower.grow(1, share, 1.0, 0.0, lambda block, left=left: np.sign(left(block)), first=turn)
            tree.value, error, low, high = _medians(rows, width, tree, left, kept, low, high)
            history.append(error)
            # rounding may carry residuals past these, which does no harm: bins at the ends are open
            low, high = low - rate * max(tree.value), high - rate * min(tree.value)
            trees.append(tree)
            if len(trees) - stored >= STORED_ROUNDS and turn + 1 < n_rounds:
                since = trees[stored:]

                def store(batches: Iterator[pa.RecordBatch], since=since) -> Iterator[pa.RecordBatch]:
                    for block in Block.each(batches, width):
                        block.done = block.y - start - residual(block, since)
                        yield block.packed()

                rows = cut_lineage(rows.mapInArrow(store, Block.FIELDS).coalesce(n_parts))
                stored = len(trees)
        return _model(self, binner, trees, start, [rate] * len(trees), history)


def _model(estimator: Estimator, binner: Binner, trees: list[Tree], base: float, rates: list[float], history: list[float]) -> TreeModel:
    told = {
        "borders": [b.tolist() for b in binner.features],
        "base": base,
        "trees": [[t.feature, t.bin, t.left, t.value, max(t.depth), r] for t, r in zip(trees, rates, strict=True)],
    }
    return TreeModel(
        featuresCol=estimator.getFeaturesCol(), predictionCol=estimator.getPredictionCol(), trees=json.dumps(told), history=history
    )


class TreeModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """A weighted sum of trees over binned features."""

    trees = Param(Params._dummy(), "trees", "borders, base and trees as JSON", TypeConverters.toString)
    history = Param(Params._dummy(), "history", "mean absolute error of the rows before each round", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", predictionCol: str = "prediction", trees: str = "{}", history: list[float] = ()):
        super().__init__()
        self._set(featuresCol=featuresCol, predictionCol=predictionCol, trees=trees, history=list(history))

    def getHistory(self) -> list[float]:  # noqa: N802
        return self.getOrDefault(self.history)

    def _transform(self, df: DataFrame) -> DataFrame:
        told = json.loads(self.getOrDefault(self.trees))
        binner = Binner(told["borders"], [])
        trees = []
        for feature, at, left, value, depth, rate in told["trees"]:
            tree = Tree(feature, at, left, value, [depth])
            trees.append((tree, np.array(value) * rate))

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            out = np.full(len(x), told["base"], float)
            if len(x):
                codes = binner.codes(np.stack(x.to_numpy()))
                for tree, value in trees:
                    out += value[tree.leaves(codes)]
            return pd.Series(out)

        return df.withColumn(self.getPredictionCol(), predict(vector_to_array(F.col(self.getFeaturesCol()))))
