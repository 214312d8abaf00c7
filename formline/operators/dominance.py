"""Pool rows with more points at an affordable value, counted and searched without forming pairs.

Each question (more points than ``_least``, a value within ``_budget``, a position, clubs that are
closed, names that are excluded) is answered from value-sorted blocks of the pool. A block keeps

* merge counts: for every power of two the blocks of so many consecutive rows with their points sorted,
  so that the rows of any prefix with more points than asked are counted in as many searches as the
  prefix length has binary digits. Sorted by club first, the same counts serve one club alone;
* a frontier: for every prefix the few rows one of which must be the best answer, whatever is closed or
  excluded within the given bounds.

What closed clubs and excluded names would add is counted alike and taken off. A pool proven small travels
to the questions; of a larger one, blocks of ``BLOCK_ROWS`` rows and the questions that reach
down to them are shuffled together. Either way rows grow with the questions, not with questions times pool.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from formline import session
from formline.session import cut_lineage

#: Pool rows per block where the pool is too large to travel.
BLOCK_ROWS = 65_536
#: Questions answered in one vectorised step.
STEP_ROWS = 20_000
#: Rows and bytes of a pool that travels at most; as many rows of numbers need not be counted before they are read.
TRAVEL_ROWS = 500_000
TRAVEL_BYTES = 48_000_000


def table_within(pool: DataFrame) -> pa.Table | None:
    """The rows of a pool that is small enough to travel, else None."""
    return session.table_within(pool, TRAVEL_ROWS, TRAVEL_BYTES)


@dataclass(frozen=True)
class Bounds:
    """The most a question can exclude: names, names of any one open club, and closed clubs."""

    names: int
    per_club: int
    closed: int

    @property
    def most(self) -> int:
        """Rows among which the best answer is: each bar takes at most its share of them away."""
        return self.names + self.closed * (self.per_club + 1) + 1


def numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Whole numbers as 64-bit integers, others as doubles; nulls below everything."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_integer(column.type):
        return pc.fill_null(column.cast(pa.int64()), np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
    return pc.fill_null(column.cast(pa.float64()), -np.inf).to_numpy(zero_copy_only=False)


class MergeCounts:
    """Counts ranks of at least some size among the first rows of a sequence."""

    def __init__(self, ranks: np.ndarray, n_ranks: int):
        self.width = n_ranks + 1
        places, size = np.arange(len(ranks)), 1
        self.levels = [places * self.width + ranks]
        while size < len(ranks):
            size *= 2
            self.levels.append(np.sort(places // size * self.width + ranks))

    def above(self, prefix: np.ndarray, least: np.ndarray) -> np.ndarray:
        """For each question the number of its first ``prefix`` rows that have a rank of ``least`` or more."""
        out = np.zeros(len(prefix), np.int64)
        for level, keys in enumerate(self.levels):
            rows = np.flatnonzero(prefix >> level & 1)
            block = (prefix[rows] >> level) - 1
            out[rows] += ((block + 1) << level) - np.searchsorted(keys, block * self.width + least[rows])
        return out


def frontiers(places: np.ndarray, clubs: np.ndarray, bounds: Bounds) -> tuple[np.ndarray, np.ndarray]:
    """Frontier number of every prefix (0 to n), and per frontier its rows, best first, -1 behind them.

    ``places`` are the rows' places from best to worst, ``clubs`` their clubs (-1: none). Kept are the best
    ``most`` rows of those that are among the best of their club.
    """
    n, quota = len(places), bounds.per_club + 1
    row_at = np.empty(n, np.int64)
    row_at[places] = np.arange(n)
    kept: list[int] = []
    of_club: dict[int, list[int]] = {}
    numbers_of, found = np.zeros(n + 1, np.int64), [[]]
    for i, (place, club) in enumerate(zip(places.tolist(), clubs.tolist(), strict=True)):
        if len(kept) < bounds.most or place < kept[-1]:
            mates = of_club.setdefault(club, [])
            most = bounds.names + 1 if club < 0 else quota
            if len(mates) < most or place < mates[-1]:
                mates.insert(bisect_left(mates, place), place)
                kept.insert(bisect_left(kept, place), place)
                if len(mates) > most:
                    worst = mates.pop()
                    k = bisect_left(kept, worst)
                    if k < len(kept) and kept[k] == worst:
                        del kept[k]
                del kept[bounds.most :]
                found.append(kept.copy())
        numbers_of[i + 1] = len(found) - 1
    table = np.full((len(found), max(map(len, found)) + 1), -1, np.int64)
    for k, row in enumerate(found):
        table[k, : len(row)] = row_at[row]
    return numbers_of, table


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Row numbers and values of all elements of a list column."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten()


def _among(keys: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[place] == keys


class Block:
    """Players of one position (name, value, club, points); rows without a value are never affordable."""

    def __init__(self, players: pa.Table, bounds: Bounds):
        players = players.filter(pc.is_valid(players["value"]))
        best = pc.sort_indices(
            players, sort_keys=[("points", "descending"), ("name", "ascending")], null_placement="at_end"
        ).to_numpy()
        place = np.empty(len(best), np.int64)
        place[best] = np.arange(len(best))
        order = np.argsort(numbers(players["value"]), kind="stable")
        self.players = players.take(pa.array(order))
        self.values = numbers(self.players["value"])
        self.points, self.rank = np.unique(numbers(self.players["points"]), return_inverse=True)
        self.names = pc.unique(self.players["name"])
        codes = pc.index_in(self.players["name"], value_set=self.names).to_numpy()
        self.by_name = np.argsort(codes, kind="stable")
        self.name_starts = np.searchsorted(codes[self.by_name], np.arange(len(self.names) + 1))
        clubs = self.players["club"].combine_chunks() if players.num_rows else self.players["club"]
        self.clubs = pc.unique(clubs.drop_null())
        self.club = pc.fill_null(pc.index_in(clubs, value_set=self.clubs), -1).to_numpy().astype(np.int64)
        n = len(self.values)
        self.first_equal = np.searchsorted(self.values, self.values)
        club_keys = self.club * (n + 1) + self.first_equal
        self.by_club = np.argsort(club_keys, kind="stable")
        self.club_keys = club_keys[self.by_club]
        self.version, self.frontier = frontiers(place[order], self.club, bounds)

    @cached_property
    def counts(self) -> MergeCounts:
        return MergeCounts(self.rank, len(self.points))

    @cached_property
    def club_counts(self) -> MergeCounts:
        return MergeCounts(self.rank[self.by_club], len(self.points))

    def answers(
        self, least: pa.Array | None, budget: pa.Array, closed: pa.ListArray, excluded: pa.ListArray, strict: bool, count: bool
    ) -> tuple[np.ndarray, np.ndarray]:
        """Number of answers to each question (where asked for) and the best one's row, -1 for none.

        Without ``least`` any points will do; ``strict`` wants a value below the budget, not at it.
        """
        q = len(budget)
        prefix = np.searchsorted(self.values, numbers(budget), "left" if strict else "right")
        prefix[pc.is_null(budget).to_numpy(zero_copy_only=False)] = 0
        rank = np.zeros(q, np.int64)
        if least is not None:
            rank = np.searchsorted(self.points, numbers(least), "right")
            rank[pc.is_null(least).to_numpy(zero_copy_only=False)] = len(self.points)
        n, n_clubs = len(self.values), len(self.clubs)
        asked, clubs = _flat(closed)
        clubs = pc.fill_null(pc.index_in(clubs, value_set=self.clubs), -1).to_numpy().astype(np.int64)
        asked, clubs = asked[clubs >= 0], clubs[clubs >= 0]
        shut = np.unique(asked * (n_clubs + 1) + clubs)
        asked, clubs = np.divmod(shut, n_clubs + 1)
        owner, names = _flat(excluded)
        names = pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy().astype(np.int64)
        owner, names = owner[names >= 0], names[names >= 0]
        size = self.name_starts[names + 1] - self.name_starts[names]  # a name may have several rows
        first = np.repeat(self.name_starts[names] - (np.cumsum(size) - size), size)
        own = np.unique(np.repeat(owner, size) * (n + 1) + self.by_name[first + np.arange(len(first))])
        counted = np.zeros(q, np.int64)
        if count:
            counted = self.counts.above(prefix, rank)
            until = np.searchsorted(self.club_keys, clubs * (n + 1) + prefix[asked])
            since = np.searchsorted(self.club_keys, clubs * (n + 1))
            least_rank = rank[asked]
            of_club = self.club_counts.above(until, least_rank) - self.club_counts.above(since, least_rank)
            counted -= np.bincount(asked, of_club, q).astype(np.int64)
            owner, row = np.divmod(own, n + 1)
            fits = (self.first_equal[row] < prefix[owner]) & (self.rank[row] >= rank[owner])
            fits &= ~_among(owner * (n_clubs + 1) + self.club[row], shut) | (self.club[row] < 0)
            counted -= np.bincount(owner[fits], minlength=q)
        return counted, self._best(prefix, rank, shut, own)

    def _best(self, prefix: np.ndarray, rank: np.ndarray, shut: np.ndarray, own: np.ndarray) -> np.ndarray:
        n, n_clubs = len(self.values), len(self.clubs)
        best = np.full(len(prefix), -1, np.int64)
        left = np.arange(len(prefix))
        version = self.version[prefix]
        for k in range(self.frontier.shape[1]):
            row = self.frontier[version[left], k]
            good = row >= 0
            left, row = left[good], row[good]
            good = self.rank[row] >= rank[left]  # rows come best first: the rest has no more points
            left, row = left[good], row[good]
            barred = _among(left * (n + 1) + row, own)
            barred |= _among(left * (n_clubs + 1) + self.club[row], shut) & (self.club[row] >= 0)
            best[left[~barred]] = row[~barred]
            left = left[barred]
            if not len(left):
                return best
        return best


PLAYER = ("name", "position", "value", "club", "points")


class Blocks:
    """Blocks by position of pool rows with the columns ``PLAYER``."""

    def __init__(self, players: pa.Table, bounds: Bounds):
        self.held = {
            p: Block(players.filter(pc.equal(players["position"], p)), bounds)
            for p in pc.unique(players["position"])
            if p.is_valid
        }
        self.player = pa.struct([(c, players.schema.field(c).type) for c in PLAYER])

    def answered(self, batch: pa.RecordBatch, keep: Sequence[str], strict: bool, count: bool) -> Iterator[pa.RecordBatch]:
        """The ``keep`` columns of questions that have an answer, with ``n_options`` and the best one, ``_in``."""
        for position, block in self.held.items():
            asked = batch.filter(pc.equal(batch.column("_position"), position.cast(batch.schema.field("_position").type)))
            for at in range(0, asked.num_rows, STEP_ROWS):
                step = asked.slice(at, STEP_ROWS)
                least = step.column("_least") if "_least" in step.schema.names else None
                n, best = block.answers(
                    least, step.column("_budget"), step.column("_closed"), step.column("_excluded"), strict, count
                )
                rows = np.flatnonzero(best >= 0)
                found = block.players.take(pa.array(best[rows])).to_batches()
                if not len(rows):
                    continue
                kept = step.take(pa.array(rows))
                entering = pa.StructArray.from_arrays(
                    [pa.concat_arrays([b.column(c) for b in found]) for c in PLAYER], list(PLAYER)
                )
                yield pa.RecordBatch.from_arrays(
                    [*(kept.column(c) for c in keep), pa.array(n[rows]), entering], [*keep, "n_options", "_in"]
                )


_built: dict[str, Blocks] = {}


class Finder:
    """Answers questions from one pool, however large; made once and asked as often as needed."""

    def __init__(self, pool: DataFrame, bounds: Bounds):
        """``pool`` has the columns ``PLAYER``."""
        self.bounds, self.pool = bounds, pool.select(*PLAYER)
        #: The pool's rows, if they are few.
        self.local = table_within(self.pool)
        self.small = None
        if self.local is not None:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, self.local.schema) as writer:
                writer.write_table(self.local)
            self.small = pool.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())
        #: What workers remember the prepared pool by, from one asking to the next.
        self.key = uuid.uuid4().hex
        self.pieces: DataFrame | None = None
        self.n_pieces = 0

    def answers(
        self, questions: DataFrame, keep: Sequence[str], strict: bool = False, count: bool = True
    ) -> DataFrame:
        """(``keep``, n_options, ``_in``) of the questions that have an answer; ``_in`` is the best one.

        Questions have ``_position``, ``_least`` (optional: without it any points will do), ``_budget``,
        ``_closed`` (clubs) and ``_excluded`` (names); ``keep`` names columns that tell them apart.
        """
        wanted = [c for c in ("_position", "_least", "_budget", "_closed", "_excluded") if c in questions.columns]
        asked = questions.select(*keep, *wanted)
        schema = StructType(
            [*(asked.schema[c] for c in keep), StructField("n_options", LongType()), StructField("_in", self.pool.schema)]
        )
        if self.small is not None:
            return asked.mapInArrow(_from_small(self.small, self.key, self.bounds, list(keep), strict, count), schema)
        return self._from_pieces(asked, list(keep), schema, strict, count)

    def answers_beside(self, rows: DataFrame, asked: str, excluded: str, out: str) -> DataFrame:
        """``rows`` with the best answers to their questions appended as ``out``, one per question or null.

        ``asked`` is an array of questions (``_position``, ``_least`` (optional), ``_budget``, ``_closed``) and ``excluded``
        the names that none of a row's questions wants; both columns are left out. Rows stay where they are: only for pools
        that are small.
        """
        kept = [f for f in rows.schema if f.name not in (asked, excluded)]
        schema = StructType([*kept, StructField(out, ArrayType(self.pool.schema))])
        ordered = rows.select(*(f.name for f in kept), asked, excluded)
        return ordered.mapInArrow(_beside(self.small, self.key, self.bounds, out), schema)

    def _placed(self) -> tuple[DataFrame, DataFrame]:
        """The pool cut into pieces by position and value, and the least value of each position in each piece."""
        if self.pieces is None:
            affordable = self.pool.where(F.col("value").isNotNull() & F.col("position").isNotNull())
            self.n_pieces = max(1, -(-affordable.count() // BLOCK_ROWS))
            ranged = affordable.repartitionByRange(self.n_pieces, "position", "value", "points", "name")
            self.pieces = cut_lineage(ranged.withColumn("_piece", F.spark_partition_id()))
        borders = self.pieces.groupBy("_piece", "position").agg(F.min("value").alias("_from"))
        return self.pieces, borders

    def _from_pieces(self, asked: DataFrame, keep: list[str], schema: StructType, strict: bool, count: bool) -> DataFrame:
        pieces, borders = self._placed()
        spark = asked.sparkSession
        salts = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // self.n_pieces))
        within = F.col("_from") < F.col("_budget") if strict else F.col("_from") <= F.col("_budget")
        routed = asked.join(F.broadcast(borders), (F.col("_position") == F.col("position")) & within).drop("position", "_from")
        questions = routed.withColumns({"_salt": F.pmod(F.xxhash64(*keep), F.lit(salts)).cast("int"), "_kind": F.lit(1)})
        copied = pieces.select(
            F.struct(*PLAYER).alias("_player"),
            "_piece",
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
            F.lit(0).alias("_kind"),
        )
        both = copied.unionByName(questions, allowMissingColumns=True)
        placed = both.repartition("_piece", "_salt").sortWithinPartitions("_piece", "_salt", "_kind")
        found = placed.mapInArrow(_from_stream(self.bounds, keep, strict, count), schema)
        order = F.struct(
            F.col("_in.points").isNull().alias("none"), (-F.col("_in.points")).alias("loss"), F.col("_in.name").alias("name")
        )
        return found.groupBy(*keep).agg(F.sum("n_options").alias("n_options"), F.min_by("_in", order).alias("_in"))


def _prepared(held, key: str, bounds: Bounds) -> Blocks:
    """The blocks of a pool that travels; one pool is kept per worker."""
    if key not in _built:
        _built.clear()
        _built[key] = Blocks(pa.ipc.open_stream(held.value).read_all(), bounds)
    return _built[key]


def _from_small(held, key: str, bounds: Bounds, keep: list[str], strict: bool, count: bool):
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _prepared(held, key, bounds)
        for batch in batches:
            yield from blocks.answered(batch, keep, strict, count)

    return tasks


def _beside(held, key: str, bounds: Bounds, out: str):
    """For batches whose last two columns are arrays of questions and the names excluded from them."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _prepared(held, key, bounds)
        for batch in batches:
            *kept, asked, excluded = batch.columns
            owner, questions = _flat(asked)
            each = [pa.array(np.arange(len(owner))), excluded.take(pa.array(owner)), *questions.flatten()]
            names = ["_at", "_excluded", *(f.name for f in questions.type)]
            found = list(blocks.answered(pa.RecordBatch.from_arrays(each, names), ["_at"], False, False))
            best = pa.nulls(len(owner), blocks.player)
            if found:
                place = np.full(len(owner), -1)
                at = np.concatenate([b.column("_at").to_numpy() for b in found])
                place[at] = np.arange(len(at))
                best = pa.concat_arrays([b.column("_in") for b in found]).take(pa.array(place, mask=place < 0))
            ends = np.concatenate([[0], np.bincount(owner, minlength=batch.num_rows).cumsum()]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(pa.array(ends), best)], [*batch.schema.names[:-2], out])

    return tasks


def _from_stream(bounds: Bounds, keep: list[str], strict: bool, count: bool):
    """Rows come by piece and salt, the pool's before the questions, so only one piece is held."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, players, blocks = None, [], None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("_piece", "_salt", "_kind")]
            if not batch.num_rows:
                continue
            changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            borders = [0, *changes.tolist(), batch.num_rows]
            for start, end in zip(borders, borders[1:], strict=False):
                piece, salt, kind = (int(c[start]) for c in columns)
                if (piece, salt) != now:
                    now, players, blocks = (piece, salt), [], None
                part = batch.slice(start, end - start)
                if kind == 0:
                    players.append(part.column("_player"))
                    continue
                if blocks is None and players:
                    table = pa.Table.from_batches([pa.RecordBatch.from_struct_array(p) for p in players])
                    blocks, players = Blocks(table, bounds), []
                if blocks is not None:
                    yield from blocks.answered(part, keep, strict, count)

    return tasks
