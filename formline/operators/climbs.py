"""Restarted climbs of whole squads inside a task, where the pool travels.

A squad is a line of row numbers of the pool, so that all starts of many teams climb side by side in arrays until none has
a swap left. Nothing is shuffled or stored between steps, and only each team's best end leaves the task.
The rules are those of :mod:`formline.operators.rosters`, whose plan by steps serves pools that do not travel.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from formline.operators.dominance import Blocks, Bounds, numbers

#: Squads that climb side by side.
ABREAST = 16_384


@dataclass(frozen=True)
class Climb:
    """Restarts, kicks a restart and their seed, most members of a club, and free transfers and the price of others, if any."""

    n_restarts: int
    n_kicks: int
    seed: int
    per_club: int
    charge: tuple[int, float] | None


def rows_tell_players(players: pa.Table) -> bool:
    """Whether row numbers stand for names, and doubles and whole numbers for what Spark computes with the rest."""
    name, value, points = (players.schema.field(c).type for c in ("name", "value", "points"))
    text = pa.types.is_string(name) or pa.types.is_large_string(name)
    exact = all(pa.types.is_integer(t) or pa.types.is_float64(t) for t in (value, points))
    if not exact or not (text or pa.types.is_integer(name)) or players["name"].null_count:
        return False
    return pc.count_distinct(players["name"]).as_py() == players.num_rows


class Climber:
    """Climbs with the players of a pool, one row per name."""

    def __init__(self, players: pa.Table, bounds: Bounds, climb: Climb):
        self.climb, self.names = climb, players["name"].combine_chunks()
        n = players.num_rows
        # a club that is not in a squad always has room
        self.per_club = max(climb.per_club, 1)
        self.value, self.valued = numbers(players["value"]), pc.is_valid(players["value"]).to_numpy()
        self.pointed = pc.is_valid(players["points"]).to_numpy()
        self.points = np.where(self.pointed, numbers(players["points"]).astype(float), np.nan)
        clubs = players["club"].combine_chunks()
        self.club = pc.fill_null(pc.index_in(clubs, value_set=pc.unique(clubs.drop_null())), -1).to_numpy().astype(np.int32)
        self.order = np.empty(n, np.int64)
        self.order[pc.sort_indices(self.names).to_numpy()] = np.arange(n)
        blocks = Blocks(players.append_column("_at", pa.array(np.arange(n, dtype=np.int32))), bounds)
        self.blocks, self.rows_of = list(blocks.held.values()), []
        self.position, self.least = np.full(n, -1, np.int8), np.zeros(n, np.int64)
        for k, (position, block) in enumerate(blocks.held.items()):
            self.rows_of.append(block.players["_at"].to_numpy())
            same = pc.fill_null(pc.equal(players["position"], position), False).to_numpy()
            self.position[same] = k
            above = np.searchsorted(block.points, numbers(players["points"])[same], "right")
            self.least[same] = np.where(self.pointed[same], above, len(block.points))
        self.luck = np.stack([self._luck(start) for start in range(1, climb.n_restarts + 1)]) if climb.n_restarts else None

    def _luck(self, start: int) -> np.ndarray:
        """The places of all names by the md5 of ``seed:start:name``."""
        head = f"{self.climb.seed}:{start}:"
        digests = b"".join(hashlib.md5(f"{head}{name}".encode(), usedforsecurity=False).digest() for name in self.names.to_pylist())
        high, low = np.frombuffer(digests, ">u8").reshape(-1, 2).T
        place = np.empty(len(high), np.int32)
        place[np.lexsort((self.order, low, high))] = np.arange(len(high))
        return place

    def ends(self, squads: np.ndarray, spare: np.ndarray, named: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(squad, start, swaps, net points) of each squad's best start; those that are not ``named`` stay as they are."""
        starts = self.climb.n_restarts + 1
        first, start = np.repeat(squads, starts, axis=0), np.tile(np.arange(starts), len(squads))
        state = Squads(first.copy(), first, np.repeat(spare, starts), np.zeros(len(first), np.int32))
        moving = np.repeat(named, starts)
        for _ in range(self.climb.n_kicks):
            self._kick(state, start, np.flatnonzero(moving & (start > 0)))
        going = np.flatnonzero(moving)
        while len(going):
            going = self._step(state, going)
        net = np.zeros(len(first))
        for member in state.members.T:
            net = net + np.where(self.pointed[member], self.points[member], 0.0)
        if self.climb.charge is not None:
            net = net - self._charged(self._moved(state.members, first)[1])
        best = net.reshape(-1, starts).argmax(axis=1)
        at = np.arange(len(squads)) * starts + best
        return state.members[at], best, state.swaps[at], net[at]

    def _charged(self, n_transfers: np.ndarray) -> np.ndarray:
        free, price = self.climb.charge
        return (np.maximum(n_transfers - free, 0) * price).astype(float)

    @staticmethod
    def _moved(members: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which members are new, and how many players that makes."""
        new = np.ones(members.shape, bool)
        for f in first.T:
            new &= members != f[:, None]
        counted = new.copy()
        for j in range(1, members.shape[1]):  # a player may be in a squad twice
            counted[:, j] &= ~(members[:, :j] == members[:, j, None]).any(axis=1)
        return new, counted.sum(axis=1)

    def _kick(self, state: Squads, start: np.ndarray, at: np.ndarray) -> None:
        members, first = state.members[at], state.first[at]
        new, _ = self._moved(members, first)
        luck = np.where(new, np.iinfo(np.int32).max, self.luck[start[at, None] - 1, members])
        out = members[np.arange(len(at)), luck.argmin(axis=1)]
        some = ~new.all(axis=1)
        at, out = at[some], out[some]
        found = self._answers(state, at, np.arange(len(at)), out, True, True)
        state.swap(self, at[found >= 0], out[found >= 0], found[found >= 0])

    def _answers(self, state: Squads, at: np.ndarray, owner: np.ndarray, out: np.ndarray, any_points: bool, not_first: bool) -> np.ndarray:
        """The best player for ``out`` in the squads ``at[owner]``, -1 for none: affordable, not in the squad, its club open."""
        found = np.full(len(out), -1, np.int32)
        for k, block in enumerate(self.blocks):
            asked = np.flatnonzero((self.position[out] == k) & self.valued[out])
            leaves, squad = out[asked], at[owner[asked]]
            prefix = np.searchsorted(block.values, state.spare[squad] + self.value[leaves], "right")
            least = np.zeros(len(asked), np.int64) if any_points else self.least[leaves]
            version = block.version[prefix]
            left = np.arange(len(asked))
            for column in block.frontier.T:
                row = column[version[left]]
                good = (row >= 0) & (block.rank[row] >= least[left])  # rows come best first: the rest has no more points
                left, row = left[good], row[good]
                if not len(left):
                    break
                player, own = self.rows_of[k][row], squad[left]
                club, members = self.club[player], state.members[own]
                barred = (members == player[:, None]).any(axis=1)
                if not_first:
                    barred |= (state.first[own] == player[:, None]).any(axis=1)
                shut = (self.club[members] == club[:, None]).sum(axis=1) >= self.per_club
                barred |= shut & (club >= 0) & (club != self.club[leaves[left]])
                found[asked[left[~barred]]] = player[~barred]
                left = left[barred]
        return found

    def _step(self, state: Squads, at: np.ndarray) -> np.ndarray:
        """Takes the best swap of the squads ``at``; those that had one."""
        members, first, size = state.members[at], state.first[at], state.members.shape[1]
        paid = self.climb.charge is not None
        owner, out = np.repeat(np.arange(len(at)), size), members.ravel()
        into = self._answers(state, at, owner, out, False, paid)
        new, moved = self._moved(members, first) if paid else (None, None)

        def loss(owner: np.ndarray, place: np.ndarray, out: np.ndarray, into: np.ndarray, joins: int) -> np.ndarray:
            plain = self.points[out] - self.points[into]
            if not paid:
                return plain
            after = moved[owner] - new[owner, place] + joins
            return plain + (self._charged(after) - self._charged(moved[owner]))

        some = np.flatnonzero(into >= 0)
        owner, out, into = owner[some], out[some], into[some]
        options = [(owner, out, into, loss(owner, some % size, out, into, 1))]
        if paid:
            gone = np.ones(first.shape, bool)
            for m in members.T:
                gone &= first != m[:, None]
            squad, which = np.nonzero(gone)
            back = first[squad, which]
            shut = (self.club[members[squad]] == self.club[back][:, None]).sum(axis=1) >= self.per_club
            for j in range(size):
                leaves = members[squad, j]
                fits = (self.position[back] == self.position[leaves]) & (self.points[back] > self.points[leaves])
                fits &= self.valued[back] & self.valued[leaves]
                fits &= self.value[back] <= state.spare[at[squad]] + np.where(self.valued[leaves], self.value[leaves], 0)
                fits &= (self.club[back] < 0) | (self.club[back] == self.club[leaves]) | ~shut
                o, a, b = squad[fits], leaves[fits], back[fits]
                options.append((o, a, b, loss(o, np.full(len(o), j), a, b, 0)))
        owner, out, into, lost = (np.concatenate(part) for part in zip(*options, strict=True))
        lowest, better = np.zeros(len(at)), np.flatnonzero(lost < 0)
        np.minimum.at(lowest, owner[better], lost[better])
        best = better[lost[better] == lowest[owner[better]]]
        # ties: the smaller name that leaves, then the smaller one that enters
        best = best[np.lexsort((self.order[into[best]], self.order[out[best]], owner[best]))]
        best = best[np.flatnonzero(np.diff(owner[best], prepend=-1))]
        at = at[owner[best]]
        state.swap(self, at, out[best], into[best])
        return at


@dataclass
class Squads:
    """Members, first members, money left and swaps so far."""

    members: np.ndarray
    first: np.ndarray
    spare: np.ndarray
    swaps: np.ndarray

    def swap(self, climber: Climber, at: np.ndarray, out: np.ndarray, into: np.ndarray) -> None:
        own = self.members[at]
        self.members[at] = np.where(own == out[:, None], into[:, None], own)
        self.spare[at] = self.spare[at] + climber.value[out] - climber.value[into]
        self.swaps[at] += 1


_built: dict[str, Climber] = {}


def ends_of(held, key: str, bounds: Bounds, climb: Climb):
    """For batches of (team, money left, names): (team, names, start, swaps, net points) of the best ends."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if key not in _built:
                _built.clear()
                _built[key] = Climber(pa.ipc.open_stream(held.value).read_all(), bounds, climb)
            climber = _built[key]
            step = max(1, ABREAST // (climb.n_restarts + 1))
            for at in range(0, batch.num_rows, step):
                team, spare, names = batch.slice(at, step).columns
                rows = pc.index_in(names.flatten().cast(climber.names.type), value_set=climber.names)
                squads = rows.to_numpy(zero_copy_only=False).astype(np.int32).reshape(len(team), -1)
                named = pc.is_valid(team).to_numpy(zero_copy_only=False)
                ends, start, swaps, net = climber.ends(squads, numbers(spare), named)
                offsets = np.arange(len(ends) + 1, dtype=np.int32) * ends.shape[1]
                found = pa.ListArray.from_arrays(pa.array(offsets), climber.names.take(pa.array(ends.ravel())))
                numbered = (pa.array(start, pa.int32()), pa.array(swaps, pa.int32()), pa.array(net))
                yield pa.RecordBatch.from_arrays([team, found, *numbered], ["team", "names", "start", "swaps", "net"])

    return tasks
