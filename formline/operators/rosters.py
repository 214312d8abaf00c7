"""Constrained rosters as tables: totals, legality, swaps, transfer costs and rewards.

A roster table has one row per team and member. A pool has one row per player with position,
value, club and points. All teams are handled in one plan. A legal team has exactly
``rules.size`` members, so its members may be gathered into an array; teams of unknown size are
only ever aggregated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import count, groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType, StructField, StructType

from formline.operators.assemble import union_all
from formline.operators.climbs import Climb, ends_of, rows_tell_players
from formline.operators.dominance import PLAYER, Bounds, Finder
from formline.session import cut_lineage, rows_within

#: Keys that a pool too large for a broadcast is copied to per position where swaps are listed.
SALTS = 16
#: Steps of a season that points travel in together.
STEP_BLOCK = 16


@dataclass(frozen=True)
class RosterRules:
    """Fewest and most members per position, members in all, budget and members per club."""

    # Two keepers, five defenders, five midfielders, three forwards.
    positions: Mapping[int, tuple[int, int]] = field(
        default_factory=lambda: {1: (2, 2), 2: (5, 5), 3: (5, 5), 4: (3, 3)}
    )
    size: int = 15
    max_value: float = 1000
    max_per_club: int = 3


@dataclass(frozen=True)
class RosterColumns:
    team: str = "team"
    name: str = "name"
    position: str = "position"
    value: str = "value"
    club: str = "club"
    points: str = "points"

    @property
    def player(self) -> list[str]:
        return [self.name, self.position, self.value, self.club, self.points]


@dataclass(frozen=True)
class TransferCharge:
    """Points taken off per transfer beyond the free ones, counted against the first roster."""

    # One free transfer, two points for each further one.
    n_free: int = 1
    penalty: float = 2

    def of(self, n_transfers: Column) -> Column:
        return (F.greatest(n_transfers - self.n_free, F.lit(0)) * self.penalty).cast("double")


COLUMNS = RosterColumns()
RULES = RosterRules()
CHARGE = TransferCharge()


def player_pool(
    facts: DataFrame,
    name: str,
    position: str,
    value: str,
    club: str,
    points: str | None = None,
    steps: Sequence[str] = (),
    where: Column | None = None,
    cols: RosterColumns = COLUMNS,
) -> DataFrame:
    """Distinct pool rows with the chosen points column (true or predicted).

    ``where`` picks one week; ``steps`` keeps the week columns, for the pools of all weeks at once.
    """
    rows = facts if where is None else facts.where(where)
    picked = [
        F.col(name).alias(cols.name),
        F.col(position).alias(cols.position),
        F.col(value).alias(cols.value),
        F.col(club).alias(cols.club),
    ]
    if points is not None:
        picked.append(F.col(points).alias(cols.points))
    return rows.select(*steps, *picked).dropDuplicates()


def first_per_name(
    facts: DataFrame, keys: Sequence[str], points: str, order: Sequence[str]
) -> DataFrame:
    """One row per key: the points of its first row by ``order``."""
    first = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return facts.groupBy(*keys).agg(F.min_by(points, first).alias(points))


def _small(df: DataFrame) -> tuple[DataFrame, bool]:
    """``df`` as a broadcast side and True if its rows and bytes prove it small, else itself and False."""
    local = rows_within(df)
    return (df, False) if local is None else (F.broadcast(local), True)


def _members(rosters: DataFrame, pool: DataFrame, cols: RosterColumns) -> DataFrame:
    return rosters.select(cols.team, cols.name).join(
        pool.select(*cols.player), cols.name, "left"
    )


def team_totals(
    rosters: DataFrame,
    pool: DataFrame,
    rules: RosterRules = RULES,
    cols: RosterColumns = COLUMNS,
) -> DataFrame:
    """Members, value, points, members per position and of the fullest club, per team.

    Counting by (team, club) first keeps even a team with most of the rows spread out.
    """
    per_position = {f"n_{cols.position}_{p}": p for p in rules.positions}
    by_club = (
        _members(rosters, pool, cols)
        .groupBy(cols.team, cols.club)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(cols.value).alias("_value"),
            F.sum(cols.points).alias("_points"),
            *[F.count_if(F.col(cols.position) == p).alias(c) for c, p in per_position.items()],
        )
    )
    return by_club.groupBy(cols.team).agg(
        F.sum("_n").alias("n_players"),
        F.coalesce(F.sum("_value"), F.lit(0)).alias("total_value"),
        F.coalesce(F.sum("_points"), F.lit(0)).alias("total_points"),
        *[F.sum(c).alias(c) for c in per_position],
        F.coalesce(F.max(F.when(F.col(cols.club).isNotNull(), F.col("_n"))), F.lit(0)).alias(
            "max_club"
        ),
    )


def team_legality(
    rosters: DataFrame,
    pool: DataFrame,
    rules: RosterRules = RULES,
    cols: RosterColumns = COLUMNS,
) -> DataFrame:
    """Three partial flags and ``legal`` per team, beside the totals they rest on."""
    return _with_flags(team_totals(rosters, pool, rules, cols), rules, cols)


def _with_flags(totals: DataFrame, rules: RosterRules, cols: RosterColumns) -> DataFrame:
    counts = {p: F.col(f"n_{cols.position}_{p}") for p in rules.positions}
    positions = (F.col("n_players") == rules.size) & (
        sum(counts.values(), F.lit(0)) == rules.size
    )
    for p, (least, most) in rules.positions.items():
        positions = positions & counts[p].between(least, most)
    return totals.withColumns(
        {
            "positions_legal": positions,
            "value_legal": F.col("total_value") <= rules.max_value,
            "clubs_legal": F.col("max_club") <= rules.max_per_club,
        }
    ).withColumn(
        "legal", F.col("positions_legal") & F.col("value_legal") & F.col("clubs_legal")
    )


def full_clubs(
    rosters: DataFrame,
    pool: DataFrame,
    rules: RosterRules = RULES,
    cols: RosterColumns = COLUMNS,
) -> DataFrame:
    """(team, club) pairs with no room left."""
    return (
        _members(rosters, pool, cols)
        .where(F.col(cols.club).isNotNull())
        .groupBy(cols.team, cols.club)
        .agg(F.count(F.lit(1)).alias("n_players"))
        .where(F.col("n_players") >= rules.max_per_club)
    )


def open_clubs(
    options: DataFrame,
    rosters: DataFrame,
    pool: DataFrame,
    rules: RosterRules = RULES,
    cols: RosterColumns = COLUMNS,
) -> DataFrame:
    """Those (team, name) ``options`` whose club still has room in the team."""
    clubs = pool.select(cols.name, cols.club)
    return (
        options.select(cols.team, cols.name)
        .join(clubs, cols.name)
        .join(full_clubs(rosters, pool, rules, cols), [cols.team, cols.club], "left_anti")
        .select(cols.team, cols.name)
    )


def refresh_points(
    rosters: DataFrame, pool: DataFrame, cols: RosterColumns = COLUMNS
) -> DataFrame:
    """Rosters with the pool's points; 0 for members the pool lacks."""
    current = pool.select(cols.name, F.col(cols.points).alias("_points"))
    return (
        rosters.drop(cols.points)
        .join(current, cols.name, "left")
        .withColumn(cols.points, F.coalesce(F.col("_points"), F.lit(0)).cast("double"))
        .drop("_points")
    )


def _squads(
    rosters: DataFrame,
    pool: DataFrame,
    rules: RosterRules,
    cols: RosterColumns,
    which: Column,
) -> DataFrame:
    """One row per team of the right size and positions that satisfies ``which``.

    Holds the members and the money left. A team's rows beyond ``rules.size + 1`` are dropped
    before the shuffle: such a team is too large to be legal however many members it has. One
    shuffle by team then serves the limit, the totals and the array, whose length is bounded.
    """
    by_name = Window.partitionBy(cols.team).orderBy(cols.name)
    clubs = _member_clubs(cols)
    counted = (
        _members(rosters, pool, cols)
        .withColumn("_nth", F.row_number().over(by_name))
        .where(F.col("_nth") <= rules.size + 1)
        .groupBy(cols.team)
        .agg(
            F.count(F.lit(1)).alias("n_players"),
            F.sum(cols.value).alias("total_value"),
            *[
                F.count_if(F.col(cols.position) == p).alias(f"n_{cols.position}_{p}")
                for p in rules.positions
            ],
            F.collect_list(F.struct(*cols.player)).alias("_members"),
        )
        .withColumn(
            "max_club",
            F.coalesce(
                F.array_max(
                    F.transform(F.array_distinct(clubs), lambda c: _times_in(clubs, c))
                ),
                F.lit(0),
            ),
        )
    )
    return (
        _with_flags(counted, rules, cols)
        .where(which & F.col("positions_legal"))
        .select(
            cols.team, (F.lit(rules.max_value) - F.col("total_value")).alias("_spare"), "_members"
        )
    )


def _member_clubs(cols: RosterColumns) -> Column:
    return F.transform("_members", lambda m: m[cols.club])


def _times_in(values: Column, value: Column) -> Column:
    return F.size(F.filter(values, lambda x: x == value))


def _taken_clubs(rules: RosterRules, cols: RosterColumns) -> Column:
    """The clubs of ``_members`` without room."""
    clubs = _member_clubs(cols)
    return F.filter(
        F.array_distinct(clubs), lambda c: _times_in(clubs, c) >= rules.max_per_club
    )


def _outgoing(
    squads: DataFrame, rules: RosterRules, cols: RosterColumns, carried: Sequence[str] = ()
) -> DataFrame:
    """One row per team and member, with what a replacement has to respect.

    ``_closed`` are the clubs without room once the member has left.
    """
    return squads.select(
        cols.team,
        "_spare",
        *carried,
        F.transform("_members", lambda m: m[cols.name]).alias("_names"),
        _taken_clubs(rules, cols).alias("_taken"),
        F.explode("_members").alias("_out"),
    ).select(
        cols.team,
        *carried,
        F.col(f"_out.{cols.name}").alias("out"),
        F.col(f"_out.{cols.position}").alias("_position"),
        F.col(f"_out.{cols.points}").alias("_out_points"),
        F.col(f"_out.{cols.value}").alias("_out_value"),
        F.col(f"_out.{cols.club}").alias("_out_club"),
        (F.col("_spare") + F.col(f"_out.{cols.value}")).alias("_budget"),
        "_names",
        "_taken",
        F.filter("_taken", lambda c: ~c.eqNullSafe(F.col(f"_out.{cols.club}"))).alias("_closed"),
    )


def _finder(pool: DataFrame, rules: RosterRules, cols: RosterColumns, cheapest: bool = False) -> Finder:
    """Searches ``pool`` for replacements in legal teams, also of players who left them.

    With ``cheapest`` the points of a player are what he does not cost.
    """
    points = -F.col(cols.value) if cheapest else F.col(cols.points)
    players = pool.select(
        F.col(cols.name).alias("name"),
        F.col(cols.position).alias("position"),
        F.col(cols.value).alias("value"),
        F.col(cols.club).alias("club"),
        points.alias("points"),
    )
    per_club = max(rules.max_per_club, 1)
    return Finder(players, Bounds(2 * rules.size, 2 * per_club, rules.size // per_club))


def _read_once(pool: DataFrame, finder: Finder, cols: RosterColumns) -> DataFrame:
    """``pool`` as rows at hand where the finder has proven it small."""
    if finder.local is None:
        return pool
    held = pool.sparkSession.createDataFrame(finder.local, schema=finder.pool.schema)
    return F.broadcast(held.select(*(F.col(c).alias(n) for c, n in zip(PLAYER, cols.player, strict=True))))


def _entering(cols: RosterColumns, points: Column | None = None) -> Column:
    """The player ``_in`` as a member of a squad."""
    names = dict(zip(PLAYER, (cols.name, cols.position, cols.value, cols.club, cols.points), strict=True))
    return F.struct(
        *(F.col(f"_in.{c}").alias(n) if c != "points" or points is None else points.alias(n) for c, n in names.items())
    )


def _with_replacements(
    outgoing: DataFrame, pool: DataFrame, small: bool, condition: Column, cols: RosterColumns
) -> DataFrame:
    """Join on position under ``condition``, the pool's columns prefixed ``_in_``.

    A pool proven ``small`` is broadcast, so teams stay where they are. A larger one is copied to
    SALTS keys per position, which spreads each position's teams over as many tasks.
    """
    entering = pool.select(*[F.col(c).alias(f"_in_{c}") for c in pool.columns])
    same_position = F.col("_position") == F.col(f"_in_{cols.position}")
    if small:
        return outgoing.join(F.broadcast(entering), same_position & condition)
    salted = outgoing.withColumn("_salt", F.pmod(F.xxhash64(cols.team, "out"), F.lit(SALTS)))
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    copied = entering.withColumn("_in_salt", F.explode(salts))
    return salted.join(
        copied, same_position & (F.col("_salt") == F.col("_in_salt")) & condition
    ).drop("_salt", "_in_salt")


def _fits(cols: RosterColumns) -> Column:
    """More points, affordable, not in the team, and a club with room once ``out`` has left.

    Players without a club always find room, as they do in the legality flags.
    """
    club = F.col(f"_in_{cols.club}")
    return (
        (F.col(f"_in_{cols.points}") > F.col("_out_points"))
        & (F.col(f"_in_{cols.value}") <= F.col("_budget"))
        & (club.isNull() | (club == F.col("_out_club")) | ~F.array_contains("_taken", club))
        & ~F.array_contains("_names", F.col(f"_in_{cols.name}"))
    )


def _listed_swaps(
    squads: DataFrame, pool: DataFrame, small: bool, rules: RosterRules, cols: RosterColumns
) -> DataFrame:
    """(team, out, in, gain) pairs of ``squads``; the conditions are part of the join."""
    players = pool.select(*cols.player)
    outgoing = _outgoing(squads, rules, cols)
    return _with_replacements(outgoing, players, small, _fits(cols), cols).select(
        cols.team,
        "out",
        F.col(f"_in_{cols.name}").alias("in"),
        (F.col(f"_in_{cols.points}") - F.col("_out_points")).alias("gain"),
    )


def swap_list(
    rosters: DataFrame,
    pool: DataFrame,
    teams: Sequence | DataFrame,
    rules: RosterRules = RULES,
    cols: RosterColumns = COLUMNS,
) -> DataFrame:
    """Every (team, out, in, gain) that leaves one of the named legal teams legal and strictly better.

    ``teams`` are names or a table with a team column.
    """
    pool, small = _small(pool)
    if isinstance(teams, DataFrame):
        named = rosters.join(teams.select(cols.team), cols.team, "left_semi")
    else:
        named = rosters.where(F.col(cols.team).isin(list(teams)))
    return _listed_swaps(_squads(named, pool, rules, cols, F.col("legal")), pool, small, rules, cols)


def swap_candidates(
    rosters: DataFrame,
    pool: DataFrame,
    rules: RosterRules = RULES,
    cols: RosterColumns = COLUMNS,
) -> DataFrame:
    """(team, out, n_options, in, gain): how many swaps leave a legal team legal and strictly better.

    One row per member that has such a swap, with its best one (ties: the smaller ``in``). Options are
    counted without pairs (see :mod:`formline.operators.dominance`); :func:`swap_list` lists them for
    named teams. Names are unique in the pool.
    """
    finder = _finder(pool, rules, cols)
    squads = _squads(rosters, _read_once(pool, finder, cols), rules, cols, F.col("legal"))
    asked = _outgoing(squads, rules, cols).withColumnsRenamed({"_out_points": "_least", "_names": "_excluded"})
    found = finder.answers(asked.withColumn("_had", F.col("_least")), [cols.team, "out", "_had"])
    return found.select(
        cols.team, "out", "n_options", F.col("_in.name").alias("in"), (F.col("_in.points") - F.col("_had")).alias("gain")
    )


def _best_swaps(
    squads: DataFrame,
    finder: Finder,
    rules: RosterRules,
    cols: RosterColumns,
    charge: TransferCharge | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """(team, ``keys``, ``_swap``): the best swap of each squad that has one, with the entering player.

    Under a ``charge``, members of the first roster (``_first``) return without counting as a
    transfer. They are few, so each is compared inside its squad; the pool is searched for others.
    """
    wanted = [cols.team, *keys, "out", "_in"]
    carried = [*keys] if charge is None else [*keys, "_first"]
    outgoing = _outgoing(squads, rules, cols, carried).withColumn("_least", F.col("_out_points"))
    loss = F.col("_out_points") - F.col(f"_in.{cols.points}")
    if charge is None:
        asked = outgoing.withColumnRenamed("_names", "_excluded")
        found = finder.answers(asked, [cols.team, *keys, "out", "_out_points"], count=False)
        options = found.withColumn("_in", _entering(cols)).withColumn("_loss", loss)
    else:
        first = F.transform("_first", lambda m: m[cols.name])
        moved = F.size(F.array_except(F.col("_names"), first))
        leaves = (~F.array_contains(first, F.col("out"))).cast("int")
        outgoing = outgoing.withColumns({"_moved": moved, "_leaves": leaves})

        def net(joins: int) -> Column:
            after = F.col("_moved") - F.col("_leaves") + joins
            return loss + charge.of(after) - charge.of(F.col("_moved"))

        asked = outgoing.withColumn("_excluded", F.array_union("_names", first))
        told = [cols.team, *keys, "out", "_out_points", "_moved", "_leaves"]
        joining = finder.answers(asked, told, count=False).withColumn("_in", _entering(cols))
        returning = (
            outgoing.withColumn("_in", F.explode("_first"))
            .select("*", *[F.col(f"_in.{c}").alias(f"_in_{c}") for c in cols.player])
            .where((F.col("_position") == F.col(f"_in_{cols.position}")) & _fits(cols))
        )
        options = joining.select(*wanted, net(1).alias("_loss")).unionByName(
            returning.select(*wanted, net(0).alias("_loss"))
        )
    swap = F.struct(
        F.col("_loss").alias("loss"), F.col("out"), F.col(f"_in.{cols.name}").alias("in"), F.col("_in")
    )
    ranked = options.where(F.col("_loss") < 0).select(cols.team, *keys, swap.alias("_swap"))
    return ranked.groupBy(cols.team, *keys).agg(F.min("_swap").alias("_swap"))


def best_swap(
    rosters: DataFrame,
    pool: DataFrame,
    rules: RosterRules = RULES,
    cols: RosterColumns = COLUMNS,
) -> DataFrame:
    """The swap of highest gain per legal team; ties go to the smaller ``out``, then ``in``."""
    finder = _finder(pool, rules, cols)
    squads = _squads(rosters, _read_once(pool, finder, cols), rules, cols, F.col("legal"))
    return _best_swaps(squads, finder, rules, cols).select(
        cols.team,
        F.col("_swap.out").alias("out"),
        F.col("_swap.in").alias("in"),
        (-F.col("_swap.loss")).alias("gain"),
    )


def apply_swap(
    rosters: DataFrame, swaps: DataFrame, cols: RosterColumns = COLUMNS
) -> DataFrame:
    """Rosters after ``swaps`` (team, out, in): each leaving member's row names the new one."""
    moves = swaps.select(
        F.col(cols.team).alias("_team"), F.col("out").alias("_out"), F.col("in").alias("_in")
    )
    return rosters.join(
        moves,
        (F.col(cols.team) == F.col("_team")) & (F.col(cols.name) == F.col("_out")),
        "left",
    ).select(cols.team, F.coalesce("_in", cols.name).alias(cols.name))


def improve_rosters(
    rosters: DataFrame,
    pool: DataFrame,
    rules: RosterRules = RULES,
    n_steps: int | None = None,
    charge: TransferCharge | None = None,
    cols: RosterColumns = COLUMNS,
) -> DataFrame:
    """(team, name, legal, n_swaps, settled): all rosters after their best swaps, until no team has one left.

    With ``n_steps`` the climb stops after so many swaps; ``settled`` tells the teams that were found to
    have no swap left from those that were cut off, and is false for illegal teams, which are not climbed.
    Legal teams advance together; illegal ones come back as they are, flagged. With a ``charge``, a
    swap counts by its gain less what it adds to the charge for transfers since the given rosters. A
    team without a swap has arrived and leaves the loop, which ends early when none is left.
    The pool is prepared for searching once; between steps squads are checkpointed, then placed by team.
    """
    finder = _finder(pool, rules, cols)
    players = _read_once(pool, finder, cols)
    # legal and other teams are both read from here, so what rosters are made of is computed once
    rosters = cut_lineage(rosters.select(cols.team, cols.name))
    squads = _squads(rosters, players, rules, cols, F.col("legal")).withColumn("_swaps", F.lit(0))
    if charge is not None:
        squads = squads.withColumn("_first", F.col("_members"))
    start = cut_lineage(squads)
    names = F.explode(F.transform("_members", lambda m: m[cols.name])).alias(cols.name)
    flags = [F.lit(True).alias("legal"), F.col("_swaps").alias("n_swaps"), (~F.col("_changed")).alias("settled")]
    reached = _climbed(start, finder, rules, cols, n_steps, charge).select(cols.team, names, *flags)
    others = rosters.join(start.select(cols.team), cols.team, "left_anti")
    return reached.unionByName(
        others.select(
            cols.team, cols.name, F.lit(False).alias("legal"), F.lit(0).alias("n_swaps"), F.lit(False).alias("settled")
        )
    )


def _climbed(
    squads: DataFrame,
    finder: Finder,
    rules: RosterRules,
    cols: RosterColumns,
    n_steps: int | None,
    charge: TransferCharge | None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """All ``squads`` (told apart by team and ``keys``) where their best swaps lead, ``_changed`` if cut off.

    Squads without a swap leave the loop; the others are checkpointed between steps. Where the pool travels to them,
    they stay where they are from the first step to the last.
    """
    arrived = []
    if finder.small is not None:
        squads = squads.repartition(cols.team, *keys)
    for step in count(1) if n_steps is None else range(1, n_steps + 1):
        if finder.small is not None:
            squads = _moved_on(_with_best_swap(squads, finder, rules, cols, charge), cols)
        else:
            squads = _advance(squads, _best_swaps(squads, finder, rules, cols, charge, keys), cols, keys)
        if step == n_steps:
            arrived.append(squads)
            break
        squads = cut_lineage(squads)
        arrived.append(squads.where(~F.col("_changed")))
        squads = squads.where("_changed").drop("_changed")
        if squads.isEmpty():
            break
        if finder.small is None:
            squads = squads.repartition(cols.team, *keys)
    return union_all(arrived or [squads.withColumn("_changed", F.lit(True))])


def _with_best_swap(
    squads: DataFrame, finder: Finder, rules: RosterRules, cols: RosterColumns, charge: TransferCharge | None
) -> DataFrame:
    """``squads`` with their best swap as ``_swap``, as :func:`_best_swaps` finds it, for pools that travel.

    All members of a squad are asked for at once, in its own row, so nothing is joined, shuffled or sorted.
    """
    carried = squads.columns
    names = F.transform("_members", lambda m: m[cols.name])
    ready = squads.withColumns({"_names": names, "_taken": _taken_clubs(rules, cols)})
    excluded = F.col("_names")
    if charge is not None:
        ready = ready.withColumn("_firsts", F.transform("_first", lambda m: m[cols.name]))
        excluded = F.array_union("_names", "_firsts")
    questions = F.transform(
        "_members",
        lambda m: F.struct(
            m[cols.position].alias("_position"),
            m[cols.points].alias("_least"),
            (F.col("_spare") + m[cols.value]).alias("_budget"),
            F.filter("_taken", lambda c: ~c.eqNullSafe(m[cols.club])).alias("_closed"),
        ),
    )
    found = finder.answers_beside(ready.withColumns({"_asked": questions, "_excluded": excluded}), "_asked", "_excluded", "_found")

    def swap(out: Column, into: Column, points: Sequence[str], extra: Column | None = None) -> Column:
        loss = out[cols.points] - into[points[4]]
        entering = F.struct(*(into[c].alias(n) for c, n in zip(points, cols.player, strict=True)))
        loss = loss if extra is None else loss + extra
        return F.struct(loss.alias("loss"), out[cols.name].alias("out"), into[points[0]].alias("in"), entering.alias("_in"))

    def paid(out: Column, joins: int) -> Column | None:
        if charge is None:
            return None
        after = F.col("_moved") - (~F.array_contains("_firsts", out[cols.name])).cast("int") + joins
        return charge.of(after) - charge.of(F.col("_moved"))

    if charge is not None:
        found = found.withColumn("_moved", F.size(F.array_except("_names", "_firsts")))
    pairs = F.filter(F.arrays_zip(F.col("_members").alias("out"), F.col("_found").alias("into")), lambda x: x["into"].isNotNull())
    options = F.transform(pairs, lambda x: swap(x["out"], x["into"], PLAYER, paid(x["out"], 1)))
    if charge is not None:
        gone = F.filter("_first", lambda f: ~F.array_contains("_names", f[cols.name]))
        returning = F.transform(
            gone,
            lambda f: F.transform(
                F.filter("_members", lambda m: _may_return(f, m, cols)), lambda m: swap(m, f, cols.player, paid(m, 0))
            ),
        )
        options = F.concat(options, F.flatten(returning))
    better = F.filter(options, lambda o: o["loss"] < 0)
    # a team without a name is never joined with anything
    return found.withColumn("_swap", F.when(F.col(cols.team).isNotNull(), F.array_min(better))).select(*carried, "_swap")


def _may_return(first: Column, out: Column, cols: RosterColumns) -> Column:
    """Whether a member of the first roster, who is not in the squad, may replace ``out`` and has more points."""
    club = first[cols.club]
    return (
        (first[cols.position] == out[cols.position])
        & (first[cols.points] > out[cols.points])
        & (first[cols.value] <= F.col("_spare") + out[cols.value])
        & (club.isNull() | (club == out[cols.club]) | ~F.array_contains("_taken", club))
    )


def _advance(squads: DataFrame, swaps: DataFrame, cols: RosterColumns, keys: Sequence[str] = ()) -> DataFrame:
    """Squads after their swap, with whether there was one."""
    return _moved_on(squads.join(swaps, [cols.team, *keys], "left"), cols)


def _moved_on(squads: DataFrame, cols: RosterColumns) -> DataFrame:
    """Squads after the swap in ``_swap``, if there is one."""
    leaving, entering = F.col("_swap.out"), F.col("_swap._in")
    changed = F.col("_swap").isNotNull()
    given_up = F.element_at(
        F.filter("_members", lambda m: m[cols.name] == leaving), 1
    ).getField(cols.value)
    replaced = F.transform(
        "_members", lambda m: F.when(m[cols.name] == leaving, entering).otherwise(m)
    )
    return squads.withColumns(
        {
            "_spare": F.when(
                changed, F.col("_spare") + given_up - entering[cols.value]
            ).otherwise(F.col("_spare")),
            "_members": F.when(changed, replaced).otherwise(F.col("_members")),
            "_swaps": F.col("_swaps") + changed.cast("int"),
            "_changed": changed,
        }
    ).drop("_swap")


def restarted_rosters(
    rosters: DataFrame,
    pool: DataFrame,
    rules: RosterRules = RULES,
    n_restarts: int = 10,
    n_kicks: int = 2,
    seed: int = 7,
    charge: TransferCharge | None = None,
    cols: RosterColumns = COLUMNS,
) -> DataFrame:
    """(team, name, start, n_swaps, net_points): where each legal team's best of several climbs leads.

    Start 0 is the team as it is. For the others ``n_kicks`` members, those of the smallest md5 of
    ``seed:start:name``, leave one after the other for the best players who can replace them (in
    points, ties: the smaller name) and were never in the team, better or not; without such a player the
    member stays. All starts climb together until none has a swap left, kicks counting as swaps and, under a
    ``charge``, as transfers. The start that ends with most points net of the charge is kept, of
    equal ones the first, so no team ends below its plain climb.
    Where the pool travels, a team's starts climb inside one task and only their best end leaves it.
    """
    keys = ["_start"]
    finder = _finder(pool, rules, cols)
    players = _read_once(pool, finder, cols)
    legal = _squads(rosters, players, rules, cols, F.col("legal"))
    if finder.local is not None and rows_tell_players(finder.local) and rosters.schema[cols.name].dataType == pool.schema[cols.name].dataType:
        climb = Climb(n_restarts, n_kicks, seed, rules.max_per_club, None if charge is None else (charge.n_free, charge.penalty))
        names = F.transform("_members", lambda m: m[cols.name])
        squads = legal.select(F.col(cols.team).alias("team"), F.col("_spare").alias("spare"), names.alias("names"))
        told = StructType(
            [squads.schema["team"], squads.schema["names"]]
            + [StructField("start", IntegerType()), StructField("swaps", IntegerType()), StructField("net", DoubleType())]
        )
        ends = squads.mapInArrow(ends_of(finder.small, finder.key, finder.bounds, climb), told)
        return ends.select(
            F.col("team").alias(cols.team),
            F.explode("names").alias(cols.name),
            "start",
            F.col("swaps").alias("n_swaps"),
            F.col("net").alias("net_points"),
        )
    legal = legal.withColumns({"_swaps": F.lit(0), "_first": F.col("_members")})
    starts = F.explode(F.sequence(F.lit(0), F.lit(n_restarts)))
    squads = cut_lineage(legal).withColumn("_start", starts)
    kicked = squads.where("_start > 0")
    for _ in range(n_kicks):
        kicked = _kicked(kicked, finder, rules, cols, seed)
    start = squads.where("_start = 0").unionByName(kicked)
    reached = _climbed(cut_lineage(start), finder, rules, cols, None, charge, keys)
    first = F.transform("_first", lambda m: m[cols.name])
    moved = F.size(F.array_except(F.transform("_members", lambda m: m[cols.name]), first))
    points = F.aggregate("_members", F.lit(0.0), lambda a, m: a + F.coalesce(m[cols.points], F.lit(0)))
    net = points if charge is None else points - charge.of(moved)
    best = F.max_by(F.struct("_members", "_start", "_swaps", "_net"), F.struct(F.col("_net"), -F.col("_start")))
    kept = reached.withColumn("_net", net).groupBy(cols.team).agg(best.alias("_best")).select(cols.team, "_best.*")
    return kept.select(
        cols.team,
        F.explode(F.transform("_members", lambda m: m[cols.name])).alias(cols.name),
        F.col("_start").alias("start"),
        F.col("_swaps").alias("n_swaps"),
        F.col("_net").alias("net_points"),
    )


def _kicked(squads: DataFrame, finder: Finder, rules: RosterRules, cols: RosterColumns, seed: int) -> DataFrame:
    """Squads after one member of the first roster, picked by md5, was replaced."""
    keys = ["_start"]
    first = F.transform("_first", lambda m: m[cols.name])
    names = F.transform("_members", lambda m: m[cols.name])
    luck = F.transform(
        F.array_intersect(names, first),
        lambda n: F.struct(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_start"), n).cast("binary")).alias("m"), n.alias("n")),
    )
    if finder.small is not None:
        carried = squads.columns
        ready = squads.withColumns({"_pick": F.array_min(luck)["n"], "_taken": _taken_clubs(rules, cols), "_excluded": F.array_union(names, first)})
        ready = ready.withColumn("_out", F.get(F.filter("_members", lambda m: m[cols.name] == F.col("_pick")), F.lit(0)))
        question = F.struct(
            F.col(f"_out.{cols.position}").alias("_position"),
            (F.col("_spare") + F.col(f"_out.{cols.value}")).alias("_budget"),
            F.filter("_taken", lambda c: ~c.eqNullSafe(F.col(f"_out.{cols.club}"))).alias("_closed"),
        )
        found = finder.answers_beside(ready.withColumn("_asked", F.array(question)), "_asked", "_excluded", "_found")
        found = found.withColumn("_in", F.col("_found")[0])
        swap = F.struct(F.col("_pick").alias("out"), F.col("_in.name").alias("in"), _entering(cols).alias("_in"))
        known = F.col("_in").isNotNull() & F.col(cols.team).isNotNull()
        return _moved_on(found.select(*carried, F.when(known, swap).alias("_swap")), cols).drop("_changed")
    outgoing = _outgoing(squads.withColumn("_pick", F.array_min(luck)["n"]), rules, cols, [*keys, "_first", "_pick"])
    asked = outgoing.where(F.col("out") == F.col("_pick")).withColumn("_excluded", F.array_union("_names", first))
    found = finder.answers(asked, [cols.team, *keys, "out"], count=False)
    swap = F.struct(F.col("out"), F.col("_in.name").alias("in"), _entering(cols).alias("_in"))
    return _advance(squads, found.select(cols.team, *keys, swap.alias("_swap")), cols, keys).drop("_changed")


def repair_rosters(
    rosters: DataFrame,
    pool: DataFrame,
    rules: RosterRules = RULES,
    cols: RosterColumns = COLUMNS,
) -> DataFrame:
    """(team, name, n_swaps, repaired): teams whose only fault is their value, brought within the budget.

    In turn a team makes the swap that brings it within the budget with most points (ties: the smaller
    ``out``, then ``in``) or, where no single swap does, the one that saves most. Entering players share the
    position, cost strictly less, are not in the team and come from a club with room. A team that
    gets stuck becomes the cheapest legal team with as many players per position, if the budget
    allows any: whether it does depends on these numbers only, so a team comes back unrepaired only
    if no legal team has them.
    """
    over = F.col("clubs_legal") & ~F.col("value_legal")
    best = _finder(pool, rules, cols)
    pool = _read_once(pool, best, cols)
    cheapest = _finder(pool, rules, cols, cheapest=True)
    squads = cut_lineage(_squads(rosters, pool, rules, cols, over).withColumn("_swaps", F.lit(0)))
    done = []
    while not squads.isEmpty():
        # a changed squad goes on unless it is within the budget, an unchanged one is stuck
        squads = cut_lineage(_advance(squads, _saving_swaps(squads, best, cheapest, pool, rules, cols), cols))
        arrived = (F.col("_spare") >= 0) | ~F.col("_changed")
        done.append(squads.where(arrived))
        squads = squads.where(~arrived).drop("_changed")
    if not done:
        done = [squads.withColumn("_changed", F.lit(False))]
    ended = union_all(done)
    names = F.explode(F.transform("_members", lambda m: m[cols.name])).alias(cols.name)
    within = ended.where("_spare >= 0").select(cols.team, names, F.col("_swaps").alias("n_swaps"), F.lit(True).alias("repaired"))
    stuck = ended.where("_spare < 0")
    return within.unionByName(_rebuilt(stuck, pool, rules, cols))


def _saving_swaps(
    squads: DataFrame, best: Finder, cheapest: Finder, pool: DataFrame, rules: RosterRules, cols: RosterColumns
) -> DataFrame:
    """(team, ``_swap``): what brings a squad within the budget with most points, else what saves most."""
    outgoing = _outgoing(squads, rules, cols).withColumnRenamed("_names", "_excluded")
    told = [cols.team, "out", "_out_points", "_out_value"]

    def counted(points: Column) -> Column:
        return F.coalesce(points, F.lit(0))

    fixing = best.answers(outgoing, told, count=False).select(
        cols.team, F.lit(0).alias("step"), (counted(F.col("_out_points")) - counted(F.col("_in.points"))).cast("double").alias("loss"),
        "out", F.col("_in.name").alias("in"), _entering(cols).alias("_in"),
    )
    below = outgoing.withColumn("_budget", F.col("_out_value"))
    cut = cheapest.answers(below, told, strict=True, count=False)
    # the search for the cheapest stands in for points, which come from the pool
    saved = cut.select(
        cols.team, F.lit(1).alias("step"), (F.col("_in.value") - F.col("_out_value")).cast("double").alias("loss"),
        "out", F.col("_in.name").alias("in"),
    ).groupBy(cols.team).agg(F.min(F.struct("step", "loss", "out", "in")).alias("_least")).select(cols.team, "_least.*")
    entering = pool.select(F.col(cols.name).alias("in"), F.struct(*cols.player).alias("_in"))
    saving = saved.join(entering, "in").select(*fixing.columns)
    swap = F.struct("step", "loss", "out", "in", "_in")
    return fixing.unionByName(saving).groupBy(cols.team).agg(F.min(swap).alias("_swap"))


def _rebuilt(stuck: DataFrame, pool: DataFrame, rules: RosterRules, cols: RosterColumns) -> DataFrame:
    """The stuck teams as the cheapest legal team of their numbers per position, or as they are."""
    counts = F.transform(
        F.array([F.lit(p) for p in rules.positions]),
        lambda p: F.size(F.filter("_members", lambda m: m[cols.position] == p)),
    )
    names = F.transform("_members", lambda m: m[cols.name])
    kept = cut_lineage(stuck.select(cols.team, names.alias("_names"), "_swaps", counts.alias("_counts")))
    # at most as many patterns as ways to share ``size`` among the positions, whatever the teams
    patterns = [r["_counts"] for r in kept.select("_counts").distinct().collect()]
    found = []
    if patterns:
        cheap = _cheap_players(pool, rules, cols)
        for pattern in patterns:
            team = cheapest_team(dict(zip(rules.positions, pattern, strict=True)), cheap, rules)
            if team is not None and sum(v for v, _, _ in team) <= rules.max_value:
                found.append((pattern, [n for _, n, _ in team]))
    name_type = pool.schema[cols.name].dataType.simpleString()
    rebuilt = kept.sparkSession.createDataFrame(found, f"_counts array<int>, _team array<{name_type}>")
    whole = kept.join(F.broadcast(rebuilt), "_counts", "left")
    return whole.select(
        cols.team,
        F.explode(F.coalesce("_team", "_names")).alias(cols.name),
        F.when(F.col("_team").isNull(), F.col("_swaps")).otherwise(F.size(F.array_except("_team", "_names")) + F.col("_swaps")).alias("n_swaps"),
        F.col("_team").isNotNull().alias("repaired"),
    )


def _cheap_players(pool: DataFrame, rules: RosterRules, cols: RosterColumns) -> dict[int, list[tuple]]:
    """Per position the (value, name, club) that a cheapest legal team can be made of, cheapest first.

    A club serves at most ``max_per_club`` of its cheapest per position. A place can be filled by any of
    the cheapest players that are neither in the team nor of a full club, so the first
    ``size + size // max_per_club * max_per_club + 1`` of those suffice.
    """
    each = max(rules.max_per_club, 1)
    order = [F.col(cols.value), F.col(cols.name)]
    of_club = Window.partitionBy(cols.position, F.coalesce(F.col(cols.club).cast("string"), F.col(cols.name).cast("string"))).orderBy(*order)
    at = Window.partitionBy(cols.position).orderBy(*order)
    most = rules.size + rules.size // each * each + 1
    rows = (
        pool.where(F.col(cols.value).isNotNull() & F.col(cols.position).isin(list(rules.positions)))
        .withColumn("_nth", F.row_number().over(of_club))
        .where(F.col("_nth") <= each)
        .withColumn("_nth", F.row_number().over(at))
        .where(F.col("_nth") <= most)
        .select(F.col(cols.position).alias("p"), F.col(cols.value).alias("v"), F.col(cols.name).alias("n"), F.col(cols.club).alias("c"))
        .collect()
    )
    ordered = sorted(rows, key=lambda r: (r["p"], r["v"], r["n"]))
    return {p: [(r["v"], r["n"], r["c"]) for r in part] for p, part in groupby(ordered, key=lambda r: r["p"])}


def cheapest_team(counts: Mapping[int, int], players: Mapping[int, list[tuple]], rules: RosterRules) -> list[tuple] | None:
    """The cheapest (value, name, club) rows with ``counts`` per position and no club above its limit.

    Places are filled one after the other; a branch ends where the cheapest players left, clubs aside,
    would already cost as much as the best team found.
    """
    places = [p for p, n in counts.items() for _ in range(n)]
    if any(len(players.get(p, [])) < n for p, n in counts.items()):
        return None
    best: list = [float("inf"), None]
    used: dict = {}
    chosen: list[tuple] = []

    def least(k: int, after: int) -> float:
        """What the places from ``k`` on cost at least; those of the same position come after ``after``."""
        total, i = 0, k
        while i < len(places):
            n = sum(1 for p in places[i:] if p == places[i])
            start = after if i == k else 0
            part = players[places[i]][start : start + n]
            if len(part) < n:
                return float("inf")
            total += sum(v for v, _, _ in part)
            i += n
        return total

    def fill(k: int, after: int, cost: float) -> None:
        if k == len(places):
            best[:] = [cost, list(chosen)]
            return
        start = after if k and places[k] == places[k - 1] else 0
        for i in range(start, len(players[places[k]])):
            if cost + least(k, i) >= best[0]:
                return
            value, name, club = players[places[k]][i]
            if club is not None and used.get(club, 0) >= rules.max_per_club:
                continue
            chosen.append((value, name, club))
            used[club] = used.get(club, 0) + 1
            fill(k + 1, i + 1, cost + value)
            used[club] -= 1
            chosen.pop()

    fill(0, 0, 0)
    return best[1]


def transfer_cost(
    before: DataFrame,
    after: DataFrame,
    pool: DataFrame,
    charge: TransferCharge = CHARGE,
    cols: RosterColumns = COLUMNS,
) -> DataFrame:
    """Transfers, penalty and points net of it, per team of ``after``.

    A transfer is a member of ``after`` that ``before`` lacks. Both rosters are stacked and
    counted by (team, name), then by team: no join between them.
    """
    stacked = before.select(cols.team, cols.name, F.lit(0).alias("_after")).unionAll(
        after.select(cols.team, cols.name, F.lit(1).alias("_after"))
    )
    moves = (
        stacked.groupBy(cols.team, cols.name)
        .agg(F.min("_after").alias("_new"), F.max("_after").alias("_after"))
        .where(F.col("_after") == 1)
        .join(pool.select(cols.name, cols.points), cols.name, "left")
    )
    return (
        moves.groupBy(cols.team)
        .agg(
            F.sum("_new").alias("n_transfers"),
            F.coalesce(F.sum(cols.points), F.lit(0)).cast("double").alias("total_points"),
        )
        .withColumn("penalty", charge.of(F.col("n_transfers")))
        .withColumn("net_points", F.col("total_points") - F.col("penalty"))
    )


def weekly_reward(
    rosters: DataFrame,
    facts: DataFrame,
    step: str,
    order: Sequence[str] = (),
    mode: str = "first",
    cols: RosterColumns = COLUMNS,
) -> DataFrame:
    """Reward per team and step, and its running total over the season.

    ``facts`` holds (name, ``step``, points); a member without a row earns 0. Of several rows in
    a step only the first by ``order`` counts, or all with ``mode="sum"``. Rosters with a ``step``
    column apply to that step, others to every step from 1 to the last.
    """
    if mode == "first":
        if not order:
            raise ValueError("a name may have two rows in a step: give their order")
        earned = first_per_name(facts, [cols.name, step], cols.points, order)
    elif mode == "sum":
        earned = facts.groupBy(cols.name, step).agg(F.sum(cols.points).alias(cols.points))
    else:
        raise ValueError(f"mode must be 'first' or 'sum', not {mode!r}")
    # one row per name and step: read from here, the facts are aggregated once
    earned = cut_lineage(earned)
    if step in rosters.columns:
        members = rosters.select(cols.team, cols.name, step)
        ledger = (
            members.join(earned, [cols.name, step], "left")
            .groupBy(cols.team, step)
            .agg(F.coalesce(F.sum(F.col(cols.points).cast("double")), F.lit(0.0)).alias("reward"))
        )
    else:
        last = max(earned.agg(F.max(step)).first()[0] or 0, 0)
        return _every_step(rosters.select(cols.team, cols.name), earned, step, last, facts.schema[step].dataType, cols)
    season = Window.partitionBy(cols.team).orderBy(step)
    return ledger.withColumn(
        "running_total",
        F.sum("reward").over(season.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    )


def _every_step(members: DataFrame, earned: DataFrame, step: str, last: int, kind: DataType, cols: RosterColumns) -> DataFrame:
    """The ledger of rosters that hold in every step from 1 to ``last``, and in those before that have a row.

    Points travel as blocks of STEP_BLOCK steps in a row, so a member costs its points and little else; steps come apart
    only when a team's sums and running totals are known, and no row per step is shuffled or sorted.
    """
    at = F.col(step).cast("bigint") - 1
    blocks = F.sequence(F.lit(0), F.lit((last - 1) // STEP_BLOCK)).cast("array<bigint>") if last else F.array().cast("array<bigint>")
    slots = [f"_{j}" for j in range(STEP_BLOCK)]
    known = earned.where(F.col(step).isNotNull())
    placed = known.select(
        cols.name, F.floor(at / STEP_BLOCK).alias("_block"), F.pmod(at, F.lit(STEP_BLOCK)).alias("_slot"),
        F.coalesce(F.col(cols.points).cast("double"), F.lit(0.0)).alias("_points"),
    )
    # every name has every block, also those without points
    empty = known.select(cols.name).distinct().select(cols.name, F.explode(blocks).alias("_block"))
    spread = (
        placed.unionByName(empty, allowMissingColumns=True)
        .groupBy(cols.name, "_block")
        .agg(*[F.max(F.when(F.col("_slot") == j, F.col("_points"))).alias(c) for j, c in enumerate(slots)])
    )
    found = members.join(spread, cols.name, "left")
    unknown = F.when(F.col("_block").isNull(), blocks).otherwise(F.array("_block"))
    sums = (
        found.select(cols.team, F.explode(unknown).alias("_block"), *slots)
        .groupBy(cols.team, "_block")
        .agg(*[F.sum(c).alias(c) for c in slots])
    )
    season = Window.partitionBy(cols.team).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in slots[1:]), F.coalesce(F.col(slots[0]), F.lit(0.0)))
    before = F.coalesce(F.sum(whole).over(season), F.lit(0.0))
    rows, total = [], F.col("_before")
    for j, c in enumerate(slots):
        number = F.col("_block") * STEP_BLOCK + j + 1
        reward = F.coalesce(F.col(c), F.lit(0.0))
        total = total + reward
        listed = F.col(c).isNotNull() | number.between(1, last)
        rows.append(F.struct(listed.alias("_listed"), number.cast(kind).alias(step), reward.alias("reward"), total.alias("running_total")))
    told = sums.withColumn("_before", before).select(cols.team, F.inline(F.array(*rows)))
    return told.where("_listed").drop("_listed")


def cheaper_options(
    rosters: DataFrame,
    pool: DataFrame,
    rules: RosterRules = RULES,
    cols: RosterColumns = COLUMNS,
) -> DataFrame:
    """(team, out, n_options, in): for teams whose only fault is their value.

    ``out`` is the dearest member (of equally dear ones the smallest name); replacements share its
    position, cost strictly less, are not in the team and come from a club with room. They are
    counted, and ``in`` is the one of most points (ties: the smaller name).
    """
    over = F.col("clubs_legal") & ~F.col("value_legal")
    finder = _finder(pool, rules, cols)
    squads = _squads(rosters, _read_once(pool, finder, cols), rules, cols, over)
    dearest = F.array_min(
        F.transform(
            "_members",
            lambda m: F.struct(
                (-m[cols.value]).alias("cost"),
                m[cols.name].alias("name"),
                m[cols.position].alias("position"),
            ),
        )
    )
    outgoing = squads.select(
        cols.team,
        F.transform("_members", lambda m: m[cols.name]).alias("_names"),
        _taken_clubs(rules, cols).alias("_taken"),
        dearest.alias("_out"),
    ).select(
        cols.team,
        F.col("_out.name").alias("out"),
        F.col("_out.position").alias("_position"),
        (-F.col("_out.cost")).alias("_cost"),
        "_names",
        "_taken",
    )
    asked = outgoing.withColumnsRenamed({"_cost": "_budget", "_taken": "_closed", "_names": "_excluded"})
    found = finder.answers(asked, [cols.team, "out"], strict=True)
    return found.select(cols.team, "out", "n_options", F.col("_in.name").alias("in"))
