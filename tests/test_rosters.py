import hashlib
import itertools
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from formline.operators import climbs
from formline.operators import dominance as D
from formline.operators import rosters as R
from formline.plans import proxies as P
from formline.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

PLAYER = "name string, position int, value double, club string, points double"


def legal_team():
    """Two keepers, five defenders, five midfielders, three forwards, each of a club of their own."""
    positions = [1] * 2 + [2] * 5 + [3] * 5 + [4] * 3
    return [(f"p{i}", p, 5.0, f"club{i}", 1.0) for i, p in enumerate(positions)]


def variants():
    team = legal_team()
    by_club = [(n, p, v, "club0" if i < 4 else c, s) for i, (n, p, v, c, s) in enumerate(team)]
    costly = [(team[0][0], 1, 1000.0, "club0", 1.0), *team[1:]]
    wrong = [(team[0][0], 4, 5.0, "club0", 1.0), *team[1:]]
    return {
        "legal": team,
        "short": team[:-1],
        "long": [*team, ("extra", 4, 5.0, "x", 1.0)],
        "by_club": by_club,
        "costly": costly,
        "wrong": wrong,
    }


def frames(spark, teams):
    rosters, pool = [], {}
    for t, members in teams.items():
        for n, *rest in members:
            rosters.append((t, f"{t}:{n}"))
            pool[f"{t}:{n}"] = (f"{t}:{n}", *rest)
    return (
        spark.createDataFrame(rosters, "team string, name string"),
        spark.createDataFrame(list(pool.values()), PLAYER),
    )


def test_legality_names_the_broken_rule(spark):
    got = {
        r["team"]: (r["positions_legal"], r["value_legal"], r["clubs_legal"], r["legal"])
        for r in R.team_legality(*frames(spark, variants())).collect()
    }
    assert got == {
        "legal": (True, True, True, True),
        "short": (False, True, True, False),
        "long": (False, True, True, False),
        "by_club": (True, True, False, False),
        "costly": (True, False, True, False),
        "wrong": (False, True, True, False),
    }


def test_totals(spark):
    row = {r["team"]: r for r in R.team_totals(*frames(spark, variants())).collect()}
    assert row["legal"]["n_players"] == 15 and row["legal"]["total_value"] == 75.0
    assert [row["legal"][f"n_position_{p}"] for p in (1, 2, 3, 4)] == [2, 5, 5, 3]
    assert row["by_club"]["max_club"] == 4 and row["costly"]["total_value"] == 1070.0


def test_a_member_unknown_to_the_pool_makes_a_team_illegal(spark):
    rosters, pool = frames(spark, {"t": legal_team()})
    got = R.team_legality(rosters, pool.where("name <> 't:p3'")).first()
    assert got["n_players"] == 15 and not got["legal"]


RULES = R.RosterRules(
    positions={1: (1, 1), 2: (0, 3), 3: (0, 3)}, size=5, max_value=30, max_per_club=2
)


def is_legal(members):
    at = Counter(m[1] for m in members)
    clubs = Counter(m[3] for m in members)
    return (
        len(members) == 5
        and all(lo <= at[p] <= hi for p, (lo, hi) in RULES.positions.items())
        and sum(m[2] for m in members) <= 30
        and max(clubs.values()) <= 2
    )


def small_league(seed):
    rng = random.Random(seed)
    pool = [
        (f"p{i:02d}", rng.randint(1, 3), float(rng.randint(1, 12)), rng.choice("ABCD"),
         float(rng.randint(0, 6)))
        for i in range(40)
    ]
    teams = {f"t{k}": rng.sample(pool, 5) for k in range(300)}
    return pool, teams


def brute_candidates(pool, teams):
    found = set()
    for t, members in teams.items():
        if not is_legal(members):
            continue
        names = {m[0] for m in members}
        for out in members:
            for new in pool:
                if new[0] in names or new[1] != out[1] or new[4] <= out[4]:
                    continue
                if is_legal([m for m in members if m != out] + [new]):
                    found.add((t, out[0], new[0], new[4] - out[4]))
    return found


def brute_best(candidates):
    best = {}
    for t, out, new, gain in candidates:
        rank = (-gain, out, new)
        if t not in best or rank < best[t]:
            best[t] = rank
    return {(t, out, new, -loss) for t, (loss, out, new) in best.items()}


def per_member(candidates):
    """(team, out, number of options, best in, gain)."""
    options = {}
    for t, out, new, gain in candidates:
        options.setdefault((t, out), []).append((-gain, new))
    return {(t, out, len(o), min(o)[1], -min(o)[0]) for (t, out), o in options.items()}


def league_frames(spark, pool, teams):
    return (
        spark.createDataFrame([(t, m[0]) for t, ms in teams.items() for m in ms],
                              "team string, name string"),
        spark.createDataFrame(pool, PLAYER),
    )


@pytest.fixture(params=["broadcast", "salted"])
def pool_side(request, monkeypatch):
    if request.param == "salted":
        monkeypatch.setattr(R, "_small", lambda df: (df, False))
        monkeypatch.setattr(R, "SALTS", 3)
        monkeypatch.setattr(D, "table_within", lambda df: None)
        monkeypatch.setattr(D, "BLOCK_ROWS", 7)
    return request.param


@pytest.mark.parametrize("seed", [1, 2])
def test_swaps_equal_brute_force(spark, pool_side, seed):
    pool, teams = small_league(seed)
    assert sum(is_legal(m) for m in teams.values()) > 10
    want = brute_candidates(pool, teams)
    args = (*league_frames(spark, pool, teams), RULES)
    listed = [tuple(r) for r in R.swap_list(*args[:2], list(teams), RULES).collect()]
    assert len(listed) == len(set(listed)) and set(listed) == want
    assert {tuple(r) for r in R.swap_candidates(*args).collect()} == per_member(want)
    assert {tuple(r) for r in R.best_swap(*args).collect()} == brute_best(want)


def test_improving_climbs_until_no_swap_is_left(spark, pool_side):
    pool, teams = small_league(3)
    state = {t: m for t, m in teams.items() if is_legal(m)}
    by_name = {p[0]: p for p in pool}
    while swaps := brute_best(brute_candidates(pool, state)):
        for t, out, new, _ in swaps:
            state[t] = [m for m in state[t] if m[0] != out] + [by_name[new]]
    got = R.improve_rosters(*league_frames(spark, pool, teams), RULES, n_steps=50)
    found, flags = {}, {}
    for r in got.collect():
        found.setdefault(r["team"], set()).add(r["name"])
        flags.setdefault(r["team"], set()).add((r["legal"], r["n_swaps"] > 0))
    assert found == {t: {m[0] for m in ms} for t, ms in ({**teams, **state}).items()}
    changed = {t for t, ms in state.items() if {m[0] for m in ms} != {m[0] for m in teams[t]}}
    assert all(f == {(t in state, t in changed)} for t, f in flags.items() if t in changed or t not in state)


@pytest.mark.parametrize("n_free, penalty", [(0, 1.0), (1, 2.0), (2, 3.0)])
def test_improving_pays_for_transfers(spark, n_free, penalty):
    pool, teams = small_league(7)
    first = {t: m for t, m in teams.items() if is_legal(m)}
    names = {t: {m[0] for m in ms} for t, ms in first.items()}
    state, by_name = dict(first), {p[0]: p for p in pool}

    def paid(t, members):
        return penalty * max(len({m[0] for m in members} - names[t]) - n_free, 0)

    while True:
        best = {}
        for t, out, new, gain in brute_candidates(pool, state):
            after = [m for m in state[t] if m[0] != out] + [by_name[new]]
            net = gain - paid(t, after) + paid(t, state[t])
            if net > 0 and (t not in best or (-net, out, new) < best[t]):
                best[t] = (-net, out, new)
        if not best:
            break
        for t, (_, out, new) in best.items():
            state[t] = [m for m in state[t] if m[0] != out] + [by_name[new]]
    got = R.improve_rosters(
        *league_frames(spark, pool, teams), RULES, 50, R.TransferCharge(n_free, penalty)
    )
    found, flags = {}, {}
    for r in got.collect():
        found.setdefault(r["team"], set()).add(r["name"])
        flags.setdefault(r["team"], set()).add((r["legal"], r["n_swaps"] > 0))
    assert found == {t: {m[0] for m in ms} for t, ms in ({**teams, **state}).items()}
    changed = {t for t, ms in state.items() if {m[0] for m in ms} != {m[0] for m in teams[t]}}
    assert all(f == {(t in state, t in changed)} for t, f in flags.items() if t in changed or t not in state)


def test_climbing_ends_only_when_all_legal_teams_have_settled(spark):
    args = (*league_frames(spark, *small_league(3)), RULES)
    flags = ("team", "legal", "n_swaps", "settled")
    short = {r["team"]: r for r in R.improve_rosters(*args, n_steps=2).select(*flags).collect()}
    whole = {r["team"]: r for r in R.improve_rosters(*args).select(*flags).collect()}
    assert max(r["n_swaps"] for r in whole.values()) > 2
    assert all(r["settled"] == r["legal"] for r in whole.values())
    # a team cut off after its second swap is not said to have settled
    assert {t for t, r in short.items() if r["settled"]} == {t for t, r in whole.items() if r["legal"] and r["n_swaps"] < 2}


def test_registered_climbs_leave_no_swap(spark):
    teams, pool, rules = P.rosters(spark, SF_DIR), P.supplier_pool(spark, SF_DIR), P.ROSTER_RULES
    got = QUERIES["settled_rosters"](spark, SF_DIR)
    assert got.where("legal <> settled").count() == 0
    assert R.best_swap(got.select("team", "name"), pool, rules).count() == 0
    assert got.count() == teams.count()
    assert QUERIES["settled_with_transfers"](spark, SF_DIR).where("legal <> settled").count() == 0


def test_applying_a_swap_leaves_other_teams_alone(spark, rows):
    rosters = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "team string, name string")
    swaps = spark.createDataFrame([("a", "x", "z")], "team string, out string, in string")
    assert rows(R.apply_swap(rosters, swaps)) == [("a", "y"), ("a", "z"), ("b", "x")]


def test_cheaper_options_for_teams_over_budget(spark, pool_side):
    pool, teams = small_league(4)
    want = set()
    for t, members in teams.items():
        at, clubs = Counter(m[1] for m in members), Counter(m[3] for m in members)
        rest = all(lo <= at[p] <= hi for p, (lo, hi) in RULES.positions.items())
        if not rest or max(clubs.values()) > 2 or sum(m[2] for m in members) <= 30:
            continue
        dear = min(members, key=lambda m: (-m[2], m[0]))
        names = {m[0] for m in members}
        want |= {
            (t, dear[0], p[0])
            for p in pool
            if p[1] == dear[1] and p[2] < dear[2] and p[0] not in names and clubs[p[3]] < 2
        }
    points = {p[0]: p[4] for p in pool}
    options = {}
    for t, out, new in want:
        options.setdefault((t, out), []).append((-points[new], new))
    best = {(t, out, len(o), min(o)[1]) for (t, out), o in options.items()}
    got = R.cheaper_options(*league_frames(spark, pool, teams), RULES)
    assert best and {tuple(r) for r in got.collect()} == best


def test_full_clubs_close(spark, rows):
    pool, teams = small_league(5)
    rosters, players = league_frames(spark, pool, teams)
    options = rosters.select("team").distinct().crossJoin(players.select("name"))
    club = {p[0]: p[3] for p in pool}
    want = {
        (t, p[0])
        for t, members in teams.items()
        for p in pool
        if Counter(m[3] for m in members)[club[p[0]]] < 2
    }
    assert {tuple(r) for r in R.open_clubs(options, rosters, players, RULES).collect()} == want


def test_refreshed_points_default_to_zero(spark, rows):
    rosters = spark.createDataFrame([("a", "x"), ("a", "y")], "team string, name string")
    pool = spark.createDataFrame([("x", 4.0)], "name string, points double")
    assert {r["name"]: r["points"] for r in R.refresh_points(rosters, pool).collect()} == {
        "x": 4.0,
        "y": 0.0,
    }


def test_transfers_beyond_the_free_one_cost_two_points(spark):
    before = spark.createDataFrame([("a", n) for n in "xyz"] + [("b", n) for n in "xy"], "team string, name string")
    after = spark.createDataFrame([("a", n) for n in "xuv"] + [("b", n) for n in "xy"], "team string, name string")
    pool = spark.createDataFrame([("x", 3.0), ("u", 1.0), ("y", 2.0)], "name string, points double")
    got = {r["team"]: tuple(r)[1:] for r in R.transfer_cost(before, after, pool).collect()}
    assert got == {"a": (2, 4.0, 2.0, 2.0), "b": (0, 5.0, 0.0, 5.0)}


FACTS = [("x", 1, 1, 2.0), ("x", 1, 2, 9.0), ("x", 3, 1, 4.0), ("y", 2, 1, 5.0)]


def ledger(df):
    return {(r["team"], r["step"]): (r["reward"], r["running_total"]) for r in df.collect()}


def test_rewards_count_the_first_fixture_and_every_week(spark):
    facts = spark.createDataFrame(FACTS, "name string, step int, fixture int, points double")
    rosters = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "q")], "team string, name string")
    assert ledger(R.weekly_reward(rosters, facts, "step", ["fixture"])) == {
        ("a", 1): (2.0, 2.0), ("a", 2): (5.0, 7.0), ("a", 3): (4.0, 11.0),
        ("b", 1): (0.0, 0.0), ("b", 2): (0.0, 0.0), ("b", 3): (0.0, 0.0),
    }
    summed = ledger(R.weekly_reward(rosters, facts, "step", mode="sum"))
    assert summed[("a", 1)] == (11.0, 11.0)
    with pytest.raises(ValueError):
        R.weekly_reward(rosters, facts, "step")


def test_rewards_of_rosters_that_change(spark):
    facts = spark.createDataFrame(FACTS, "name string, step int, fixture int, points double")
    rosters = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "x"), ("a", 3, "x"), ("a", 3, "y")],
        "team string, step int, name string",
    )
    assert ledger(R.weekly_reward(rosters, facts, "step", ["fixture"])) == {
        ("a", 1): (2.0, 2.0), ("a", 2): (0.0, 2.0), ("a", 3): (4.0, 6.0),
    }


def test_pool_of_one_week_has_each_player_once(spark, rows):
    facts = spark.createDataFrame(
        [(1, "x", 1, 5.0, "A", 2.0), (1, "x", 1, 5.0, "A", 2.0), (2, "x", 1, 6.0, "A", 3.0)],
        "week int, player string, pos int, price double, team string, pts double",
    )
    args = ("player", "pos", "price", "team")
    week = R.player_pool(facts, *args, "pts", where=facts["week"] == 1)
    assert rows(week) == [("x", 1, 5.0, "A", 2.0)]
    assert rows(R.player_pool(facts, *args)) == [("x", 1, 5.0, "A"), ("x", 1, 6.0, "A")]


def test_a_team_with_most_of_the_rows_changes_nothing_for_others(spark):
    pool, teams = small_league(6)
    legal = {t: m for t, m in teams.items() if is_legal(m)}
    huge = {**legal, "huge": pool * 50}
    want = brute_candidates(pool, legal)
    rosters, players = league_frames(spark, pool, huge)
    got = {tuple(r) for r in R.swap_candidates(rosters, players, RULES).collect()}
    assert got == per_member(want)
    assert {tuple(r) for r in R.best_swap(rosters, players, RULES).collect()} == brute_best(want)
    totals = {r["team"]: r["n_players"] for r in R.team_totals(rosters, players, RULES).collect()}
    assert totals["huge"] == 2000


@pytest.mark.parametrize("seed", [11, 12])
def test_swaps_from_a_large_pool(spark, pool_side, seed):
    rng = random.Random(seed)
    pool = [
        (f"p{i:03d}", rng.randint(1, 3), float(rng.randint(1, 20)), rng.choice("ABCDEF"), float(rng.randint(0, 60)))
        for i in range(600)
    ]
    teams = {f"t{k}": rng.sample(pool, 5) for k in range(150)}
    rosters, players = league_frames(spark, pool, teams)
    want = brute_candidates(pool, teams)
    assert {tuple(r) for r in R.best_swap(rosters, players, RULES).collect()} == brute_best(want)
    assert {tuple(r) for r in R.swap_candidates(rosters, players, RULES).collect()} == per_member(want)


def test_players_without_a_club_may_enter(spark):
    pool = [("a", 1, 1.0, None, 1.0), ("b", 2, 1.0, "A", 1.0), ("c", 3, 1.0, "A", 1.0), ("d", 2, 1.0, "B", 1.0),
            ("e", 3, 1.0, "B", 1.0), ("new", 3, 1.0, None, 9.0), ("shut", 2, 1.0, "B", 8.0)]
    teams = {"t": pool[:5]}
    got = R.swap_list(*league_frames(spark, pool, teams), ["t"], RULES).collect()
    assert {tuple(r) for r in got} == {("t", "c", "new", 8.0), ("t", "e", "new", 8.0), ("t", "d", "shut", 7.0)}
    assert tuple(R.best_swap(*league_frames(spark, pool, teams), RULES).first()) == ("t", "c", "new", 8.0)


def test_rewards_of_rosters_that_carry_points(spark):
    facts = spark.createDataFrame(FACTS, "name string, step int, fixture int, points double")
    rosters = spark.createDataFrame([("a", "x"), ("a", "y")], "team string, name string")
    plain = R.weekly_reward(rosters, facts, "step", ["fixture"])
    refreshed = R.refresh_points(rosters, facts.where("step = 1 and fixture = 1"))
    assert ledger(R.weekly_reward(refreshed, facts, "step", ["fixture"])) == ledger(plain)
    assert R.weekly_reward(rosters, facts.limit(0), "step", ["fixture"]).collect() == []


def with_points(members):
    return sum(m[4] for m in members)


def plain_climb(pool, members, first, charge):
    """(members, swaps) after the best swaps that pay."""
    by_name, swaps = {p[0]: p for p in pool}, 0

    def paid(ms):
        moved = len({m[0] for m in ms} - first)
        return charge.penalty * max(moved - charge.n_free, 0) if charge else 0

    while True:
        options = []
        for t, out, new, gain in brute_candidates(pool, {"t": members}):
            after = [m for m in members if m[0] != out] + [by_name[new]]
            net = gain - paid(after) + paid(members)
            if net > 0:
                options.append((-net, out, new))
        if not options:
            return members, swaps, with_points(members) - paid(members)
        _, out, new = min(options)
        members = [m for m in members if m[0] != out] + [by_name[new]]
        swaps += 1


def plain_kick(pool, members, first, start):
    picks = sorted((hashlib.md5(f"7:{start}:{m[0]}".encode()).hexdigest(), m[0]) for m in members if m[0] in first)
    out = next(m for m in members if m[0] == picks[0][1])
    options = []
    for new in pool:
        if new[1] == out[1] and new[0] not in {m[0] for m in members} | first:
            after = [m for m in members if m != out] + [new]
            if is_legal(after):
                options.append((-new[4], new[0], after))
    return (min(options)[2], 1) if options else (members, 0)


@pytest.mark.parametrize("charge", [None, R.TransferCharge(1, 2.0)])
def test_restarted_climbs_equal_plain_ones(spark, pool_side, charge):
    pool, teams = small_league(21)
    teams = dict(list(teams.items())[:120])
    want = {}
    for t, members in teams.items():
        if not is_legal(members):
            continue
        first = {m[0] for m in members}
        ends = []
        for start in range(4):
            squad, kicks = members, 0
            for _ in range(2 if start else 0):
                squad, kicked = plain_kick(pool, squad, first, start)
                kicks += kicked
            squad, swaps, net = plain_climb(pool, squad, first, charge)
            ends.append((-net, start, swaps + kicks, {m[0] for m in squad}))
        net, start, swaps, names = min(ends, key=lambda e: e[:2])
        want[t] = (names, start, swaps, -net)
    assert any(w[1] > 0 for w in want.values())
    got = {}
    for r in R.restarted_rosters(*league_frames(spark, pool, teams), RULES, n_restarts=3, charge=charge).collect():
        got.setdefault(r["team"], (set(), r["start"], r["n_swaps"], r["net_points"]))[0].add(r["name"])
    assert got == want


def rough_league(seed, numbered):
    """Ties, players without points, value or club, members who come twice, and a team without a name."""
    rng = random.Random(seed)
    name = (lambda i: i * 7 - 60) if numbered else (lambda i: f"p{i}")
    pool = [
        (name(i), 1 + i % 3, None if i == 5 else float(rng.randint(1, 6)), rng.choice([None, "a", "b", "c", "d", "e"]),
         None if i % 11 == 0 else float(rng.randint(0, 9)))
        for i in range(60)
    ]
    teams = []
    for t in range(150):
        members = [rng.choice(pool[k::3]) for k in (0, 1, 1, 2, 2)]
        members = [m[0] for m in (members if t % 5 == 0 else {m[0]: m for m in members}.values())]
        members += [rng.choice(pool)[0] for _ in range(RULES.size - len(members))]
        teams += [(None if t == 7 else f"t{t}", m) for m in members]
    return teams, pool


@pytest.mark.parametrize("numbered", [True, False])
@pytest.mark.parametrize("charge", [None, R.TransferCharge(1, 2.0)])
def test_climbs_inside_a_task_equal_those_by_steps(spark, rows, monkeypatch, numbered, charge):
    """Each step of eleven starts per team was stored and read again; now only the best ends leave a task."""
    teams, pool = rough_league(5, numbered)
    kind = "bigint" if numbered else "string"
    frames = (
        spark.createDataFrame(teams, f"team string, name {kind}"),
        spark.createDataFrame(pool, f"name {kind}, position int, value double, club string, points double"),
    )
    monkeypatch.setattr(climbs, "ABREAST", 50)
    with monkeypatch.context() as patch:
        patch.setattr(R, "cut_lineage", None)  # nothing is stored on the way
        df = R.restarted_rosters(*frames, RULES, n_restarts=4, charge=charge)
        got = rows(df)
    monkeypatch.setattr(R, "rows_tell_players", lambda players: False)
    by_steps = R.restarted_rosters(*frames, RULES, n_restarts=4, charge=charge)
    assert got == rows(by_steps) and df.schema == by_steps.schema
    assert len({r[0] for r in got}) > 20 and any(r[2] > 0 for r in got) and any(r[0] is None for r in got)


def test_pools_of_hundred_thousands_travel(spark):
    n = 150_000
    pool = spark.range(n).select(F.col("id").alias("name"), F.lit(1).alias("position"), (F.col("id") % 9).alias("value"), F.lit(1).alias("club"), F.col("id").alias("points"))
    finder = D.Finder(pool, D.Bounds(2, 2, 1))
    assert finder.small is not None and finder.local.num_rows == n


def plain_repair(pool, members):
    """The members after the swaps of the rule, or where it gets stuck."""
    swaps = 0
    while sum(m[2] for m in members) > 30:
        names, clubs = {m[0] for m in members}, Counter(m[3] for m in members)
        spent, options = sum(m[2] for m in members), []
        for out in members:
            for new in pool:
                if new[0] in names or new[1] != out[1] or new[2] >= out[2]:
                    continue
                if clubs[new[3]] + 1 - (new[3] == out[3]) > 2:
                    continue
                after = [m for m in members if m != out] + [new]
                fixes = spent - out[2] + new[2] <= 30
                options.append((not fixes, out[4] - new[4] if fixes else new[2] - out[2], out[0], new[0], after))
        if not options:
            return None, swaps
        members = min(options, key=lambda o: o[:4])[4]
        swaps += 1
    return members, swaps


def over_budget(members):
    at, clubs = Counter(m[1] for m in members), Counter(m[3] for m in members)
    return (
        sum(m[2] for m in members) > 30
        and all(lo <= at[p] <= hi for p, (lo, hi) in RULES.positions.items())
        and max(clubs.values()) <= 2
    )


def repaired(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["team"], (set(), r["n_swaps"], r["repaired"]))[0].add(r["name"])
    return out


def test_repairs_equal_plain_ones(spark, pool_side):
    pool, teams = small_league(31)
    want = {}
    for t, members in teams.items():
        if over_budget(members):
            fixed, swaps = plain_repair(pool, members)
            assert fixed is not None and is_legal(fixed)
            want[t] = ({m[0] for m in fixed}, swaps, True)
    assert max(w[1] for w in want.values()) > 1
    assert repaired(R.repair_rosters(*league_frames(spark, pool, teams), RULES)) == want


def test_stuck_teams_are_rebuilt_and_hopeless_ones_come_back(spark):
    # the only cheap keeper and defender share a club that a cheap forward has filled up
    rules = R.RosterRules(positions={1: (1, 1), 2: (1, 1), 3: (1, 2)}, size=3, max_value=11, max_per_club=1)
    pool = [("a", 1, 5.0, "A", 3.0), ("b", 2, 5.0, "B", 3.0), ("c", 3, 2.0, "C", 3.0), ("a2", 1, 4.0, "C", 1.0), ("d", 3, 3.0, "D", 1.0)]
    # a can go for a2 once c has gone for the dearer d: no single swap saves anything
    stuck = {"t": [pool[0], pool[1], pool[2]]}
    got = repaired(R.repair_rosters(*league_frames(spark, pool, stuck), rules))
    assert got == {"t": ({"a", "b", "c"}, 0, False)}  # 4 + 5 + 3 = 12, over 11
    looser = R.RosterRules(positions=rules.positions, size=3, max_value=11.5, max_per_club=1)
    pool[4] = ("d", 3, 2.4, "D", 1.0)
    got = repaired(R.repair_rosters(*league_frames(spark, pool, {"t": pool[:3]}), looser))
    assert got == {"t": ({"a2", "b", "d"}, 2, True)}


@pytest.mark.parametrize("seed", range(5))
def test_cheapest_team_equals_a_search_of_all(seed):
    rng = random.Random(seed)
    players = {p: sorted((rng.randint(1, 9), f"{p}{i}", rng.choice(["A", "B", "C", None])) for i in range(6)) for p in (1, 2)}
    counts = {1: 2, 2: 2}
    rules = R.RosterRules(positions={1: (2, 2), 2: (2, 2)}, size=4, max_per_club=1)
    costs = [
        sum(m[0] for m in a + b)
        for a in itertools.combinations(players[1], 2)
        for b in itertools.combinations(players[2], 2)
        if all(n <= 1 for c, n in Counter(m[2] for m in a + b).items() if c)
    ]
    team = R.cheapest_team(counts, players, rules)
    assert (sum(m[0] for m in team) if team else None) == (min(costs) if costs else None)
    assert R.cheapest_team({1: 7, 2: 0}, players, rules) is None


def test_points_travel_in_blocks_of_steps(spark):
    """Steps over several blocks, gaps, steps before the first, rows without points or step; no row per step is dealt out."""
    rng = random.Random(3)
    facts = [(n, rng.randint(-20, 70), 0, float(rng.randint(-9, 9))) for n in range(6) for _ in range(25)]
    facts += [(0, 75, 0, 3.0), (1, -40, 0, None), (2, None, 0, 5.0), (9, 80, 0, 2.0)]
    rosters = [(t, n) for t, names in {1: [0, 1, 2], 2: [3, 77], 3: [77], 4: [2, 2, 5]}.items() for n in names]
    ledger = R.weekly_reward(
        spark.createDataFrame(rosters, "team int, name int"),
        spark.createDataFrame(facts, "name int, step int, fixture int, points double"),
        "step", mode="sum",
    )
    want = {}
    for team in {t for t, _ in rosters}:
        names = [n for t, n in rosters if t == team]
        rows = [(s, p or 0.0, names.count(n)) for n, s, _, p in facts if s is not None and n in names]
        total = 0.0
        for step in sorted({*range(1, 81), *(s for s, _, _ in rows)}):
            reward = sum(p * times for s, p, times in rows if s == step)
            total += reward
            want[team, step] = (reward, total)
    assert {(r["team"], r["step"]): (r["reward"], r["running_total"]) for r in ledger.collect()} == want
    assert ledger.schema["step"].dataType.simpleString() == "int"
    plan = ledger._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.splitlines() if "hashpartitioning(team" in x]
    assert dealt and not any("step#" in x for x in dealt)


def test_improving_computes_the_given_rosters_once(spark):
    path = "/root/testdata/sf0.001"
    asked = spark.sparkContext.accumulator(0)

    def counted(batches, asked=asked):
        for batch in batches:
            asked.add(batch.num_rows)
            yield batch

    given = P.rosters(spark, path).coalesce(1).cache()
    n_rows = given.count()
    rosters = given.mapInArrow(counted, given.schema)
    improved = R.improve_rosters(rosters, P.supplier_pool(spark, path), P.ROSTER_RULES, n_steps=1)
    assert len({r["team"] for r in improved.collect()}) == given.select("team").distinct().count()
    assert asked.value == n_rows
    given.unpersist()


def test_squads_stay_where_they_are_while_they_climb(spark):
    """With a pool that travels, a step neither joins nor shuffles squads."""
    _, pool = frames(spark, variants())
    finder = R._finder(pool, R.RULES, R.COLUMNS)
    members = [dict(zip(("name", "position", "value", "club", "points"), m, strict=True)) for m in legal_team()]
    squads = spark.createDataFrame(
        [("t", 5.0, members, members, 0, 1)],
        f"team string, _spare double, _members array<struct<{PLAYER.replace(' ', ':').replace(',:', ',')}>>, "
        f"_first array<struct<{PLAYER.replace(' ', ':').replace(',:', ',')}>>, _swaps int, _start int",
    )
    step = R._moved_on(R._with_best_swap(squads, finder, R.RULES, R.COLUMNS, R.CHARGE), R.COLUMNS)
    kicked = R._kicked(squads, finder, R.RULES, R.COLUMNS, 7)
    for plan in (step, kicked):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in text and "Exchange" not in text and "Join" not in text
    assert step.drop("_changed").columns == kicked.columns == squads.columns
