"""Counts and best answers against plain search, in one block and in many."""

import random

import numpy as np
import pyarrow as pa
import pytest

from formline.operators import dominance as D

BOUNDS = D.Bounds(names=4, per_club=2, closed=3)
PLAYER = "name string, position int, value double, club string, points double"


def some_pool(seed, n, positions=1):
    rng = random.Random(seed)
    wide = rng.choice([4, 60])
    return [
        (
            f"p{i:03d}", rng.randint(1, positions), rng.choice([None] + [float(rng.randint(0, wide))] * 9),
            rng.choice([None, "A", "B", "C", "D", "E"]), rng.choice([None] + [float(rng.randint(0, wide))] * 9),
        )
        for i in range(n)
    ]


def some_questions(seed, pool, n):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        names = [p[0] for p in rng.sample(pool, min(len(pool), rng.randint(0, 4)))] + (["stranger"] if k % 5 == 0 else [])
        # no open club may have more than two excluded players
        clubs = [p[3] for p in pool if p[0] in names]
        closed = sorted({c for c in clubs if c and clubs.count(c) > 2} | set(rng.sample("ABCDEZ", rng.randint(0, 2))))
        out.append((k, rng.randint(1, 3), rng.choice([None, -1.0, float(rng.randint(0, 60))]), rng.choice([None, float(rng.randint(-1, 61))]), closed[:3], names[:4]))
    return out


def plain(pool, question, strict, any_points):
    k, position, least, budget, closed, excluded = question
    fits = [
        p for p in pool
        if p[1] == position and p[2] is not None and budget is not None
        and (p[2] < budget if strict else p[2] <= budget)
        and (any_points or (p[4] is not None and least is not None and p[4] > least))
        and p[3] not in closed and p[0] not in excluded
    ]
    best = min(fits, key=lambda p: (p[4] is None, -(p[4] or 0), p[0]))[0] if fits else None
    return (k, len(fits), best) if fits else None


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("any_points", [True, False])
@pytest.mark.parametrize("rows_per_block", [None, 25])
def test_answers_equal_plain_search(spark, monkeypatch, strict, any_points, rows_per_block):
    if rows_per_block:
        monkeypatch.setattr(D, "table_within", lambda df: None)
        monkeypatch.setattr(D, "BLOCK_ROWS", rows_per_block)
    for seed, size in ((1, 150), (2, 3), (3, 0)):
        pool = some_pool(seed, size, positions=3)
        questions = some_questions(seed, pool, 200)
        asked = spark.createDataFrame(
            questions, "k long, _position int, _least double, _budget double, _closed array<string>, _excluded array<string>"
        )
        finder = D.Finder(spark.createDataFrame(pool, PLAYER), BOUNDS)
        asked = asked.drop("_least") if any_points else asked
        found = finder.answers(asked, ["k"], strict=strict).collect()
        wanted = [w for q in questions if (w := plain(pool, q, strict, any_points))]
        assert sorted((r["k"], r["n_options"], r["_in"]["name"]) for r in found) == wanted


def test_merge_counts():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 100):
        ranks = rng.integers(0, 9, n)
        prefix, least = rng.integers(0, n + 1, 300), rng.integers(0, 10, 300)
        got = D.MergeCounts(ranks, 9).above(prefix, least)
        assert got.tolist() == [int((ranks[:p] >= r).sum()) for p, r in zip(prefix, least, strict=True)]


def test_frontiers_hold_the_best_of_each_club():
    rng = random.Random(3)
    places, clubs = np.array(rng.sample(range(80), 80)), np.array([rng.randint(-1, 3) for _ in range(80)])
    version, table = D.frontiers(places, clubs, BOUNDS)
    for prefix in range(81):
        best, used = [], {}
        for row in sorted(range(prefix), key=lambda i: places[i]):
            used[clubs[row]] = used.get(clubs[row], 0) + 1
            if used[clubs[row]] <= (BOUNDS.names + 1 if clubs[row] < 0 else BOUNDS.per_club + 1):
                best.append(row)
        assert [r for r in table[version[prefix]] if r >= 0] == best[: BOUNDS.most]


def test_questions_do_not_grow_with_the_pool(spark):
    """No join between questions and players is planned while the pool is small."""
    pool = spark.createDataFrame(some_pool(5, 100), PLAYER)
    asked = spark.createDataFrame([(1, 1, 0.0, 9.0, ["A"], ["p001"])], "k long, _position int, _least double, _budget double, _closed array<string>, _excluded array<string>")
    plan = D.Finder(pool, BOUNDS).answers(asked, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "MapInArrow" in plan


def test_numbers():
    assert D.numbers(pa.array([1, None], pa.int32())).tolist() == [1, np.iinfo(np.int64).min]
    assert D.numbers(pa.array([1.5, None])).tolist() == [1.5, -np.inf]
