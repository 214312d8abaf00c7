import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from formline.llm import prefix_forest as P


def brute(rows, k=20):
    """Exact neighbours of every query over rows (id, vector)."""
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in zip(ids, points, strict=True):
        if i % 20 == 0:
            score = (points * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def recall(got, want):
    assert set(got) == set(want)
    hits = 0
    for q, best in want.items():
        found = got[q]
        assert [r for r, _, _ in found] == list(range(1, len(best) + 1))
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
        hits += len({v for _, v, _ in found} & {v for v, _ in best})
    return hits / sum(map(len, want.values()))


def rows_of(df):
    return [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in df.collect()]


def test_recall_on_whole_tables(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows_of(vectors)
    got, want = by_query(P.nearest(vectors)), brute(rows)
    assert recall(got, want) >= 0.9
    points = dict(rows)
    for q, found in got.items():
        for _, v, score in found:
            assert score == pytest.approx(float(np.dot(points[q], points[v])), abs=1e-12)


def test_recall_does_not_fall_with_the_number_of_shards(spark, monkeypatch):
    monkeypatch.setattr(P, "QUERY_BLOCK", 40)
    rng = np.random.default_rng(2)
    points = rng.normal(size=(3000, 24)) * rng.uniform(0.2, 3, (3000, 1))
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for shard_rows in (3000, 400):
        assert recall(by_query(P.nearest(vectors, shard_rows=shard_rows)), brute(rows)) >= 0.9


def test_small_tables_find_everything(spark):
    rng = np.random.default_rng(3)
    for n in (1, 2, 15, 30):
        rows = [(i, rng.normal(size=16).tolist()) for i in range(n)]
        got = by_query(P.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), trees=2))
        assert {q: len(v) for q, v in got.items()} == {q: min(20, n - 1) for q in range(0, n, 20) if n > 1}


def test_equal_vectors_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)]
    got = by_query(P.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard_rows=50))
    assert [v for _, v, _ in got[0]] == list(range(1, 21))
    assert [v for _, v, _ in got[20]] == list(range(20))


def test_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (20, [nan, 1.0]), (6, [inf, 1.0]),
        (None, [1.0, 1.0]), (7, [0.5, 0.5]), (7, [0.5, 0.5]), (40, [1.0, 2.0, 3.0]), (8, [-1.0, 4.0]), (60, [2.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {"score": F.lit(1), "shard": F.lit("x"), "v": F.lit(0)}
    )
    got = by_query(P.nearest(df))
    assert got == {
        0: [(1, 60, 2.0), (2, 7, 0.5), (3, 8, -1.0)],
        60: [(1, 0, 2.0), (2, 8, 2.0), (3, 7, 1.5)],
    }


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert P.nearest(df).collect() == []


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_recall_on_larger_tables(spark, scale):
    vectors = spark.read.parquet(f"/root/testdata/{scale}/embeddings.parquet")
    assert recall(by_query(P.nearest(vectors)), brute(rows_of(vectors))) >= 0.9


def test_recall_on_skewed_norms(spark):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(2000, 24)) * rng.lognormal(0, 1.5, (2000, 1))
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert recall(by_query(P.nearest(vectors, shard_rows=500)), brute(rows)) >= 0.9


def test_the_index_is_stored_once_whatever_is_asked(spark, monkeypatch):
    """The plan that answers holds queries only; with an unmounted folder results are the same."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(P, "QUERY_BLOCK", 7)
    found = P.nearest(vectors, shard_rows=100)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan  # the stored vectors are read for the queries alone
    assert "(id#" in plan and "% 20" in plan
    monkeypatch.setattr(P, "mounted_folder", lambda *a: None)
    again = P.nearest(vectors, shard_rows=100)
    assert by_query(found) == by_query(again)
