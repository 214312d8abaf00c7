import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from formline.operators import evaluation as E

value = st.one_of(st.none(), st.integers(-3, 3).map(float))


def frame(spark, data):
    return spark.createDataFrame(data, "s string, y double, p double")


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), value, value), min_size=5, max_size=60))
def test_spearman_averages_ties(spark, data):
    pdf = pd.DataFrame(data, columns=["s", "y", "p"]).dropna()
    got = {r["s"]: r["rho"] for r in E.spearman(frame(spark, data), "y", "p", by=["s"]).collect()}
    for stage, part in pdf.groupby("s"):
        ranks = part[["y", "p"]].rank()
        want = ranks.y.corr(ranks.p)
        assert got[stage] == pytest.approx(want) if not np.isnan(want) else got[stage] is None


def test_ranks_in_ranges_equal_ranks_in_one(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(size=3000).round(2), np.full(1500, 0.5)])
    df = spark.createDataFrame(
        [("ab"[i % 2], float(v), float(v * v)) for i, v in enumerate(values)],
        "s string, y double, p double",
    )
    plain = E.spearman(df, "y", "p").first()["rho"]
    ranks = {r["value"]: r["rank"] for r in E.average_ranks(df, "y", rows_per_range=20).collect()}
    want = pd.Series(values).rank()
    assert all(ranks[v] == w for v, w in zip(values, want, strict=True))
    assert E.spearman(df, "y", "p", rows_per_range=50).first()["rho"] == pytest.approx(plain)
    found = E.spearman(df, "y", "p", by=["s"], rows_per_range=500)
    by = {r["s"]: r["rho"] for r in found.collect()}
    for k, s in enumerate("ab"):
        part = pd.Series(values[k::2])
        assert by[s] == pytest.approx(part.rank().corr((part * part).rank()))


def test_metrics_per_stage(spark):
    data = [("t", 1.0, 2.0), ("t", 3.0, 3.0), ("v", 5.0, 4.0), ("v", 5.0, 7.0)]
    got = {r["metric"]: r["value"] for r in E.stage_metrics(frame(spark, data), "y", "p", "s").collect()}
    assert got["t_mse"] == 0.5 and got["t_mae"] == 0.5 and got["t_r2"] == 0.5
    assert got["v_rmse"] == pytest.approx(2.5**0.5) and got["v_r2"] is None


def test_trend_line(spark):
    data = [("t", float(x), 2.0 * x + 1) for x in range(5)]
    row = E.ols_trend(frame(spark, data), "y", "p").first()
    assert (row["slope"], row["intercept"], row["r2"]) == pytest.approx((2.0, 1.0, 1.0))
    assert (row["lo"], row["hi"]) == (0.0, 9.0)


def test_scatter_has_every_point(spark, rows):
    df = spark.range(500).selectExpr("id", "id as y", "id * 2 as p")
    assert rows(E.scatter_points(df, "y", "p", ["id"])) == [(i, i, 2 * i) for i in range(500)]
    counts = E.scatter_counts(df.unionAll(df.selectExpr("id", "null", "p").limit(3)), "y", "p", 10)
    found = {(r["x_bin"], r["y_bin"]): r["n"] for r in counts.collect()}
    assert sum(found.values()) == 503
    assert {k: n for k, n in found.items() if k[0] is not None} == {(i, i): 50 for i in range(10)}
    flat = E.scatter_counts(spark.range(4).selectExpr("1 as y", "id as p"), "y", "p", 2)
    assert sorted(tuple(r) for r in flat.collect()) == [(0, 0, 2), (0, 1, 2)]


