import hashlib
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from formline.operators import splits as S


def keys_of(df):
    return {r["id"] for r in df.select("id").collect()}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(1, 400), st.sampled_from([0.0, 0.25, 0.5, 0.8, 1.0]), st.integers(0, 9))
def test_split_is_exact_complete_and_ordered_by_hash(spark, n, frac, seed):
    df = spark.range(n)
    train, val = S.random_split(df, "id", frac, seed)
    train, val = keys_of(train), keys_of(val)
    assert len(val) == (0 if frac == 1 else math.ceil((1 - frac) * n))
    assert train | val == set(range(n)) and not train & val
    ordered = sorted(range(n), key=lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest())
    assert val == set(ordered[: len(val)])


def test_narrowing_the_prefix_gives_the_same_rows(spark, monkeypatch):
    df = spark.range(3000)
    plain = keys_of(S.random_split(df, "id", 0.7)[1])
    monkeypatch.setattr(S, "CUT_ROWS", 1)
    monkeypatch.setattr(S, "PREFIX_STEP", 1)
    assert keys_of(S.random_split(df, "id", 0.7)[1]) == plain


def test_edge_shares_mean_what_they_say(spark):
    df = spark.range(5)
    assert [x.count() for x in S.random_split(df, "id", 1.0)] == [5, 0]
    assert [x.count() for x in S.random_split(df, "id", 0.0)] == [0, 5]
    assert [x.count() for x in S.random_test_split(df, "id", 1.0)] == [0, 5]
    assert [x.count() for x in S.random_test_split(df, "id", 0.0)] == [5, 0]
    assert [x.count() for x in S.random_split(df.limit(0), "id", 0.5)] == [0, 0]
    with pytest.raises(ValueError):
        S.random_split(df, "id", 1.5)


@pytest.mark.parametrize("cut_rows", [20_000, 3])
def test_rows_that_share_a_key_are_split_exactly(spark, monkeypatch, cut_rows):
    monkeypatch.setattr(S, "CUT_ROWS", cut_rows)
    distinct = spark.range(100).selectExpr("id % 3 as k", "id as v")
    equal = spark.range(100).selectExpr("id % 2 as k", "cast(null as string) as v")
    for df, columns in ((distinct, ["k", "v"]), (equal, ["k", "v"])):
        for share in (0.5, 0.37, 0.99):
            train, val = S.random_split(df, "k", share)
            want = math.ceil((1.0 - share) * 100)
            assert (train.count(), val.count()) == (100 - want, want)
            both = train.select(*columns).union(val.select(*columns))
            assert sorted(map(str, both.collect())) == sorted(map(str, df.select(*columns).collect()))


def test_missing_parts_of_a_key_are_values(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (None, None)], "x string, y string")
    hashes = {r[0] for r in df.select(S._hash_order(["x", "y"], 1)).collect()}
    assert len(hashes) == 4


def test_temporal_split_leaves_other_periods_out(spark):
    df = spark.createDataFrame([(y,) for y in (2019, 2020, 2021, 2022)], "id int")
    train, test = S.temporal_split(df, "id", [2020, 2021], [2022])
    assert keys_of(train) == {2020, 2021} and keys_of(test) == {2022}
    labels = {r[0]: r[1] for r in df.select("id", S.temporal_label("id", [2020, 2021], [2022])).collect()}
    assert labels == {2019: "master", 2020: "train", 2021: "train", 2022: "test"}
