"""Trees by their criteria against a search of all splits, and boosting against its promise."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from formline.models import training, trees
from formline.session import fresh_path


def frame(spark, x, y):
    rows = [(i, [float(v) for v in a], float(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "k int, x array<double>, label double").select("k", array_to_vector("x").alias("features"), "label")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (400, 3)).astype(float)
    y = np.round(4 * (x[:, 0] > 5) + x[:, 1] * (x[:, 2] > 3) + rng.integers(0, 3, 400) + 30 * (rng.random(400) < 0.03))
    return x, y, frame(spark, x, y).coalesce(3).persist()


def plain_cost(y, criterion):
    if not len(y):
        return 0.0
    middle = np.sort(y)[(len(y) - 1) // 2] if criterion == "absolute_error" else y.mean()
    return np.abs(y - middle).sum() if criterion == "absolute_error" else ((y - middle) ** 2).sum()


@pytest.mark.parametrize("criterion", trees.CRITERIA)
def test_one_split_equals_a_search_of_all(data, criterion):
    x, y, df = data
    options = [
        (plain_cost(y[x[:, f] <= t], criterion) + plain_cost(y[x[:, f] > t], criterion), f, t)
        for f in range(3) for t in np.unique(x[:, f])[:-1]
    ]
    best, f, t = min(options)
    model = trees.TreeForest(criterion=criterion, nTrees=1, maxDepth=1).fit(df)
    got = np.array([r["prediction"] for r in model.transform(df).orderBy("k").collect()])
    assert len(np.unique(got)) == 2
    left = got == got[np.argmin(x[:, f])]
    assert plain_cost(y[left], criterion) + plain_cost(y[~left], criterion) == pytest.approx(best)
    for side in (left, ~left):
        wanted = np.sort(y[side])[(side.sum() - 1) // 2] if criterion == "absolute_error" else y[side].mean()
        assert got[side][0] == pytest.approx(wanted)


@pytest.mark.parametrize("criterion", trees.CRITERIA)
def test_deeper_trees_learn_and_passes_do_not_matter(data, criterion, monkeypatch):
    x, y, df = data
    forest = trees.TreeForest(criterion=criterion, nTrees=4, maxDepth=4, share=0.7, maxFeatures=0.7, seed=3)
    one = forest.fit(df)
    monkeypatch.setattr(trees, "PASS_NUMBERS", 10)
    several = forest.fit(df)
    assert one.getOrDefault("trees") == several.getOrDefault("trees")
    error = one.transform(df).select(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]
    assert error < 0.8 * np.abs(y - np.median(y)).mean()
    stump = trees.TreeForest(criterion=criterion, nTrees=1, maxDepth=4, minSplit=1.5).fit(df)
    assert stump.transform(df).select("prediction").distinct().count() == 1


def test_boosting_never_raises_the_error(data, monkeypatch):
    monkeypatch.setattr(trees, "STORED_ROUNDS", 7)
    x, y, df = data
    model = trees.AbsoluteBoosting(nTrees=20, rate=0.3, maxDepth=2).fit(df)
    history = model.getHistory()
    assert history[0] == pytest.approx(np.abs(y - np.sort(y)[(len(y) - 1) // 2]).mean())
    assert all(b <= a + 1e-9 for a, b in zip(history, history[1:], strict=False)) and history[-1] < 0.6 * history[0]
    after = model.transform(df).select(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]
    assert after <= history[-1] + 1e-9
    # leaves that hold means of the signs, as Spark's have them, come less far
    spark_like = training.GBTRegressor(lossType="absolute", maxIter=20, stepSize=0.3, maxDepth=2).fit(df)
    assert after < spark_like.transform(df).select(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]
    sampled = trees.AbsoluteBoosting(nTrees=6, rate=0.3, maxDepth=2, share=0.5).fit(df)
    assert sampled.getHistory()[-1] < history[0]


def test_models_survive_saving_and_odd_data(spark, data):
    _, _, df = data
    model = Pipeline(stages=[trees.TreeForest(nTrees=2, maxDepth=2)]).fit(df)
    path = fresh_path(spark, "test-trees")
    training.save_pipeline(model, path)
    first, again = (m.transform(df).select("k", "prediction").orderBy("k").collect() for m in (model, training.load_pipeline(path)))
    assert first == again
    with pytest.raises(ValueError):
        trees.TreeForest(nTrees=1).fit(df.limit(0))
    constant = frame(spark, [[1.0], [1.0]], [2.0, 2.0])
    for estimator in (trees.TreeForest(nTrees=1, criterion="absolute_error"), trees.AbsoluteBoosting(nTrees=2)):
        assert {r["prediction"] for r in estimator.fit(constant).transform(constant).collect()} == {2.0}
    with pytest.raises(ValueError):
        trees.TreeForest(criterion="other")


def test_samples_are_drawn_alike_again():
    row = np.arange(20_000)
    one = trees.drawn(row, 0.6, 4)
    assert (one == trees.drawn(row, 0.6, 4)).all() and abs(one.mean() - 0.6) < 0.03 and one.max() < 12
    assert abs((one == 0).mean() - np.exp(-0.6)) < 0.02


@pytest.mark.parametrize("bins, rows", [(1024, 20_000), (4, 1)])
def test_medians_are_exact_however_far_values_lie_apart(spark, monkeypatch, bins, rows):
    monkeypatch.setattr(trees, "MEDIAN_BINS", bins)
    monkeypatch.setattr(trees, "MEDIAN_ROWS", rows)
    monkeypatch.setattr(trees, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(2)
    x = rng.integers(0, 4, (500, 1)).astype(float)
    y = np.concatenate([rng.normal(size=300), np.full(150, 0.25), 1e6 * rng.normal(size=50)])
    binner, blocks = trees.binned(frame(spark, x, y).repartition(3), "features", "label")
    tree = trees.Tree()
    tree.split(0, 0, int(np.searchsorted(binner.features[0], 1.0)))
    medians, error, low, high = trees._medians(blocks, 1, tree, lambda b: b.y, lambda b: np.ones(len(b.y), bool), y.min(), y.max())
    for leaf, side in ((1, x[:, 0] <= 1), (2, x[:, 0] > 1)):
        assert medians[leaf] == np.sort(y[side])[(side.sum() - 1) // 2]
    assert medians[0] == 0.0 and error == pytest.approx(np.abs(y).mean()) and low <= y.min() and high >= y.max()


def test_passes_read_blocks_and_not_rows(spark):
    """400 rounds read the rows two thousand times: a block of rows has to be one row to Spark."""
    df = frame(spark, np.zeros((5000, 2)), np.arange(5000.0)).coalesce(2)
    _, blocks = trees.binned(df, "features", "label")
    assert blocks.count() <= 3 and sum(len(b["y"]) // 8 for b in blocks.collect()) == 5000


def test_large_trees_lead_rows_as_small_ones_do(monkeypatch):
    rng = np.random.default_rng(8)
    tree, ends = trees.Tree(), [0]
    for _ in range(5):
        ends = [c for node in ends for c in tree.split(node, int(rng.integers(3)), int(rng.integers(32)))]
    codes = rng.integers(0, 32, (3, 1000)).astype(np.uint8)
    small = tree.leaves(codes)
    monkeypatch.setattr(trees, "SMALL_TREE", 1)
    assert (tree.leaves(codes) == small).all() and len(np.unique(small)) > 4


@pytest.mark.parametrize("share", [1.0, 0.5])
def test_one_task_boosts_few_rows_as_passes_over_many_do(spark, data, monkeypatch, share):
    """400 rounds of five passes are two thousand Spark jobs, which cost more than what they compute."""
    x, y, df = data
    jobs = []
    plain = trees._added
    monkeypatch.setattr(trees, "_added", lambda *a: jobs.append(1) or plain(*a))
    monkeypatch.setattr(trees, "STEP_ROWS", 150)
    monkeypatch.setattr(trees, "GROUP_CELLS", 200)
    boosting = trees.AbsoluteBoosting(nTrees=9, rate=0.3, maxDepth=3, share=share)
    held = boosting.fit(df)
    assert not jobs
    monkeypatch.setattr(trees, "HELD_BYTES", 0)
    passed = boosting.fit(df)
    assert len(jobs) >= 9 * 4
    assert held.getHistory() == pytest.approx(passed.getHistory())
    each = zip(*(m.transform(df).orderBy("k").collect() for m in (held, passed)), strict=True)
    assert all(a["prediction"] == pytest.approx(b["prediction"]) for a, b in each)


def test_grouped_features_are_counted_as_each_by_itself():
    rng = np.random.default_rng(3)
    binner = trees.Binner([list(range(n)) for n in (31, 25, 1, 1, 2, 30)], [0.0])
    groups = trees.Groups(binner)
    assert sorted(sum(groups.members, [])) == list(range(6)) and len(groups.members) == 2
    codes = np.stack([rng.integers(0, n, 500) for n in groups.sizes]).astype(np.uint8)
    place, weight = rng.integers(0, 3, 500), rng.integers(1, 4, 500) * (trees.UNIT + rng.integers(-1, 2, 500))
    for g, sums in enumerate(groups.sums(groups.combined(codes), place, weight, 3)):
        for f, by_bin in groups.apart(g, sums, 3):
            assert (groups.code(list(groups.combined(codes))[g], f) == codes[f]).all()
            assert (by_bin == np.bincount(place * groups.sizes[f] + codes[f], weight, 3 * groups.sizes[f]).reshape(3, -1)).all()
    told = trees._told_apart(np.array([3 * trees.UNIT - 2, trees.UNIT + 1, 0.0]))
    assert told.tolist() == [[3, -2], [1, 1], [0, 0]]
