import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from formline.models import svr, training, trials
from formline.models.features import (
    PRESETS,
    AssembleFeatures,
    EncodeColumns,
    FeatureRoles,
    ScaleColumns,
    shape_of,
    vector_encoding,
    vector_entries,
)
from formline.plans import queries
from formline.session import fresh_path

ROLES = FeatureRoles(
    numerical=("X_a",),
    categorical=("X_c",),
    feature_prefixes=("X_a", "X_rolling_", "X_c"),
    label="y",
)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(7)
    data = [
        (i, float(a), float(b), "uvw"[c], float(3 * a - 2 * b + (c == 1) * 4 + e))
        for i, (a, b, c, e) in enumerate(
            zip(rng.normal(size=600), rng.normal(size=600), rng.integers(0, 3, 600),
                rng.normal(size=600) * 0.1, strict=True)
        )
    ]
    schema = "k int, X_a double, X_rolling_b double, X_c string, y double"
    return spark.createDataFrame(data, schema).persist()


def test_scaling_uses_population_deviation_and_spares_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (3.0, 5.0, None)], "X_a double, X_b double, c double")
    model = ScaleColumns(inputCols=["c"], prefixes=["X_"]).fit(df)
    assert model.getInputCols() == ["c", "X_a", "X_b"]
    got = [tuple(r) for r in model.transform(df).orderBy("X_a").collect()]
    assert got == [(-1.0, 0.0, 0.0), (1.0, 0.0, None)]


def test_encoding_orders_categories_and_ignores_unseen(spark):
    fit = spark.createDataFrame([(10, True), (9, False), (None, None)], "n int, b boolean")
    new = spark.createDataFrame([(1, 10, True), (2, 7, None)], "k int, n int, b boolean")
    got = EncodeColumns(inputCols=["n", "b"]).fit(fit).transform(new)
    assert got.columns == ["k", "n_9", "n_10", "b_false", "b_true"]
    assert [tuple(r)[1:] for r in got.orderBy("k").collect()] == [(0.0, 1.0, 0.0, 1.0), (0.0,) * 4]
    kept = EncodeColumns(inputCols=["n"], dropSource=False).fit(fit).transform(new)
    assert kept.columns == ["k", "n", "b", "n_9", "n_10"]
    with pytest.raises(ValueError, match="more than 1"):
        EncodeColumns(inputCols=["n", "b"], maxCategories=1).fit(fit)


def test_assembling_without_label(spark, table):
    ready = AssembleFeatures(prefixes=["X_a", "X_r"], labelColumn="y").transform(table.drop("y"))
    assert "label" not in ready.columns
    assert shape_of(ready) == (600, 2, 0)


@pytest.mark.parametrize("preset, width", [("encoded", 5), ("scaled", 5)])
def test_presets_survive_saving(spark, table, preset, width):
    model = Pipeline(stages=PRESETS[preset](ROLES)).fit(table)
    path = fresh_path(spark, "test-pipeline")
    training.save_pipeline(model, path)
    first, again = (
        m.transform(table).orderBy("k").select(vector_to_array("features").alias("f"), "label").collect()
        for m in (model, training.load_pipeline(path))
    )
    assert first == again and len(first[0]["f"]) == width


def test_plain_preset_takes_every_prefixed_column(spark, table):
    numeric = table.drop("X_c")
    ready = Pipeline(stages=PRESETS["plain"](ROLES)).fit(numeric).transform(numeric)
    assert shape_of(ready) == (600, 2, 1)
    assert PRESETS["identity"](ROLES) == []


def objective(x, y, w, epsilon, cost):
    return 0.5 * w @ w + cost * np.maximum(np.abs(y - x @ w) - epsilon, 0).sum()


@pytest.mark.parametrize("epsilon, cost", [(0.0, 1.0), (0.5, 0.25), (2.0, 1.5)])
def test_svr_reaches_the_minimum(spark, table, epsilon, cost):
    ready = AssembleFeatures(prefixes=["X_a", "X_r"], labelColumn="y").transform(table)
    model = training.linear_svr(epsilon, cost, tol=1e-7, max_iter=150).fit(ready)
    history = model.getOrDefault(model.objectiveHistory)
    assert all(b <= a * (1 + 1e-9) for a, b in zip(history, history[1:], strict=False))
    pdf = table.toPandas()
    x = np.column_stack([pdf.X_a, pdf.X_rolling_b, np.ones(len(pdf))])
    y = pdf.y.to_numpy()
    w = np.array([*model.getOrDefault(model.coefficients), model.getOrDefault(model.intercept)])
    reached = objective(x, y, w, epsilon, cost)
    assert reached == pytest.approx(min(history))
    rng = np.random.default_rng(1)
    for scale in (1.0, 0.1, 0.01):
        for _ in range(300):
            other = objective(x, y, w + rng.normal(size=3) * scale, epsilon, cost)
            assert reached <= other * (1 + 1e-4)
    scored = model.transform(ready).select("X_a", "X_rolling_b", "prediction").toPandas()
    assert np.allclose(scored.prediction, np.column_stack([scored.X_a, scored.X_rolling_b, np.ones(600)]) @ w)


def test_svr_sums_many_partitions_in_spark(spark, table, monkeypatch):
    ready = AssembleFeatures(prefixes=["X_a", "X_r"], labelColumn="y").transform(table)
    plain = training.linear_svr(0.5, max_iter=5).fit(ready)
    monkeypatch.setattr(svr, "DIRECT_PARTIALS", 2)
    tree = training.linear_svr(0.5, max_iter=5).fit(ready.repartition(9))
    for p in ("coefficients", "objectiveHistory"):
        assert tree.getOrDefault(tree.getParam(p)) == pytest.approx(plain.getOrDefault(plain.getParam(p)))


@pytest.mark.parametrize(
    "estimator, least",
    [
        (lambda: training.random_forest(n_estimators=20, max_features=0.8, max_depth=8), 0.8),
        (lambda: training.boosted_trees(n_estimators=30, learning_rate=0.3), 0.75),
        (lambda: training.linear_svr(epsilon=0.1), 0.95),
    ],
)
def test_regressors_learn(spark, table, estimator, least):
    train, val, test = (table.where(f"k % 3 = {i}") for i in range(3))
    model, metrics = training.train_and_evaluate(
        train, val, test, PRESETS["encoded"](ROLES), estimator()
    )
    scores = training.metrics_map(metrics)
    assert set(scores) == {
        f"{s}_{m}" for s in ("train", "val", "test") for m in ("mse", "rmse", "mae", "r2", "spearman")
    }
    assert scores["val_r2"] > least and scores["test_spearman"] > least
    assert training.chosen_metrics(scores, ["val_mse"]) == scores["val_mse"]
    assert training.chosen_metrics(scores, ["val_mse", "val_r2"]) == (scores["val_mse"], scores["val_r2"])
    scored = training.score_table(model, test.drop("y"))
    assert scored.columns == [*test.drop("y").columns, "pred_total_points"]
    assert scored.count() == test.count()


def test_search_fills_the_trial_table(spark, table):
    train, val = table.where("k % 4 > 0"), table.where("k % 4 = 0")
    rows = training.search(
        train, val, None, PRESETS["encoded"](ROLES), "linear_svr", training.SVR_SPACE,
        "svr", n_trials=3, fixed={"max_iter": 4},
    )
    path = fresh_path(spark, "test-trials")
    trials.append_trials(spark, rows, path)
    trials.append_trials(spark, [trials.trial_row("other", {}, {"val_mse": None}, 1)], path)
    found = trials.read_trials(spark, path, "svr")
    assert found.count() == 3 and trials.read_trials(spark, path).count() == 4
    row = found.first()
    assert row["params"].keys() == {"regressor", "epsilon", "tol", "C"}
    assert {"train_mse", "val_r2"} <= row["metrics"].keys()
    best = min(r["metrics"]["val_mse"] for r in found.collect())
    assert trials.best_trial(found, "val_mse").first()["metrics"]["val_mse"] == best


def test_search_points_are_drawn_by_seed():
    points = training.search_points(training.SVR_SPACE, 100, 1)
    assert len(points) == 100 and len({tuple(p.items()) for p in points}) == 100
    assert points == training.search_points(training.SVR_SPACE, 100, 1)
    assert len(training.search_points(training.SVR_SPACE, None, 1)) == 270
    assert len(training.search_points(training.BOOSTING_SPACE, None, 1)) == 75


def test_ranking_trials(spark, rows):
    table = trials.trial_frame(
        spark,
        [trials.trial_row("e", {}, {"val_mse": m, "val_spearman": s}, 1, run_id=f"r{i}")
         for i, (m, s) in enumerate([(3.0, 0.1), (1.0, 0.9), (2.0, 0.9), (None, None)])],
    )
    assert trials.best_trial(table, "val_mse").first()["run_id"] == "r1"
    assert trials.best_trial(table, "val_spearman").first()["run_id"] == "r1"
    assert trials.best_trial(table, "val_mse", ascending=False).first()["run_id"] == "r0"
    assert rows(trials.trials_to_drop(table, "val_mse", 2), "run_id") == [("r0",), ("r3",)]
    assert rows(trials.trials_to_drop(table, "val_mse", 2, ascending=False), "run_id") == [("r1",), ("r3",)]
    assert trials.trials_to_drop(table, "val_mse", 9).isEmpty()


def test_runs_are_not_ranked_by_a_metric_that_none_has(spark):
    rows = [trials.trial_row("e", {}, {"val_mse": m}, 1, run_id=f"r{i}") for i, m in enumerate([9.0, 1.0, 5.0])]
    table = trials.trial_frame(spark, rows)
    with pytest.raises(ValueError, match="val_spearman"):
        trials.best_trial(table, "val_spearman")
    with pytest.raises(ValueError, match="val_spearman"):
        trials.trials_to_drop(table, "val_spearman", 1)
    assert trials.best_trial(table, "val_mse").first()["run_id"] == "r1"


def test_the_logged_seed_is_the_one_used(spark, table, tmp_path):
    train, val = table.where("k % 4 > 0"), table.where("k % 4 = 0")
    rows = training.search(
        train, val, None, PRESETS["encoded"](ROLES), "random_forest", {"n_estimators": [2], "min_samples_split": [1.0]},
        "forest", seed=7, rank=False, models_dir=str(tmp_path),
    )
    (row,) = rows
    forest = training.load_pipeline(f"{tmp_path}/{row.run_id}").stages[-1]
    assert row.seed == 7 and forest.getSeed() == 7
    assert row.params["min_share_per_child"] == "0.49"


def test_the_fit_tells_whether_it_settled(spark, table):
    ready = Pipeline(stages=PRESETS["encoded"](ROLES)).fit(table).transform(table)
    assert training.linear_svr(max_iter=300).fit(ready).getConverged()
    assert not training.linear_svr(max_iter=1, tol=1e-12).fit(ready).getConverged()


def test_missing_features(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 3.0, 4.0)], "k int, X_a double, X_b double")

    def vectors(missing):
        out = AssembleFeatures(prefixes=["X_"], missing=missing).transform(df)
        return {r["k"]: r["features"].toArray().tolist() for r in out.collect()}

    assert vectors("zero") == {1: [1.0, 0.0], 2: [3.0, 4.0]}
    assert vectors("skip") == {2: [3.0, 4.0]}
    with pytest.raises(Exception, match="(?i)null|nan"):
        vectors("error")
    with pytest.raises(ValueError):
        AssembleFeatures(missing="other")


def test_many_categories_become_a_vector(spark):
    df = spark.createDataFrame([(i, f"c{i:04d}") for i in range(1500)], "k int, c string")
    with pytest.raises(ValueError):
        EncodeColumns(inputCols=["c"]).fit(df)
    model = Pipeline(stages=vector_encoding(["c"], "_v")).fit(df)
    other = spark.createDataFrame([(0, "c0007"), (1, "new"), (2, None)], "k int, c string")
    got = {r["k"]: r["c_v"] for r in model.transform(other).collect()}
    assert got[0].size == 1500 and got[0].indices.tolist() == [7]
    assert got[1].indices.size == got[2].indices.size == 0
    assembled = AssembleFeatures(prefixes=["c_v"]).transform(model.transform(other))
    assert assembled.first()["features"].size == 1500


def test_fits_of_many_settings_equal_single_ones(spark, table):
    ready = Pipeline(stages=PRESETS["encoded"](ROLES)).fit(table).transform(table).select("features", "label").coalesce(3)
    settings = [(0.0, 1.0, 1e-4), (0.5, 0.25, 1e-2), (2.0, 0.01, 1e-5), (0.1, 1.5, 1e-3)]
    estimators = [training.linear_svr(e, c, t, 60) for e, c, t in settings]
    together = svr.fit_together(estimators, ready)
    scores = training.evaluate_together(together, {"train": ready, "val": ready.limit(100)})
    for estimator, model, score in zip(estimators, together, scores, strict=True):
        single = estimator.fit(ready)
        assert model.getConverged() and single.getConverged()
        # residuals near nothing weigh up to a million, so the order of sums shows after a few passes
        assert model.getHistory()[:3] == pytest.approx(single.getHistory()[:3])
        assert min(model.getHistory()) == pytest.approx(min(single.getHistory()), rel=10 * estimator.getTol())
        wanted = training.metrics_map(training.evaluate(model, {"train": ready}))
        assert {k: score[k] for k in wanted} == pytest.approx(wanted)
        assert set(score) - set(wanted) == {k.replace("train", "val") for k in wanted}


def test_one_pass_adds_up_all_settings():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(50, 3)), rng.normal(size=50)
    batch = pa.RecordBatch.from_arrays([pa.array(list(x)), pa.array(y)], ["x", "y"])
    weights, epsilons = rng.normal(size=(4, 4)), np.array([0.0, 0.1, 0.5, 2.0])

    def sums(w, e):
        (out,) = svr._partial_sums(w, e)(iter([batch]))
        return out.column("sums").flatten().to_numpy()

    each = [sums(weights[k : k + 1], epsilons[k : k + 1]) for k in range(4)]
    assert sums(weights, epsilons) == pytest.approx(np.concatenate(each))
    whole = np.column_stack([x, np.ones(50)])
    r = y - whole @ weights[2]
    c = 0.5 / np.abs(r - 0.5) + 0.5 / np.abs(r + 0.5)
    assert each[2][:10] == pytest.approx(((whole * c[:, None]).T @ whole)[np.triu_indices(4)])
    assert each[2][-1] == pytest.approx(np.maximum(np.abs(r) - 0.5, 0).sum())


def test_a_search_reads_the_rows_as_often_as_its_slowest_fit(spark, table, monkeypatch):
    passes = []
    plain = svr._added
    monkeypatch.setattr(svr, "_added", lambda *a: passes.append(1) or plain(*a))
    rows = training.search(
        table, table.limit(50), None, PRESETS["encoded"](ROLES), "linear_svr", training.SVR_SPACE, "svr",
        n_trials=100, fixed={"max_iter": 100}, rank=False,
    )
    assert len(rows) == 100 and len(passes) == max(r.metrics["passes"] for r in rows) < 110


def test_wide_rows_reach_the_same_minimum(spark, table, monkeypatch):
    ready = Pipeline(stages=PRESETS["encoded"](ROLES)).fit(table).transform(table).select("features", "label")
    as_sparse = F.udf(lambda v: Vectors.sparse(v.size, [i for i in range(v.size) if v[i]], [x for x in v if x]), VectorUDT())
    mixed = F.when(F.rand(1) < 0.7, as_sparse("features")).otherwise(F.col("features")).alias("features")
    ready = ready.coalesce(2).select(mixed, "label")
    for epsilon, cost in ((0.0, 1.0), (0.5, 0.25)):
        exact = training.linear_svr(epsilon, cost, tol=1e-7, max_iter=300).fit(ready)
        with monkeypatch.context() as patch:
            patch.setattr(svr, "DENSE_WIDTH", 2)
            wide = training.linear_svr(epsilon, cost, tol=1e-4, max_iter=2000).fit(ready)
        assert wide.getConverged()
        assert min(wide.getHistory()) < 1.002 * min(exact.getHistory())
        x, w = ready.first()["features"].toArray(), np.array(wide.getOrDefault("coefficients"))
        with monkeypatch.context() as patch:
            patch.setattr(svr, "DENSE_WIDTH", 2)
            assert wide.transform(ready).first()["prediction"] == pytest.approx(x @ w + wide.getOrDefault("intercept"))


def test_twenty_thousand_categories_fit(spark):
    rows = spark.range(60_000, numPartitions=4).select(
        (F.col("id") % 20_000).alias("c"), ((F.col("id") % 20_000) % 7).cast("double").alias("label")
    )
    ready = rows.select(
        F.udf(lambda c: Vectors.sparse(20_000, [c], [1.0]), VectorUDT())("c").alias("features"), "label"
    )
    model = training.linear_svr(epsilon=0.0, C=1.0, tol=1e-3, max_iter=150).fit(ready)
    assert len(model.getOrDefault("coefficients")) == 20_000
    history = model.getHistory()
    assert min(history) < 0.6 * history[0]


def test_category_numbers_survive_ranges_and_saving(spark, table):
    """Numbers follow the text's order over several ranges and columns, and are saved with the pipeline."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, f"c{(i * 7919) % 997:03d}", None if i % 5 == 0 else f"d{i % 30}", 1.0) for i in range(3000)]
        df = spark.createDataFrame(rows, "k int, c string, `d.e` string, y double")
        model = Pipeline(stages=vector_encoding(["c", "d.e"])).fit(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    numbers = model.stages[0].numbers(spark).collect()
    for i, seen in enumerate((sorted({r[1] for r in rows}), sorted({r[2] for r in rows if r[2]}))):
        assert [r["text"] for r in sorted(numbers, key=lambda r: r["number"]) if r["column"] == i] == seen
        assert sorted(r["number"] for r in numbers if r["column"] == i) == list(range(len(seen)))
    path = fresh_path(spark, "test-categories")
    training.save_pipeline(model, path)
    again = training.load_pipeline(path)
    assert again.stages[0].getOrDefault("table").startswith(path)
    first, second = (m.transform(df).orderBy("k").select("k", "c_vector", "`d.e_vector`").collect() for m in (model, again))
    assert first == second and first[5][2].indices.size == 0 and first[5][1].indices.tolist() == [(5 * 7919) % 997]
    assert first[0]["c_vector"].size == 997


def test_entries_of_wide_vectors_are_read_without_spreading_them(spark):
    rows = [(0, Vectors.sparse(2_000_000_000, [5, 1_999_999_999], [1.0, 2.5])), (1, Vectors.dense([0.0, 3.0])), (2, Vectors.sparse(4, [], []))]
    df = spark.createDataFrame(rows, ["k", "v.w"])
    got = df.select("k", *vector_entries("v.w")).orderBy("k").collect()
    assert [(list(r[1]), list(r[2])) for r in got] == [([5, 1_999_999_999], [1.0, 2.5]), ([0, 1], [0.0, 3.0]), ([], [])]


def test_the_vector_query_spreads_no_vector(spark):
    plan = queries.one_hot_vector(spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().toString()
    assert "c_name_vector" in plan and "vector_to_array" not in plan.lower() and "UDF(" not in plan


@pytest.mark.parametrize("rows_per_range", [40, 1_000_000])
def test_shared_scores_equal_those_of_single_models(spark, rows_per_range):
    rng = np.random.default_rng(5)
    data = [("a" if i % 3 else "b", float(rng.integers(0, 9)) if i % 7 else None, Vectors.dense(rng.integers(0, 30, 2) / 4.0)) for i in range(700)]
    df = spark.createDataFrame(data, ["stage", "label", "features"]).repartition(5)
    # the second has ties in plenty, the third predicts one value, the fourth is the first again
    weights = [((0.3, -1.7), 0.5), ((1.0, 0.0), 0.0), ((0.0, 0.0), 2.0), ((0.3, -1.7), 0.5)]
    models = [svr.LinearSVRModel(coefficients=list(w), intercept=b) for w, b in weights]
    found = svr.score_together(models, df, rows_per_range=rows_per_range)
    for model, scores in zip(models, found, strict=True):
        frames = {s: df.where(F.col("stage") == s) for s in "ab"}
        wanted = training.metrics_map(training.evaluate(model, frames))
        assert set(scores) == set(wanted)
        assert scores == {k: v if v is None else pytest.approx(v) for k, v in wanted.items()}
    assert svr.score_together(models, df, rank=False)[1] == {k: v for k, v in found[1].items() if "spearman" not in k}


def test_settings_that_differ_in_tolerance_share_their_passes(spark, table, monkeypatch):
    ready = Pipeline(stages=PRESETS["encoded"](ROLES)).fit(table).transform(table).select("features", "label")
    asked = []
    plain = svr._partial_sums
    monkeypatch.setattr(svr, "_partial_sums", lambda w, e: asked.append(len(w)) or plain(w, e))
    models = svr.fit_together([training.linear_svr(0.5, 1.0, tol, 60) for tol in (1e-1, 1e-3, 1e-5)], ready)
    assert set(asked) == {1}
    passes = [len(m.getHistory()) for m in models]
    assert passes == sorted(passes) and all(m.getHistory() == models[-1].getHistory()[:n] for m, n in zip(models, passes, strict=True))


def test_forests_of_a_grid_share_their_trees_and_score_as_single_ones(spark, table, monkeypatch):
    """Ten thousand settings are a search only if no tree is grown twice."""
    frames = [table.where(f"k % 3 = {i}") for i in range(3)]
    space = {
        "n_estimators": [2, 5], "min_samples_split": [0.1, 0.4], "max_features": [0.5], "max_samples": [0.6, 1.0],
        "criterion": ["absolute_error", "friedman_mse"],
    }
    args = (*frames, PRESETS["encoded"](ROLES), "random_forest", space, "forest")
    fitted = []
    plain = training.TreeForest._fit
    monkeypatch.setattr(training.TreeForest, "_fit", lambda *a: fitted.append(1) or plain(*a))
    shared = training.search(*args)
    assert not fitted and len(shared) == 16
    monkeypatch.setattr(training, "scored_together", lambda *a: None)
    single = training.search(*args)
    assert len(fitted) == 16
    for a, b in zip(shared, single, strict=True):
        assert a.params == b.params and a.metrics.keys() == b.metrics.keys() and a.seed == b.seed
        for m in a.metrics:
            if a.metrics[m] is None or b.metrics[m] is None:
                # a forest that predicts one value: single fits add up rounded parts of it
                assert m.endswith("spearman")
            else:
                assert a.metrics[m] == pytest.approx(b.metrics[m], rel=1e-6, abs=0.02 if m.endswith("spearman") else 1e-9), (a.params, m)
    assert len({r.metrics["val_mse"] for r in shared}) > 8


def test_the_trial_table_leaves_no_setting_out(monkeypatch):
    """The query searched 3 of 10,000 forests and 100 of 270 linear regressors."""
    from formline.plans import queries

    asked = {}
    monkeypatch.setattr(queries, "_frames", lambda spark, sf_dir: (None, None, None))
    monkeypatch.setattr(queries, "fresh_path", lambda spark, label: "")
    monkeypatch.setattr(queries.training, "search", lambda *a, **k: asked.update({a[6]: training.search_points(a[5], k.get("n_trials"), 42)}) or [])
    monkeypatch.setattr(queries.trials, "append_trials", lambda *a: None)
    monkeypatch.setattr(queries.trials, "read_trials", lambda *a: (_ for _ in ()).throw(KeyError("read")))
    with pytest.raises(KeyError):
        queries.QUERIES["trial_table"](None, "")
    assert {k: len(v) for k, v in asked.items()} == {"svr": 270, "forest": 10_000}
