"""Fitting, scoring and searching regressors on prepared tables."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from inspect import signature

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from formline.functions.columns import quoted
from formline.models.forests import scored_together
from formline.models.svr import LinearSVR, LinearSVRModel, fit_together, score_together
from formline.models.trees import AbsoluteBoosting, TreeForest
from formline.models.trials import trial_row
from formline.operators.assemble import union_all
from formline.operators.evaluation import spearman, stage_metrics

# The searched settings per regressor.
FOREST_SPACE = {
    "n_estimators": [50, 100, 150, 200, 250],
    "min_samples_split": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
    "max_features": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
    "max_samples": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
    "criterion": ["absolute_error", "friedman_mse"],
}
BOOSTING_SPACE = {
    "learning_rate": [0.1, 0.01, 0.001],
    "n_estimators": [400, 500, 600, 700, 800],
    "subsample": [0.1, 0.25, 0.4, 0.5, 0.6],
}
SVR_SPACE = {
    "epsilon": [0.0, 0.05, 0.1, 0.5, 1.0, 2.0, 3.0, 4.0, 5.0],
    "tol": [1e-2, 1e-1, 1e-4, 1e-3, 1e-5],
    "C": [0.01, 0.25, 1.0, 0.5, 0.1, 1.5],
}


def random_forest(
    n_estimators: int = 100,
    max_features: float = 1.0,
    max_samples: float = 1.0,
    min_samples_split: float = 0.0,
    criterion: str = "squared_error",
    max_depth: int = 5,
    seed: int = 42,
) -> Estimator:
    """A forest by ``criterion``: ``squared_error`` (Spark's own trees), ``friedman_mse`` or ``absolute_error``.

    A node is split if it holds ``min_samples_split`` of the rows. Spark's trees know a least share per child
    instead, which becomes half of it; Spark wants that below 0.5, so shares from 0.98 up all become 0.49 per
    child, and a search logs the value used as ``min_share_per_child``.
    """
    if criterion != "squared_error":
        return TreeForest(
            nTrees=n_estimators, maxFeatures=max_features, share=max_samples, minSplit=min_samples_split,
            criterion=criterion, maxDepth=max_depth, seed=seed,
        )
    return RandomForestRegressor(
        numTrees=n_estimators,
        featureSubsetStrategy=str(float(max_features)),
        subsamplingRate=max_samples,
        minWeightFractionPerNode=min(min_samples_split / 2, 0.49),
        maxDepth=max_depth,
        seed=seed,
    )


def boosted_trees(
    n_estimators: int = 100,
    learning_rate: float = 0.1,
    subsample: float = 1.0,
    max_depth: int = 3,
    leaves: str = "medians",
    seed: int = 42,
) -> Estimator:
    """Boosted trees on absolute error, whose leaves hold medians of the residuals.

    With ``leaves="means"`` Spark's own, whose leaves hold means of the residuals' signs; its node numbers are kept
    with the rows and these are checkpointed where the session has a folder for that.
    """
    if leaves == "medians":
        return AbsoluteBoosting(nTrees=n_estimators, rate=learning_rate, share=subsample, maxDepth=max_depth, seed=seed)
    return GBTRegressor(
        lossType="absolute",
        maxIter=n_estimators,
        stepSize=learning_rate,
        subsamplingRate=subsample,
        maxDepth=max_depth,
        cacheNodeIds=True,
        checkpointInterval=20,
        seed=seed,
    )


def linear_svr(
    epsilon: float = 0.0, C: float = 1.0, tol: float = 1e-4, max_iter: int = 50
) -> LinearSVR:
    return LinearSVR(epsilon=epsilon, C=C, tol=tol, maxIter=max_iter)


REGRESSORS: dict[str, Callable[..., Estimator]] = {
    "random_forest": random_forest,
    "boosted_trees": boosted_trees,
    "linear_svr": linear_svr,
}


def evaluate(model, frames: Mapping[str, DataFrame], rank: bool = True) -> DataFrame:
    """(stage, metric, value) of ``model`` on each named frame, one aggregation for all.

    ``rank`` adds the rank correlation. The scores are computed here, each row being predicted
    once, and come back as a local table of a few rows.
    """
    scored = union_all(
        [
            model.transform(df).select(F.lit(stage).alias("stage"), "label", "prediction")
            for stage, df in frames.items()
        ]
    ).persist()
    try:
        rows = stage_metrics(scored, "label", "prediction")
        if rank:
            rho = spearman(scored, "label", "prediction", "value", by=["stage"])
            name = F.concat("stage", F.lit("_spearman")).alias("metric")
            rows = rows.unionByName(rho.select("stage", name, "value"))
        return scored.sparkSession.createDataFrame(rows.collect(), rows.schema)
    finally:
        scored.unpersist()


def evaluate_together(models: Sequence[LinearSVRModel], frames: Mapping[str, DataFrame], rank: bool = True) -> list[dict[str, float]]:
    """Per model the metrics that :func:`evaluate` gives, from one scan of the frames."""
    rows = union_all([df.select(F.lit(stage).alias("stage"), "label", "features") for stage, df in frames.items()])
    return score_together(models, rows, rank)


def train_and_evaluate(
    train: DataFrame,
    val: DataFrame,
    test: DataFrame | None,
    stages: Sequence,
    estimator: Estimator,
    rank: bool = True,
) -> tuple[PipelineModel, DataFrame]:
    """The fitted pipeline (stages and regressor in one artifact) and its metrics per stage."""
    model = Pipeline(stages=[*stages, estimator]).fit(train)
    frames = {"train": train, "val": val}
    if test is not None:
        frames["test"] = test
    return model, evaluate(model, frames, rank)


def metrics_map(metrics: DataFrame) -> dict[str, float]:
    """A metrics table, a few rows by construction, as a map."""
    return {r["metric"]: r["value"] for r in metrics.collect()}


def chosen_metrics(metrics: Mapping[str, float], names: Sequence[str]) -> float | tuple:
    """The named metrics: a scalar if one, a tuple if several."""
    values = tuple(metrics[n] for n in names)
    return values[0] if len(values) == 1 else values


def score_table(
    model: PipelineModel, df: DataFrame, out: str = "pred_total_points"
) -> DataFrame:
    """``df`` as it was, whatever the stages scale or drop, with the prediction as ``out``."""
    whole = F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("_row")
    scored = model.transform(df.select("*", whole))
    return scored.select("_row.*", F.col("prediction").alias(out))


def search_points(
    space: Mapping[str, Sequence], n_trials: int | None, seed: int
) -> list[dict[str, object]]:
    """All settings of a grid, or ``n_trials`` of them drawn by ``seed``."""
    points = [dict(zip(space, values, strict=True)) for values in itertools.product(*space.values())]
    if n_trials is None or n_trials >= len(points):
        return points
    return random.Random(seed).sample(points, n_trials)


def _effective(estimator: Estimator) -> dict[str, object]:
    """Settings that Spark bounds, as they are really used."""
    if isinstance(estimator, RandomForestRegressor):
        return {"min_share_per_child": estimator.getMinWeightFractionPerNode()}
    return {}


def _outcome(model: Model) -> dict[str, float]:
    """How the fit itself ended, for regressors that tell."""
    if isinstance(model, LinearSVRModel):
        return {"converged": float(model.getConverged()), "passes": float(len(model.getHistory()))}
    return {}


def search(
    train: DataFrame,
    val: DataFrame,
    test: DataFrame | None,
    stages: Sequence,
    regressor: str,
    space: Mapping[str, Sequence],
    experiment: str,
    n_trials: int | None = None,
    seed: int = 42,
    parallelism: int = 4,
    rank: bool = True,
    fixed: Mapping[str, object] | None = None,
    models_dir: str | None = None,
) -> list[Row]:
    """Trial rows of one regressor over (part of) a grid.

    The feature stages are fitted once and their output is kept. Linear regressors of all settings are fitted
    in shared passes and scored in one scan. Forests of all settings share their trees where that is possible (see
    :mod:`formline.models.forests`) and no models are saved; of others several fits share the cluster at a time. ``fixed``
    are settings outside the grid. A regressor that draws numbers does
    so by ``seed``, the one that is logged. With ``models_dir`` each run's stages and model are
    saved there as one pipeline under its ``run_id``.
    """
    given = dict(fixed or {})
    if "seed" in signature(REGRESSORS[regressor]).parameters:
        given.setdefault("seed", seed)
    prepared = Pipeline(stages=list(stages)).fit(train)
    frames = {"train": train, "val": val} | ({} if test is None else {"test": test})
    ready = {
        name: prepared.transform(df).select("features", "label").persist()
        for name, df in frames.items()
    }

    def logged(point: dict[str, object], estimator: Estimator | None, model: Model | None, scores: dict[str, float]) -> Row:
        params = {"regressor": regressor, **point, **_effective(estimator)}
        row = trial_row(experiment, params, scores | _outcome(model), (given | point).get("seed", seed))
        if models_dir is not None:
            save_pipeline(PipelineModel([*prepared.stages, model]), f"{models_dir}/{row.run_id}")
        return row

    def run(point: dict[str, object]) -> Row:
        estimator = REGRESSORS[regressor](**(given | point))
        model = estimator.fit(ready["train"])
        return logged(point, estimator, model, metrics_map(evaluate(model, ready, rank)))

    try:
        if regressor == "linear_svr":
            points = search_points(space, n_trials, seed)
            estimators = [REGRESSORS[regressor](**(given | point)) for point in points]
            models = fit_together(estimators, ready["train"])
            scores = evaluate_together(models, ready, rank)
            return [logged(*trial) for trial in zip(points, estimators, models, scores, strict=True)]
        if regressor == "random_forest" and models_dir is None:
            points = search_points(space, n_trials, seed)
            plain = {k: p.default for k, p in signature(random_forest).parameters.items()}
            if (scores := scored_together(ready, [plain | given | point for point in points], rank)) is not None:
                return [logged(point, None, None, found) for point, found in zip(points, scores, strict=True)]
        with ThreadPoolExecutor(parallelism) as pool:
            task = inheritable_thread_target(train.sparkSession)(run)
            return list(pool.map(task, search_points(space, n_trials, seed)))
    finally:
        for df in ready.values():
            df.unpersist()


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
