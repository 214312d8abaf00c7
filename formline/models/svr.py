"""Linear support-vector regression, fitted in passes over the distributed rows.

Spark has no such regressor. The objective, with the intercept penalised like a weight, is

    |w|^2 / 2 + C * sum(max(0, |y - w.x| - epsilon)).

The loss equals (|r - epsilon| + |r + epsilon|) / 2 - epsilon, and an absolute value lies below
the parabola that touches it at the last residual. Minimising those parabolas instead is a
weighted least-squares step that never raises the objective (a majorise-minimise scheme). A step
needs one pass: each partition adds up its weighted cross products in numpy, the sums are added in
Spark, and only the final sums, whose size depends on the number of features, reach the driver.
Fits of several settings share their passes: the products of the features are formed once a row and
weighted for all settings together, and a setting that has settled leaves.

Rows of more than ``DENSE_WIDTH`` features travel as they are stored, sparse or dense. There the objective is
minimised by a limited-memory quasi-Newton method on smoothed absolute values, whose width shrinks from round
to round; a pass adds up one gradient, so nothing of the square of the width is ever held.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasTol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline.operators.evaluation import RANK_ROWS, average_ranks
from formline.session import rows_within

NEAR_ZERO = 1e-6
DIRECT_PARTIALS = 64
#: Features up to which the squares of the width are summed, a few megabytes per task.
DENSE_WIDTH = 512
#: Numbers that a step over rows may hold.
STEP_NUMBERS = 4_000_000
#: Numbers of all partial sums that come to the driver at once.
DIRECT_NUMBERS = 16_000_000
#: Gradients that the quasi-Newton method remembers.
MEMORY = 10
#: Rows whose predictions are sorted together before they are shuffled, and ranges of a model's predictions at most.
RUN_ROWS = 32_768
MAX_RANGES = 1_000
#: Widths of the smoothing, as shares of the mean loss.
SMOOTHING = (0.3, 0.1, 0.03, 0.01, 0.003, 0.001, 0.0003)


def _partial_sums(weights: np.ndarray, epsilons: np.ndarray):
    """A function from record batches (x, y) to one row of sums, for ``mapInArrow``.

    ``weights`` has a row per setting. Per setting the sums are the upper half of the weighted cross products,
    the weighted targets and the loss.
    """
    n_settings, width = weights.shape
    upper = np.triu_indices(width)
    # rows whose products, and residuals in all settings, are held at a time
    step = max(1, STEP_NUMBERS // (len(upper[0]) + 4 * n_settings))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, target, loss = np.zeros((n_settings, len(upper[0]))), np.zeros(weights.shape), np.zeros(n_settings)
        for batch in batches:
            whole_y = batch.column("y").to_numpy(zero_copy_only=False)
            whole_x = np.ones((len(whole_y), width))
            if width > 1:
                whole_x[:, :-1] = batch.column("x").flatten().to_numpy().reshape(len(whole_y), width - 1)
            for at in range(0, len(whole_y), step):
                x, y = whole_x[at : at + step], whole_y[at : at + step, None]
                residual = y - x @ weights.T
                above = 0.5 / np.maximum(np.abs(residual - epsilons), NEAR_ZERO)
                below = 0.5 / np.maximum(np.abs(residual + epsilons), NEAR_ZERO)
                gram += (above + below).T @ (x[:, upper[0]] * x[:, upper[1]])
                target += (above * (y - epsilons) + below * (y + epsilons)).T @ x
                loss += np.maximum(np.abs(residual) - epsilons, 0.0).sum(axis=0)
        yield _as_batch(np.concatenate([gram, target, loss[:, None]], axis=1).ravel())

    return add_up


def _sparse_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of all entries of the vectors of a batch (``at`` is null for dense ones)."""
    values, at = batch.column("x"), batch.column("at")
    sizes = pc.list_value_length(values).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(batch.num_rows), sizes)
    dense = pc.is_null(at).to_numpy(zero_copy_only=False)
    features = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    features[~dense[rows]] = at.drop_null().flatten().to_numpy()
    return rows, features, values.flatten().to_numpy()


def _partial_gradient(weights: np.ndarray, epsilon: float, smooth: float):
    """As :func:`_partial_sums`, for one setting and any vectors: gradient, smoothed loss and loss."""
    width = len(weights)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient, smoothed, loss = np.zeros(width), 0.0, 0.0
        for batch in batches:
            rows, features, values = _sparse_rows(batch)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            residual = y - np.bincount(rows, weights[features] * values, len(y)) - weights[-1]
            over, under = np.hypot(residual - epsilon, smooth), np.hypot(residual + epsilon, smooth)
            slope = -0.5 * ((residual - epsilon) / over + (residual + epsilon) / under)
            gradient += np.bincount(features, slope[rows] * values, width)
            gradient[-1] += slope.sum()
            smoothed += (0.5 * (over + under) - epsilon).sum()
            loss += np.maximum(np.abs(residual) - epsilon, 0.0).sum()
        yield _as_batch(np.concatenate([gradient, [smoothed, loss]]))

    return add_up


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            rows = batch.column("sums").flatten().to_numpy().reshape(batch.num_rows, -1)
            total = rows.sum(axis=0) + (0.0 if total is None else total)
    if total is not None:
        yield _as_batch(total)


def _as_batch(sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.float64()))], ["sums"])


def gathered(batches: Iterator[pa.RecordBatch], n_rows: int) -> Iterator[pa.Table]:
    """The rows of ``batches`` in tables of ``n_rows``, the last of which may have fewer."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while sum(b.num_rows for b in held) + batch.num_rows >= n_rows:
            wanted = n_rows - sum(b.num_rows for b in held)
            yield pa.Table.from_batches([*held, batch.slice(0, wanted)])
            held, batch = [], batch.slice(wanted)
        if batch.num_rows:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


class _SvrColumns(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    pass


class LinearSVR(
    Estimator, _SvrColumns, HasMaxIter, HasTol, DefaultParamsReadable, DefaultParamsWritable
):
    """``epsilon`` is the width without loss, ``C`` the weight of the loss against the penalty."""

    epsilon = Param(Params._dummy(), "epsilon", "width without loss", TypeConverters.toFloat)
    C = Param(Params._dummy(), "C", "weight of the loss", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol: str = "features",
        labelCol: str = "label",
        predictionCol: str = "prediction",
        epsilon: float = 0.0,
        C: float = 1.0,
        tol: float = 1e-4,
        maxIter: int = 50,
    ):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(
            featuresCol="features",
            labelCol="label",
            predictionCol="prediction",
            epsilon=0.0,
            C=1.0,
            tol=1e-4,
            maxIter=50,
        )

    def _fit(self, df: DataFrame) -> LinearSVRModel:
        return fit_together([self], df)[0]

    def _model(self, weights: np.ndarray, history: list[float], settled: bool) -> LinearSVRModel:
        return LinearSVRModel(
            featuresCol=self.getFeaturesCol(),
            predictionCol=self.getPredictionCol(),
            coefficients=weights[:-1].tolist(),
            intercept=float(weights[-1]),
            objectiveHistory=history,
            converged=bool(settled),
        )


def fit_together(estimators: Sequence[LinearSVR], df: DataFrame) -> list[LinearSVRModel]:
    """A model per estimator, as if each was fitted by itself, in as many passes as the slowest needs.

    The estimators share their columns.
    """
    one = estimators[0]
    features, label = F.col(one.getFeaturesCol()), F.col(one.getLabelCol()).cast("double").alias("y")
    known = df.where(F.col(one.getLabelCol()).isNotNull())
    first = known.select(features.alias("v")).first()
    if first is None:
        raise ValueError("no rows to fit")
    width = first["v"].size + 1
    if width > DENSE_WIDTH:
        parts = F.unwrap_udt(features)
        rows = known.select(parts["values"].alias("x"), parts["indices"].alias("at"), label).persist()
    else:
        rows = known.select(vector_to_array(features).alias("x"), label).persist()
    try:
        if width > DENSE_WIDTH:
            return [_fit_wide(e, rows, width) for e in estimators]
        return _fit_dense(estimators, rows, width)
    finally:
        rows.unpersist()


def _fit_dense(estimators: Sequence[LinearSVR], rows: DataFrame, width: int) -> list[LinearSVRModel]:
    """Estimators that differ only in when they stop go the same way, which is gone once for all of them."""
    settings = [(e.getOrDefault(e.epsilon), e.getOrDefault(e.C)) for e in estimators]
    ways = list(dict.fromkeys(settings))
    way = [ways.index(s) for s in settings]
    epsilons, costs = np.array(ways).T
    weights = np.zeros((len(ways), width))
    kept, lowest = np.zeros((len(estimators), width)), np.full(len(estimators), np.inf)
    history: list[list[float]] = [[] for _ in estimators]
    settled = [False] * len(estimators)
    upper = np.triu_indices(width)
    active = list(range(len(estimators)))
    while active:
        asked = sorted({way[k] for k in active})
        sums = dict(zip(asked, _added(rows, _partial_sums(weights[asked], epsilons[asked])).reshape(len(asked), -1), strict=True))
        going = []
        for k in active:
            own = weights[way[k]]
            objective = float(0.5 * own @ own + costs[way[k]] * sums[way[k]][-1])
            history[k].append(objective)
            settled[k] = bool(lowest[k] - objective <= estimators[k].getTol() * abs(objective))
            if objective < lowest[k]:
                kept[k], lowest[k] = own, objective
            if not settled[k] and len(history[k]) <= estimators[k].getMaxIter():
                going.append(k)
        for w in {way[k] for k in going}:
            gram = np.zeros((width, width))
            gram[upper] = sums[w][: len(upper[0])]
            gram += np.triu(gram, 1).T
            weights[w] = np.linalg.solve(np.eye(width) + costs[w] * gram, costs[w] * sums[w][len(upper[0]) : -1])
        active = going
    return [e._model(kept[k], history[k], settled[k]) for k, e in enumerate(estimators)]


def _fit_wide(estimator: LinearSVR, rows: DataFrame, width: int) -> LinearSVRModel:
    """By a limited-memory quasi-Newton method, on less and less smoothed absolute values."""
    epsilon, cost, tol = (estimator.getOrDefault(p) for p in (estimator.epsilon, estimator.C, estimator.tol))
    passes, history = 0, []
    best, lowest = np.zeros(width), np.inf
    scale = None

    def value(w: np.ndarray, smooth: float) -> tuple[float, np.ndarray]:
        nonlocal passes, best, lowest, scale
        sums = _added(rows, _partial_gradient(w, epsilon, smooth))
        passes += 1
        objective = float(0.5 * w @ w + cost * sums[-1])
        history.append(objective)
        if objective < lowest:
            best, lowest = w, objective
        scale = sums[-1] if scale is None else scale
        return float(0.5 * w @ w + cost * sums[-2]), w + cost * sums[:-2]

    n_rows = rows.count()
    value(best, 1.0)  # the loss of no weights tells the scale of the labels
    settled = False
    for share in SMOOTHING:
        smooth = max(share * scale / max(n_rows, 1), NEAR_ZERO)
        before = lowest
        quiet = _descend(lambda w, s=smooth: value(w, s), best, tol, lambda: passes <= estimator.getMaxIter())
        settled = quiet and before - lowest <= tol * abs(lowest)
        if settled or passes > estimator.getMaxIter():
            break
    return estimator._model(best, history, settled)


def _descend(value, start: np.ndarray, tol: float, allowed) -> bool:
    """Quasi-Newton steps from ``start`` until they gain less than a tenth of ``tol``; False if not ``allowed`` to go on."""
    w = start
    f, g = value(w)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    while allowed():
        direction = -_scaled(g, steps)
        if direction @ g >= 0:
            steps, direction = [], -g
        rate = 1.0 if steps else min(1.0, 1.0 / max(np.abs(g).max(), 1e-12))
        while True:
            new = w + rate * direction
            f_new, g_new = value(new)
            if f_new <= f + 1e-4 * rate * (direction @ g) or rate < 1e-10 or not allowed():
                break
            rate *= 0.4
        gained = f - f_new
        if gained > 0:
            moved, turned = new - w, g_new - g
            if moved @ turned > 1e-12 * (turned @ turned):
                steps = [*steps[1 - MEMORY :], (moved, turned)] if len(steps) >= MEMORY else [*steps, (moved, turned)]
            w, f, g = new, f_new, g_new
        if gained <= 0.1 * tol * abs(f):
            return True
    return False


def _scaled(g: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The gradient times the inverse curvature that the remembered steps tell."""
    q, shares = g.copy(), []
    for moved, turned in reversed(steps):
        share = (moved @ q) / (moved @ turned)
        shares.append(share)
        q -= share * turned
    if steps:
        moved, turned = steps[-1]
        q *= (moved @ turned) / (turned @ turned)
    for (moved, turned), share in zip(steps, reversed(shares), strict=True):
        q += (share - (turned @ q) / (moved @ turned)) * moved
    return q


def _added(rows: DataFrame, add_up) -> np.ndarray:
    """The sums that ``add_up`` makes of each partition, added up in Spark where these are many or long."""
    partials = rows.mapInArrow(add_up, "sums array<double>")
    length = len(next(add_up(iter(()))).column("sums")[0])
    direct = max(1, min(DIRECT_PARTIALS, DIRECT_NUMBERS // length))
    if rows.rdd.getNumPartitions() > direct:
        partials = partials.repartition(direct).mapInArrow(_sum_rows, "sums array<double>")
    table = partials.toArrow().column("sums").combine_chunks()
    return table.flatten().to_numpy().reshape(len(table), -1).sum(axis=0)


def score_together(
    models: Sequence[LinearSVRModel], df: DataFrame, rank: bool = True, rows_per_range: int = RANK_ROWS
) -> list[dict[str, float | None]]:
    """Per model ``{stage}_{metric}`` of mse, rmse, mae, r2 and, with ``rank``, spearman.

    ``df`` has stage, label and features. Predictions leave a task as sorted arrays, cut at borders of about
    ``rows_per_range`` values, equal ones once with their number and the sum of their rows' label ranks: one shuffle brings
    the values of a range together, and of each range only a few sums are left. Labels are ranked once for all models.
    Borders come from a sample of rows, which decides nothing but where ranges end.
    """
    label = F.col("label").cast("double")
    rows = df.select("stage", label.alias("y"), vector_to_array(F.col(models[0].getFeaturesCol())).alias("x"))
    told = {r["stage"]: r for r in rows.groupBy("stage").agg(F.count("y").alias("n"), F.var_pop("y").alias("spread")).collect()}
    weights = np.array([[*m.getOrDefault(m.coefficients), m.getOrDefault(m.intercept)] for m in models])
    # models of the same weights are scored once
    weights, which = np.unique(weights, axis=0, return_inverse=True)
    borders: dict[str, np.ndarray] = {}
    if rank:
        ranks = average_ranks(rows, "y", "r", ["stage"], rows_per_range).withColumnRenamed("value", "y")
        few = rows_within(ranks)
        rows = rows.join(ranks if few is None else F.broadcast(few), ["stage", "y"], "left")
        borders = {s: _borders(rows.where(F.col("stage") == s), r["n"], weights, rows_per_range) for s, r in told.items()}
    else:
        rows = rows.withColumn("r", F.lit(0.0))
    middles = {s: (r["n"] + 1) / 2 for s, r in told.items()}
    runs = rows.where("y is not null").mapInArrow(_runs(weights, borders, middles), "stage string, model int, part int, p binary, n binary, r binary")
    parts = runs.groupBy("stage", "model", "part").applyInArrow(_run_sums, "stage string, model int, part int, sums array<double>")
    found: dict[tuple[str, int], dict[int, list[float]]] = {}
    for row in parts.collect():
        found.setdefault((row["stage"], row["model"]), {})[row["part"]] = row["sums"]
    scores = []
    for model in which.ravel():
        own: dict[str, float | None] = {}
        for stage, r in told.items():
            sums = found.get((stage, int(model)))
            mse = mae = r2 = rho = None
            if sums is not None:
                mse, mae = sums[-1][0] / r["n"], sums[-1][1] / r["n"]
                r2 = 1 - mse / r["spread"] if r["spread"] > 0 else None
                rho = _rho([sums[k] for k in sorted(sums) if k >= 0], sums[-1][2], middles[stage]) if rank else None
            metrics = {"mse": mse, "rmse": None if mse is None else mse**0.5, "mae": mae, "r2": r2}
            # without known labels there is nothing to rank
            own |= {f"{stage}_{m}": v for m, v in (metrics | ({"spearman": rho} if rank and sums is not None else {})).items()}
        scores.append(own)
    return scores


def _borders(rows: DataFrame, n_rows: int, weights: np.ndarray, rows_per_range: int) -> np.ndarray:
    """A line of borders per model, which cut the predictions of a stage into ranges of about so many rows."""
    wanted = min(-(-n_rows // rows_per_range), MAX_RANGES)
    if wanted <= 1:
        return np.zeros((len(weights), 0))
    size = max(wanted, min(max(20_000, 100 * wanted), STEP_NUMBERS // weights.shape[1]))
    drawn = rows.where("y is not null").sample(min(1.0, size / n_rows), seed=7).limit(2 * size).select("x").toArrow().column("x")
    x = drawn.combine_chunks().flatten().to_numpy().reshape(len(drawn), -1).T
    shares = np.arange(1, wanted) / wanted
    cuts = [np.quantile(_predicted(x, w), shares, method="nearest") if x.size else np.zeros(wanted - 1) for w in weights]
    return np.array(cuts)


def _predicted(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Predictions of rows, a line of ``x`` per feature: added up in the order of ``LinearSVRModel``, to the last bit,
    so that rows that tie there tie here."""
    p = np.full(x.shape[1], w[-1])
    for line, weight in zip(x, w[:-1], strict=True):
        p += line * weight
    return p


def _runs(weights: np.ndarray, borders: dict[str, np.ndarray], middles: dict[str, float]):
    """A function from record batches (stage, y, x, r) to runs of predictions and, as part -1, sums of errors and ranks."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        errors: dict[str, np.ndarray] = {}
        for batch in gathered(batches, RUN_ROWS):
            stages = batch.column("stage").to_numpy()
            for stage in dict.fromkeys(stages):
                own = batch.filter(pc.equal(batch.column("stage"), stage))
                y, r = own.column("y").to_numpy(), own.column("r").to_numpy() - middles[stage]
                x = np.ascontiguousarray(own.column("x").combine_chunks().flatten().to_numpy().reshape(own.num_rows, -1).T)
                out: list[tuple] = []
                told = errors.setdefault(stage, np.zeros((len(weights), 3)))
                for model, w in enumerate(weights):
                    p = _predicted(x, w)
                    told[model] += [((y - p) ** 2).sum(), np.abs(y - p).sum(), (r * r).sum()]
                    if not borders:
                        continue
                    order = np.argsort(p)
                    p, n, ranks = _once(p[order], np.ones(len(p)), r[order])
                    cuts = np.searchsorted(p, borders[stage][model], "right")
                    for part, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(p)], strict=True)):
                        if b > a:
                            # mostly values occur once, which is not written down
                            times = b"" if (n[a:b] == 1).all() else n[a:b].tobytes()
                            out.append((stage, model, part, p[a:b].tobytes(), times, ranks[a:b].tobytes()))
                if out:
                    yield _run_batch(out)
        out = [(s, model, -1, told.tobytes(), b"", b"") for s, sums in errors.items() for model, told in enumerate(sums)]
        if out:
            yield _run_batch(out)

    return tasks


def _run_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["stage", "model", "part", "p", "n", "r"])


def _once(p: np.ndarray, n: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted values once each, with what their ``n`` and ``r`` add up to."""
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) & ~(np.isnan(p[1:]) & np.isnan(p[:-1]))
    if new.all():
        return p, n, r
    first = np.flatnonzero(new)
    return p[first], np.add.reduceat(n, first), np.add.reduceat(r, first)


def _run_sums(key: tuple, table: pa.Table) -> pa.Table:
    """Of one range: rows, and sums of local ranks, their squares, label ranks, and local times label ranks."""
    stage, model, part = (k.as_py() for k in key)
    p, n, r = ([np.frombuffer(b.as_buffer()) for b in table.column(c)] for c in ("p", "n", "r"))
    if part < 0:
        sums = np.sum(p, axis=0)
    else:
        n = [np.ones(len(own)) if not len(times) else times for own, times in zip(p, n, strict=True)]
        p, n, r = (np.concatenate(c) for c in (p, n, r))
        order = np.argsort(p, kind="stable")
        p, n, r = _once(p[order], n[order], r[order])
        local = n.cumsum() - (n - 1) / 2
        sums = np.array([n.sum(), (n * local).sum(), (n * local * local).sum(), r.sum(), (local * r).sum()])
    kinds = zip(([stage], [model], [part], [sums]), (pa.string(), pa.int32(), pa.int32(), pa.list_(pa.float64())), strict=True)
    return pa.table([pa.array(v, t) for v, t in kinds], ["stage", "model", "part", "sums"])


def _rho(ranges: list[list[float]], spread: float, middle: float) -> float | None:
    """The rank correlation from the sums of the ranges, lowest first, and the squares of the label ranks."""
    below = both = own = 0.0
    for n, local, squares, ranks, product in ranges:
        at = below - middle
        both += at * ranks + product
        own += at * at * n + 2 * at * local + squares
        below += n
    whole = (spread * own) ** 0.5
    return both / whole if whole else None


class LinearSVRModel(
    Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable
):
    coefficients = Param(
        Params._dummy(), "coefficients", "weight per feature", TypeConverters.toListFloat
    )
    intercept = Param(Params._dummy(), "intercept", "constant term", TypeConverters.toFloat)
    objectiveHistory = Param(
        Params._dummy(), "objectiveHistory", "objective per pass", TypeConverters.toListFloat
    )
    converged = Param(
        Params._dummy(), "converged", "the last pass gained less than tol", TypeConverters.toBoolean
    )

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol: str = "features",
        predictionCol: str = "prediction",
        coefficients: list[float] = (),
        intercept: float = 0.0,
        objectiveHistory: list[float] = (),
        converged: bool = False,
    ):
        super().__init__()
        self._set(
            featuresCol=featuresCol,
            predictionCol=predictionCol,
            coefficients=list(coefficients),
            intercept=intercept,
            objectiveHistory=list(objectiveHistory),
            converged=converged,
        )

    def getConverged(self) -> bool:
        """Whether the fit ended because it had settled, and not at the limit of passes."""
        return self.getOrDefault(self.converged)

    def getHistory(self) -> list[float]:
        """The objective after each pass."""
        return self.getOrDefault(self.objectiveHistory)

    def _transform(self, df: DataFrame) -> DataFrame:
        if len(self.getOrDefault(self.coefficients)) >= DENSE_WIDTH:
            return df.withColumn(self.getPredictionCol(), self._wide_product(F.unwrap_udt(F.col(self.getFeaturesCol()))))
        weights = F.array(*[F.lit(w) for w in self.getOrDefault(self.coefficients)])
        products = F.zip_with(
            vector_to_array(F.col(self.getFeaturesCol())), weights, lambda x, w: x * w
        )
        return df.withColumn(
            self.getPredictionCol(),
            F.aggregate(products, F.lit(self.getOrDefault(self.intercept)), lambda a, b: a + b),
        )

    def _wide_product(self, parts: Column) -> Column:
        """The prediction from the stored parts of a vector, dense or sparse, batch by batch."""
        weights, intercept = np.array(self.getOrDefault(self.coefficients)), self.getOrDefault(self.intercept)

        @F.pandas_udf("double")
        def product(indices: pd.Series, values: pd.Series) -> pd.Series:
            pairs = zip(indices, values, strict=True)
            return pd.Series([intercept + float(v @ (weights if i is None else weights[i])) for i, v in pairs])

        return product(parts["indices"], parts["values"])
