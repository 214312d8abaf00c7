"""The trial table: one Parquet row per training run, ranked, kept or dropped by a metric."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

TRIAL_SCHEMA = (
    "run_id string, experiment string, seed long, "
    "params map<string,string>, metrics map<string,double>"
)

# Measures for which more is better.
HIGHER_IS_BETTER = ("r2", "rho", "spearman")


def trial_row(
    experiment: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    seed: int,
    run_id: str | None = None,
) -> Row:
    return Row(
        run_id=run_id or uuid.uuid4().hex,
        experiment=experiment,
        seed=int(seed),
        params={k: str(v) for k, v in params.items()},
        metrics={k: None if v is None else float(v) for k, v in metrics.items()},
    )


def trial_frame(spark: SparkSession, rows: Iterable[Row]) -> DataFrame:
    return spark.createDataFrame(list(rows), TRIAL_SCHEMA)


def append_trials(spark: SparkSession, rows: Iterable[Row], path: str) -> None:
    trial_frame(spark, rows).coalesce(1).write.mode("append").parquet(path)


def read_trials(spark: SparkSession, path: str, experiment: str | None = None) -> DataFrame:
    """All runs, or those of one experiment."""
    trials = spark.read.schema(TRIAL_SCHEMA).parquet(path)
    return trials if experiment is None else trials.where(F.col("experiment") == experiment)


def ascending_for(metric: str) -> bool:
    """Whether low values of ``metric`` are the good ones."""
    return not metric.endswith(HIGHER_IS_BETTER)


def _best_first(metric: str, ascending: bool | None) -> list[Column]:
    if ascending is None:
        ascending = ascending_for(metric)
    value = F.col("metrics")[metric]
    return [value.asc_nulls_last() if ascending else value.desc_nulls_last(), F.col("run_id")]


def _require(trials: DataFrame, metric: str) -> None:
    """Refuse to rank runs by a metric that none of them has; a table of runs is small."""
    if trials.where(F.col("metrics")[metric].isNotNull()).isEmpty():
        raise ValueError(f"no run has the metric {metric}")


def best_trial(trials: DataFrame, metric: str, ascending: bool | None = None) -> DataFrame:
    """The best run as one row; the direction follows the metric unless given.

    Runs without the metric come last; if all are, that is an error.
    """
    _require(trials, metric)
    return trials.orderBy(*_best_first(metric, ascending)).limit(1)


def trials_to_drop(
    trials: DataFrame, metric: str, keep: int = 25, ascending: bool | None = None
) -> DataFrame:
    """(run_id, value) of all runs but the best ``keep``; nothing is deleted.

    It is an error if no run has the metric. Only the kept runs are ordered, as a top-n; the rest
    follow by anti-join with them.
    """
    _require(trials, metric)
    kept = trials.orderBy(*_best_first(metric, ascending)).limit(keep).select("run_id")
    return trials.select("run_id", F.col("metrics")[metric].alias("value")).join(
        kept, "run_id", "left_anti"
    )
