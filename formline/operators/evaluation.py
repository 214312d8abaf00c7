"""Scores of predictions against labels: one-pass metrics, rank correlation, trend line."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formline.session import cut_lineage

from formline.functions.metrics import REGRESSION

Metric = Callable[[Column, Column], Column]
RANK_ROWS = 1_000_000
MAX_RANGES = 10_000


def regression_metrics(
    df: DataFrame,
    label: str,
    prediction: str,
    by: Sequence[str] = (),
    metrics: Mapping[str, Metric] = REGRESSION,
) -> DataFrame:
    """One row per group with a column per metric, from a single aggregation."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return df.groupBy(*by).agg(*[build(y, p).alias(m) for m, build in metrics.items()])


def stage_metrics(
    df: DataFrame,
    label: str,
    prediction: str,
    stage: str = "stage",
    metrics: Mapping[str, Metric] = REGRESSION,
) -> DataFrame:
    """Long form (stage, metric, value), metrics named ``{stage}_{metric}``."""
    wide = regression_metrics(df, label, prediction, [stage], metrics)
    long = wide.unpivot([stage], list(metrics), "_name", "value")
    return long.select(
        F.col(stage).alias("stage"),
        F.concat_ws("_", F.col(stage), F.col("_name")).alias("metric"),
        "value",
    )


def average_ranks(
    df: DataFrame,
    column: str,
    out: str = "rank",
    by: Sequence[str] = (),
    rows_per_range: int = RANK_ROWS,
) -> DataFrame:
    """(``by``, value, ``out``): the average rank of each distinct value of a numeric column.

    Above ``rows_per_range`` rows the ordering is spread over ranges of about that many.
    """
    rows = df.select(
        *by, F.col(column).cast("double").alias("value"), F.lit(1).alias("_n")
    ).where(F.col("value").isNotNull())
    (borders,) = _range_borders(rows, ["value"], rows.count(), rows_per_range)
    return _ranked_values(rows, by, borders, out)


def _ranked_values(
    rows: DataFrame, by: Sequence[str], borders: Sequence[float], out: str
) -> DataFrame:
    """Average ranks of ``value``, which occurs ``_n`` times per row.

    Equal values are counted before anything is ordered. The distinct values are then cut into
    ranges at ``borders``; a running count inside each range plus the total of the ranges below
    gives the rank, so no task orders more than one range.
    """
    values = rows.groupBy(*by, "value").agg(F.sum("_n").alias("_n"))
    running = (Window.unboundedPreceding, Window.currentRow)
    average = -(F.col("_n") - 1) / 2
    if not borders:
        # Few values: ordered in one task per group.
        upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("value").rowsBetween(*running))
        return values.select(*by, "value", (upto + average).alias(out))
    ranged = Bucketizer(
        splits=[-math.inf, *borders, math.inf], inputCol="value", outputCol="_range"
    ).transform(values)
    below = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # At most MAX_RANGES rows per group.
    offsets = (
        ranged.groupBy(*by, "_range")
        .agg(F.sum("_n").alias("_total"))
        .select(
            *by, "_range", F.coalesce(F.sum("_total").over(below), F.lit(0)).alias("_below")
        )
    )
    inside = Window.partitionBy(*by, "_range").orderBy("value").rowsBetween(*running)
    return (
        ranged.withColumn("_upto", F.sum("_n").over(inside))
        .join(offsets if by else F.broadcast(offsets), [*by, "_range"])
        .select(*by, "value", (F.col("_below") + F.col("_upto") + average).alias(out))
    )


def _range_borders(
    df: DataFrame, columns: Sequence[str], n_rows: int, rows_per_range: int
) -> list[list[float]]:
    """Per column, borders that leave about ``rows_per_range`` rows, hence no more values, between.

    Quantiles come from sketches of a plain scan. A value with more rows than that lies between
    equal borders, which fall into one; counted values make it a single row.
    """
    n_ranges = min(math.ceil(n_rows / rows_per_range), MAX_RANGES)
    if n_ranges <= 1:
        return [[] for _ in columns]
    shares = [i / n_ranges for i in range(1, n_ranges)]
    cuts = df.approxQuantile(list(columns), shares, 0.1 / n_ranges)
    return [sorted({c for c in column if math.isfinite(c)}) for column in cuts]


def spearman(
    df: DataFrame,
    label: str,
    prediction: str,
    out: str = "rho",
    by: Sequence[str] = (),
    rows_per_range: int = RANK_ROWS,
) -> DataFrame:
    """Spearman's rank correlation with ties averaged, one row in all or per group of ``by``.

    Rows are first counted per (label, prediction) pair; the counts are checkpointed, so ``df`` is
    read once. Ranks meet the pairs by value; each rank table has one row per value, so only the
    pair side of those joins can be skewed, which Spark splits at run time. ``rows_per_range`` as in
    :func:`average_ranks`.
    """
    rows = df.select(
        *by,
        F.col(label).cast("double").alias("_y"),
        F.col(prediction).cast("double").alias("_p"),
    ).where(F.col("_y").isNotNull() & F.col("_p").isNotNull())
    pairs = cut_lineage(rows.groupBy(*by, "_y", "_p").agg(F.count(F.lit(1)).alias("_c")))
    n_rows, n_pairs = pairs.agg(F.coalesce(F.sum("_c"), F.lit(0)), F.count(F.lit(1))).first()
    borders = _range_borders(pairs, ["_y", "_p"], n_pairs, rows_per_range)
    ranked = pairs
    for column, own, rank in zip(("_y", "_p"), borders, ("_ry", "_rp"), strict=True):
        values = pairs.select(*by, F.col(column).alias("value"), F.col("_c").alias("_n"))
        ranks = _ranked_values(values, by, own, rank).withColumnRenamed("value", column)
        ranked = ranked.join(ranks, [*by, column])
    # The mean of average ranks is (n + 1) / 2 whatever the ties.
    if by:
        ranked = ranked.join(pairs.groupBy(*by).agg(F.sum("_c").alias("_size")), [*by])
        middle = (F.col("_size") + 1) / 2
    else:
        middle = F.lit((n_rows + 1) / 2)
    dy, dp = F.col("_ry") - middle, F.col("_rp") - middle
    return ranked.groupBy(*by).agg(
        F.try_divide(
            F.sum(F.col("_c") * dy * dp),
            F.sqrt(F.sum(F.col("_c") * dy * dy) * F.sum(F.col("_c") * dp * dp)),
        ).alias(out)
    )


def ols_trend(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """Least-squares line of prediction on label, its R², and the ends of the identity line."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return df.groupBy(*by).agg(
        F.regr_slope(p, y).alias("slope"),
        F.regr_intercept(p, y).alias("intercept"),
        F.regr_r2(p, y).alias("r2"),
        F.least(F.min(y), F.min(p)).alias("lo"),
        F.greatest(F.max(y), F.max(p)).alias("hi"),
    )


def scatter_points(
    df: DataFrame, label: str, prediction: str, key: Sequence[str] = ()
) -> DataFrame:
    """Every (label, prediction) point, beside its ``key``. For large tables see :func:`scatter_counts`."""
    return df.select(*key, label, prediction)


def scatter_counts(
    df: DataFrame, label: str, prediction: str, bins: int = 100
) -> DataFrame:
    """(x_bin, y_bin, n): all points counted on a grid of ``bins`` by ``bins`` over their range.

    Bins are numbered from 0; the last one includes the largest value. Rows that lack a value of
    the two have bin NULL there, so the counts add up to the rows.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    ends = df.agg(F.min(y), F.max(y), F.min(p), F.max(p)).toDF("y_lo", "y_hi", "p_lo", "p_hi")

    def bin_of(value: Column, axis: str) -> Column:
        lo, hi = (ends.select(f"{axis}_{end}").scalar() for end in ("lo", "hi"))
        place = F.floor((value - lo) / ((hi - lo) / bins)).cast("int")
        binned = F.when(hi > lo, F.least(place, F.lit(bins - 1))).otherwise(0)
        return F.when(value.isNotNull(), binned)

    return df.groupBy(bin_of(y, "y").alias("x_bin"), bin_of(p, "p").alias("y_bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
