"""Leakage-free features of an entity's earlier rows.

Every operator here has two plans. Where the caller knows that the rows of a group are bounded by
the calendar (one row per entity, period and step, say), plain windows over one shuffle are best.
Where nothing is known, groups are counted first and oversized ones are cut into runs of
consecutive rows, each of which carries the few earlier rows and the earlier sums it needs; no
task then holds more than a run, and the values are those of the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from formline.operators.joins import attach
from formline.session import rows_within

GROUP_ROWS = 1_000_000
MAX_RUNS = 4_096
SAMPLES_PER_RUN = 16
SEARCH_STRIDE = 64


def lagged_features(
    df: DataFrame,
    keys: Sequence[str],
    step: str,
    stats: Sequence[str],
    windows: Sequence[int] = (2, 4, 6),
    averages: bool = True,
    tiebreak: Sequence[str] = (),
    unique_steps: bool = False,
    max_group_rows: int | None = GROUP_ROWS,
    mean_prefix: str = "rolling_mean_",
    average_prefix: str = "gw_avg_",
) -> DataFrame:
    """Add lagged rolling means and, with ``averages``, lagged per-step averages of ``stats``.

    ``rolling_mean_{w}_{stat}`` is the mean of the non-null values in the previous ``w`` rows of
    the group, 0 when there are none. ``gw_avg_{stat}`` is the sum up to the previous row over
    that row's step number: 0 on the first row, NULL after a row whose value is missing.

    Rows of a group are ordered by ``step`` and ``tiebreak``; pass ``unique_steps`` if no group
    has two rows in a step. ``max_group_rows=None`` skips the search for oversized groups.
    """
    if not tiebreak and not unique_steps:
        raise ValueError("rows may share a step: give a tiebreak or state unique_steps")
    order = [step, *tiebreak]
    runs = None
    if max_group_rows is not None:
        runs = _cut_into_runs(df, keys, order, max_group_rows)
    if runs is None:
        spec = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns(
            _lagged_columns(
                spec, step, stats, windows, averages, mean_prefix, average_prefix, carried=False
            )
        )
    reach = max([1, *windows])
    whole = runs.unionByName(
        _carried_rows(runs, keys, order, stats, reach), allowMissingColumns=True
    )
    spec = Window.partitionBy(*keys, "_run").orderBy(*order)
    helpers = ["_run", "_hot", "_carried", *[f"_before_{s}" for s in stats]]
    return (
        whole.withColumns(
            _lagged_columns(
                spec, step, stats, windows, averages, mean_prefix, average_prefix, carried=True
            )
        )
        .where(F.col("_carried").isNull())
        .drop(*helpers)
    )


def _lagged_columns(
    spec: WindowSpec,
    step: str,
    stats: Sequence[str],
    windows: Sequence[int],
    averages: bool,
    mean_prefix: str,
    average_prefix: str,
    carried: bool,
) -> dict[str, Column]:
    earlier = spec.rowsBetween(Window.unboundedPreceding, -1)
    columns = {
        f"{mean_prefix}{w}_{s}": F.coalesce(
            F.avg(s).over(spec.rowsBetween(-w, -1)), F.lit(0.0)
        )
        for w in windows
        for s in stats
    }
    if not averages:
        return columns
    for s in stats:
        if carried:
            own = F.when(F.col("_carried").isNull(), F.col(s))
            total = F.coalesce(F.sum(own).over(earlier), F.lit(0)) + F.coalesce(
                F.max(f"_before_{s}").over(earlier), F.lit(0)
            )
        else:
            total = F.sum(s).over(earlier)
        columns[f"{average_prefix}{s}"] = F.when(
            F.lag(F.lit(1)).over(spec).isNull(), F.lit(0.0)
        ).when(
            F.lag(s).over(spec).isNotNull(),
            F.try_divide(total.cast("double"), F.lag(step).over(spec)),
        )
    return columns


def _cut_into_runs(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int
) -> DataFrame | None:
    """``df`` with a run number per row, or None when no group exceeds ``max_rows``.

    Borders between runs come from a hashed sample of each oversized group. They only steer the
    balance of the work: any borders give the same feature values.
    """
    hot = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > max_rows)
    )
    few = rows_within(hot, 10_000)
    if few is not None:
        if few.isEmpty():
            return None
        hot = F.broadcast(few)
    position = F.struct(*order)
    n_runs = F.least(F.ceil(F.col("_rows") / max_rows), F.lit(MAX_RUNS))
    every = F.greatest(
        F.lit(1), F.floor(F.col("_rows") / (n_runs * SAMPLES_PER_RUN))
    ).cast("long")
    sample = attach(df.select(*keys, *[c for c in order if c not in keys]), hot, keys).where(
        F.pmod(F.xxhash64(*keys, *order), every) == 0
    )
    borders = (
        sample.groupBy(*keys)
        .agg(F.sort_array(F.collect_set(position)).alias("_sample"))
        .select(
            *keys,
            F.filter("_sample", lambda _, i: i % SAMPLES_PER_RUN == SAMPLES_PER_RUN - 1).alias(
                "_borders"
            ),
        )
        .withColumn(
            "_strides",
            F.filter("_borders", lambda _, i: i % SEARCH_STRIDE == SEARCH_STRIDE - 1),
        )
    )
    strides = F.size(F.filter("_strides", lambda b: b <= position))
    rest = F.size(
        F.filter(
            F.slice("_borders", strides * SEARCH_STRIDE + 1, SEARCH_STRIDE),
            lambda b: b <= position,
        )
    )
    return (
        attach(df, borders, keys)
        .withColumn("_hot", F.col("_borders").isNotNull())
        .withColumn("_run", F.when(F.col("_hot"), strides * SEARCH_STRIDE + rest).otherwise(0))
        .drop("_borders", "_strides")
    )


def _carried_rows(
    runs: DataFrame, keys: Sequence[str], order: Sequence[str], stats: Sequence[str], reach: int
) -> DataFrame:
    """For each run of an oversized group, the ``reach`` rows before it and the sums up to it."""
    backwards = Window.partitionBy(*keys, "_run").orderBy(*[F.col(c).desc() for c in order])
    kept = [*order, *[s for s in stats if s not in order]]
    ends = (
        runs.where("_hot")
        .select(*dict.fromkeys([*keys, "_run", *kept]))
        .withColumn("_back", F.row_number().over(backwards))
        .groupBy(*keys, "_run")
        .agg(
            F.sort_array(
                F.collect_list(F.when(F.col("_back") <= reach, F.struct(*kept)))
            ).alias("_tail"),
            *[F.sum(s).alias(f"_sum_{s}") for s in stats],
        )
    )
    by_run = Window.partitionBy(*keys).orderBy("_run")
    previous = by_run.rowsBetween(-reach, -1)
    earlier = by_run.rowsBetween(Window.unboundedPreceding, -1)
    lead_in = F.flatten(F.collect_list("_tail").over(previous))
    return (
        ends.select(
            *keys,
            "_run",
            lead_in.alias("_lead_in"),
            *[F.sum(f"_sum_{s}").over(earlier).alias(f"_before_{s}") for s in stats],
        )
        .where(F.size("_lead_in") > 0)
        .select(
            *keys,
            "_run",
            *[f"_before_{s}" for s in stats],
            F.explode(
                F.slice("_lead_in", -F.least(F.size("_lead_in"), F.lit(reach)), F.lit(reach))
            ).alias("_row"),
        )
        .select(
            *keys,
            "_run",
            *[f"_before_{s}" for s in stats],
            *[F.col(f"_row.{c}").alias(c) for c in kept if c not in keys],
            F.lit(True).alias("_carried"),
            F.lit(True).alias("_hot"),
        )
    )


def period_totals(
    df: DataFrame, entity: str, period: str, label: str, out: str = "total"
) -> DataFrame:
    """Sum of ``label`` per entity and period; all-missing sums to 0."""
    return df.groupBy(entity, period).agg(F.coalesce(F.sum(label), F.lit(0)).alias(out))


def previous_period_total(
    df: DataFrame,
    entity: str,
    period: str,
    label: str,
    out: str = "previous_total",
    bounded: bool = False,
) -> DataFrame:
    """Add the entity's total of ``label`` over the last earlier period it appears in, else 0.

    ``bounded`` states that an entity's rows are few (calendar-bound): windows then do without a
    join. Otherwise totals are aggregated first and joined back, so a hot entity stays spread.
    ``period`` must be integral.
    """
    if bounded:
        total = F.coalesce(F.sum(label).over(Window.partitionBy(entity, period)), F.lit(0))
        before = (
            Window.partitionBy(entity)
            .orderBy(period)
            .rangeBetween(Window.unboundedPreceding, -1)
        )
        return (
            df.withColumn("_total", total)
            .withColumn(
                out,
                F.coalesce(F.max_by("_total", period).over(before), F.lit(0)).cast("double"),
            )
            .drop("_total")
        )
    by_period = Window.partitionBy(entity).orderBy(period)
    earlier = period_totals(df, entity, period, label, "_total").select(
        entity,
        period,
        F.coalesce(F.lag("_total").over(by_period), F.lit(0)).cast("double").alias(out),
    )
    return attach(df, earlier, [entity, period])


def distinct_steps(df: DataFrame, period: str, step: str) -> DataFrame:
    return df.select(period, step).distinct()


def close_gaps(
    df: DataFrame, period: str, step: str, out: str | None = None
) -> DataFrame:
    """Renumber steps so that consecutive steps of a period differ by one; a NULL step stays NULL.

    The ranking runs over the distinct steps only; facts meet the result in a join.
    """
    out = out or step
    whole = Window.partitionBy(period)
    mapped = distinct_steps(df, period, step).where(F.col(step).isNotNull()).select(
        period,
        step,
        (
            F.min(step).over(whole) + F.dense_rank().over(whole.orderBy(step)) - 1
        ).alias("_closed"),
    )
    joined = attach(df, mapped, [period, step])
    return joined.withColumn(out, F.col("_closed").cast(df.schema[step].dataType)).drop("_closed")


def drop_inactive(
    df: DataFrame, entity: str, stat: str, bounded: bool = False
) -> DataFrame:
    """Remove entities whose ``stat`` sums to 0, missing counting as 0.

    ``bounded`` as in :func:`previous_period_total`.
    """
    if bounded:
        total = F.coalesce(F.sum(stat).over(Window.partitionBy(entity)), F.lit(0))
        return df.withColumn("_activity", total).where(F.col("_activity") != 0).drop("_activity")
    idle = (
        df.groupBy(entity)
        .agg(F.coalesce(F.sum(stat), F.lit(0)).alias("_activity"))
        .where(F.col("_activity") == 0)
        .select(F.col(entity).alias("_idle"))
    )
    return df.join(idle, F.col(entity).eqNullSafe(F.col("_idle")), "left_anti")


def lost_periods(
    before: DataFrame, after: DataFrame, entity: str, period: str
) -> DataFrame:
    """(entity, period) pairs of ``before`` that ``after`` no longer has; empty when all is well."""
    return (
        before.select(entity, period)
        .distinct()
        .join(after.select(entity, period).distinct(), [entity, period], "left_anti")
    )
