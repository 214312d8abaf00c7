"""The prepare stage: facts to a feature table, ready for training or scoring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.functions.columns import columns_with_prefix
from formline.operators.windows import (
    GROUP_ROWS,
    drop_inactive,
    lagged_features,
    previous_period_total,
)


@dataclass(frozen=True)
class FeaturePlan:
    """Column roles and limits of a feature table.

    ``one_row_per_step`` states that an entity has at most one row per period and step, which
    bounds its rows by the calendar.
    """

    entity: str
    period: str
    step: str
    stats: Sequence[str]
    label: str
    base: Sequence[str]
    activity: str
    windows: Sequence[int] = (2, 4, 6)
    tiebreak: Sequence[str] = ()
    first_input_period: int | None = None
    first_output_period: int | None = None
    previous_total: str = "previous_total"
    prefix: str = "X_"
    one_row_per_step: bool = False


def featured_facts(facts: DataFrame, plan: FeaturePlan) -> DataFrame:
    """``facts`` with lagged features and previous totals, idle entities removed.

    The first input period feeds previous totals only; rows are kept from the first output period.
    """
    rows = facts
    if plan.first_input_period is not None:
        rows = rows.where(F.col(plan.period) >= plan.first_input_period)
    if plan.one_row_per_step:
        # One exchange on the entity serves all windows below.
        rows = rows.repartition(plan.entity)
    rows = lagged_features(
        rows,
        [plan.entity, plan.period],
        plan.step,
        plan.stats,
        plan.windows,
        tiebreak=plan.tiebreak,
        unique_steps=plan.one_row_per_step,
        max_group_rows=None if plan.one_row_per_step else GROUP_ROWS,
    )
    rows = previous_period_total(
        rows,
        plan.entity,
        plan.period,
        plan.label,
        plan.previous_total,
        bounded=plan.one_row_per_step,
    )
    if plan.first_output_period is not None:
        rows = rows.where(F.col(plan.period) >= plan.first_output_period)
    return drop_inactive(rows, plan.entity, plan.activity, bounded=plan.one_row_per_step)


def feature_columns(df: DataFrame, plan: FeaturePlan) -> list[str]:
    """Base columns, then running averages, then rolling means."""
    return [
        *plan.base,
        *columns_with_prefix(df, "gw_avg_"),
        *columns_with_prefix(df, "rolling_mean_"),
    ]


def feature_table(
    facts: DataFrame, plan: FeaturePlan, keep: Sequence[str] | None = None
) -> DataFrame:
    """Entity, prefixed features and label; ``keep`` names further columns to carry along."""
    return prefixed_features(featured_facts(facts, plan), plan, keep)


def prefixed_features(
    featured: DataFrame, plan: FeaturePlan, keep: Sequence[str] | None = None
) -> DataFrame:
    """The feature table's columns out of :func:`featured_facts`."""
    return featured.select(
        plan.entity,
        *(keep or []),
        *[F.col(c).alias(plan.prefix + c) for c in feature_columns(featured, plan)],
        plan.label,
    )
