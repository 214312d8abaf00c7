"""Regression measures as aggregate columns, so that one pass computes them all."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def mse(y: Column, p: Column) -> Column:
    return F.avg((y - p) * (y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(mse(y, p))


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def r2(y: Column, p: Column) -> Column:
    """Share of variance explained; NULL for a constant label."""
    spread = F.var_pop(F.when(p.isNotNull(), y))
    return F.when(spread > 0, 1 - mse(y, p) / spread)


REGRESSION: dict[str, Callable[[Column, Column], Column]] = {
    "mse": mse,
    "rmse": rmse,
    "mae": mae,
    "r2": r2,
}
