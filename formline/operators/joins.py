"""The one join shape several operators share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(facts: DataFrame, extra: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of ``extra`` (unique on ``keys``) in which NULL keys meet NULL keys."""
    renamed = extra.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    match = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    )
    return facts.join(renamed, match, "left").drop(*[f"_right_{k}" for k in keys])
