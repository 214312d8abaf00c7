"""Train / validation / test splits by time and by reproducible hash order."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline.functions.columns import quoted

HASH_DIGITS = 32
PREFIX_STEP = 3
CUT_ROWS = 20_000


def temporal_label(
    period: str, train: Iterable[int], test: Iterable[int], other: str = "master"
) -> Column:
    """``train``, ``test`` or ``other`` by period."""
    return (
        F.when(F.col(period).isin(list(test)), "test")
        .when(F.col(period).isin(list(train)), "train")
        .otherwise(other)
    )


def temporal_split(
    df: DataFrame, period: str, train: Iterable[int], test: Iterable[int]
) -> tuple[DataFrame, DataFrame]:
    """Rows of the ``train`` periods and rows of the held-out ``test`` periods."""
    return (
        df.where(F.col(period).isin(list(train))),
        df.where(F.col(period).isin(list(test))),
    )


def _hash_order(key: Sequence[str], seed: int) -> Column:
    """A hash of the key in which NULL is a value of its own."""
    parts = [F.coalesce(F.col(quoted(k)).cast("string"), F.lit("\0")) for k in key]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def random_label(
    df: DataFrame,
    key: str | Sequence[str],
    val_frac: float = 0.2,
    seed: int = 42,
    out: str = "split",
) -> DataFrame:
    """Add ``train`` or ``val`` per row; exactly ``ceil(val_frac * n)`` rows get ``val``.

    The rows with the lowest ``md5(seed:key)`` validate. The hash value of the last of them is
    found by counting hash prefixes and refining the one prefix that holds it, so rows are never
    sorted or moved and the label is a plain comparison. Rows that share the key at the cut are told
    apart by a hash of all their columns, found in the same way; rows that agree in everything are
    interchangeable, and as many of them as needed validate.
    """
    key = [key] if isinstance(key, str) else list(key)
    if not 0.0 <= val_frac <= 1.0:
        raise ValueError(f"a share lies in [0, 1], not {val_frac}")
    if val_frac == 0.0:
        return df.withColumn(out, F.lit("train"))
    if val_frac == 1.0:
        return df.withColumn(out, F.lit("val"))
    order = _hash_order(key, seed)
    hashes = df.select(order.alias("_hash"))
    counts = _prefix_counts(hashes, PREFIX_STEP)
    wanted = math.ceil(val_frac * sum(n for _, n in counts))
    if wanted == 0:
        return df.withColumn(out, F.lit("train"))
    last, take, ties = _cut(hashes, counts, wanted)
    if take == ties:
        return df.withColumn(out, F.when(order <= F.lit(last), "val").otherwise("train"))
    whole = F.md5(F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns])))
    tied = df.where(order == F.lit(last)).select(whole.alias("_hash"))
    last_row, take, ties = _cut(tied, _prefix_counts(tied, PREFIX_STEP), take)
    before = (order < F.lit(last)) | ((order == F.lit(last)) & (whole < F.lit(last_row)))
    if take == ties:
        at_cut = (order == F.lit(last)) & (whole == F.lit(last_row))
        return df.withColumn(out, F.when(before | at_cut, "val").otherwise("train"))
    return _share_equal_rows(df, order, whole, last, last_row, before, take, out)


def _share_equal_rows(
    df: DataFrame, order: Column, whole: Column, last: str, last_row: str, before: Column, take: int, out: str
) -> DataFrame:
    """Labels where the cut falls among rows that agree in all columns: ``take`` of them validate.

    They are counted and written out again, once per label, so no task has to order them.
    """
    equal = (order == F.lit(last)) & (whole == F.lit(last_row))
    rest = df.where(~equal).withColumn(out, F.when(before, "val").otherwise("train"))
    columns = [F.col(quoted(c)) for c in df.columns]
    times = F.sequence(F.lit(1).cast("bigint"), F.col("_n"))
    again = (
        df.where(equal)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*columns, F.explode(times).alias("_nth"))
    )
    label = F.when(F.col("_nth") <= take, "val").otherwise("train")
    return rest.unionByName(again.withColumn(out, label).drop("_nth"))


def _cut(
    hashes: DataFrame, counts: list[tuple[str, int]], wanted: int
) -> tuple[str, int, int]:
    """The ``wanted``-th lowest hash, how many rows of that hash are wanted, and how many have it.

    ``counts`` are rows per first digits. The rows that begin like the wanted one are kept while longer
    beginnings narrow them down to one hash, or to few enough rows to look at.
    """
    prefix, n, wanted = _pick(counts, wanted)
    near = hashes.where(F.startswith("_hash", F.lit(prefix))).persist()
    try:
        rest = near
        while n > CUT_ROWS and len(prefix) < HASH_DIGITS:
            prefix, n, wanted = _pick(_prefix_counts(rest, len(prefix) + PREFIX_STEP), wanted)
            rest = near.where(F.startswith("_hash", F.lit(prefix)))
        if len(prefix) >= HASH_DIGITS:
            return prefix, wanted, n
        inside = sorted(r["_hash"] for r in rest.collect())
    finally:
        near.unpersist()
    last = inside[wanted - 1]
    return last, wanted - inside.index(last), inside.count(last)


def _prefix_counts(hashes: DataFrame, width: int) -> list[tuple[str, int]]:
    """Rows per beginning of the hash, in order."""
    found = (
        hashes.groupBy(F.left("_hash", F.lit(width)).alias("head"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    return sorted((r["head"], r["n"]) for r in found)


def _pick(counts: list[tuple[str, int]], wanted: int) -> tuple[str, int, int]:
    """The beginning that holds the ``wanted``-th row, its rows, and the place among them."""
    for head, n in counts:
        if wanted <= n:
            return head, n, wanted
        wanted -= n
    raise ValueError("fewer rows than counted before")


def _halves(
    df: DataFrame, key: str | Sequence[str], val_frac: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    labelled = random_label(df, key, val_frac, seed, out="_split")
    return (
        labelled.where(F.col("_split") == "train").drop("_split"),
        labelled.where(F.col("_split") == "val").drop("_split"),
    )


def random_split(
    df: DataFrame, key: str | Sequence[str], train_frac: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, val) with ``train_frac`` of the rows in train; 1 keeps all, 0 none."""
    return _halves(df, key, 1.0 - train_frac, seed)


def random_test_split(
    df: DataFrame, key: str | Sequence[str], test_frac: float, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with ``test_frac`` of the rows in test; 1 tests on all, 0 on none."""
    return _halves(df, key, test_frac, seed)
