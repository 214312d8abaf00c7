"""Prepared tables: written once, loaded by stage."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.operators.splits import random_label

Splitter = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> None:
    """``df`` as Parquet, or as CSV with a header."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def export_prepared(
    train: DataFrame,
    test: DataFrame,
    master: DataFrame,
    out_dir: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
) -> dict[str, str]:
    """Write the three prepared tables and return their paths; only master is partitioned."""
    paths = {n: f"{out_dir}/{n}" for n in ("train_val_data", "test_data", "master")}
    write_table(train, paths["train_val_data"], fmt, mode=mode)
    write_table(test, paths["test_data"], fmt, mode=mode)
    write_table(master, paths["master"], fmt, partition_by, mode)
    return paths


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", True)
    return reader.load(path)


def load_stage(
    spark: SparkSession,
    stage: str,
    train_val_path: str | None = None,
    test_path: str | None = None,
    predict_path: str | None = None,
    splitter: Splitter | None = None,
    fmt: str = "parquet",
) -> DataFrame | tuple[DataFrame, DataFrame] | None:
    """The table(s) a stage needs.

    ``fit`` gives (train, val) through ``splitter``, ``test`` and ``predict`` one table,
    ``validate`` nothing.
    """
    if stage == "validate":
        return None
    paths = {"fit": train_val_path, "test": test_path, "predict": predict_path}
    if stage not in paths:
        raise ValueError(f"no such stage: {stage!r}; one of {sorted([*paths, 'validate'])}")
    path = paths[stage]
    assert path is not None, f"the {stage} stage needs its data path"
    df = read_table(spark, path, fmt)
    if stage != "fit":
        return df
    if splitter is None:
        raise ValueError("the fit stage needs a splitter")
    return splitter(df)


def demo_table(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    key: str,
    test_frac: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Features renamed ``X_...`` without blanks, ``Y_target``, and the row's ``split``."""
    labelled = random_label(df, key, test_frac, seed, out="_split")
    return labelled.select(
        *[F.col(f"`{c}`").alias("X_" + c.replace(" ", "_")) for c in features],
        F.col(target).alias("Y_target"),
        F.when(F.col("_split") == "val", "test").otherwise("train").alias("split"),
    )
