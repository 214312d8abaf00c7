"""Session defaults, shared scratch space, checkpoints and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DataType, DatetimeType, NumericType, StringType

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32_000_000
_local_dirs: dict[str, str] = {}


def local_session(
    app: str, cores: int | str = "*", shuffle_partitions: int = 8, scratch: str | None = None
) -> SparkSession:
    """A single-JVM session for tests and the bench; clusters bring their own.

    ``scratch`` is where checkpoints and scratch tables go, as ``spark.checkpoint.dir`` on a cluster.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    if scratch is not None:
        builder = builder.config("spark.checkpoint.dir", scratch)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="formline-")
    return _local_dirs[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/formline/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` backed by reliable checkpoint files, computed once."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    held = df.persist()
    try:
        return held.checkpoint(eager=True)
    finally:
        held.unpersist()


def table_within(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> pa.Table | None:
    """The rows of ``df`` when they are at most so many and so large, else None.

    At most ``max_rows + 1`` rows reach the driver, and none before their size is known: columns of fixed
    width are bounded by their number of rows, others are measured first.
    """
    head = df.limit(max_rows + 1)
    sized = [F.coalesce(F.octet_length(_text(F.col(f"`{f.name}`"), f.dataType)), F.lit(0)) for f in df.schema if not _fixed(f.dataType)]
    if sized:
        measured = head.select(sum(sized, F.lit(0)).alias("n")).agg(F.count("*"), F.sum("n")).first()
        if measured[0] > max_rows or (measured[1] or 0) > max_bytes:
            return None
    elif 16 * len(df.columns) * (max_rows + 1) > max_bytes and head.count() > max_rows:
        return None
    held = head.toArrow()
    return None if held.num_rows > max_rows or held.nbytes > max_bytes else held


def _fixed(kind: DataType) -> bool:
    return isinstance(kind, (NumericType, BooleanType, DatetimeType))


def _text(column: Column, kind: DataType) -> Column:
    return column if isinstance(kind, (StringType, BinaryType)) else F.to_json(F.struct(column))


def rows_within(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame | None:
    """``df`` as a local relation when it holds at most so many rows and bytes, else None."""
    held = table_within(df, max_rows, max_bytes)
    return None if held is None else df.sparkSession.createDataFrame(held, schema=df.schema)
