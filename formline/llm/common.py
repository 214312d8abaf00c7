"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.session import fresh_path

#: Words are runs of anything but ASCII white space; ``bytes.split()`` cuts at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one vectorised step handles at most, unless a single text is longer.
STEP_BYTES = 2_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` computed once into Parquet in the shared folder, then read from there.

    Readers survive lost executors: nothing is held in executor memory or local disks.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), so other columns cannot clash."""
    return df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where ``df`` has such a column (in whatever case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def mounted_folder(spark: SparkSession, label: str) -> str | None:
    """A new folder inside the shared one as a path that tasks can open, or None where that is no mounted one."""
    url = urlparse(fresh_path(spark, label))
    if url.scheme not in ("", "file"):
        return None
    os.makedirs(url.path)
    return url.path


def save_array(path: str, array: np.ndarray) -> None:
    """Whole or not at all, and the same again if a task is repeated."""
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        np.save(f, array)
    os.replace(part, path)


_held: dict[str, list] = {}


def memory_of(owner: str) -> list:
    """Where an operator keeps what a worker shall remember between tasks.

    Workers outlive a stage, so what other operators remembered in this one is let go.
    """
    for name, held in _held.items():
        if name != owner:
            held.clear()
    return _held.setdefault(owner, [])


def steps(
    batches: Iterator[pa.RecordBatch], text_col: str, most: int = STEP_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of at most ``most`` bytes of text (at least one row), with the texts as UTF-8 bytes."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary())
        start = size = 0
        texts: list[bytes] = []
        for i, value in enumerate(column):
            raw = value.as_py() or b""
            if texts and size + len(raw) > most:
                yield batch.slice(start, i - start), texts
                start, size, texts = i, 0, []
            texts.append(raw)
            size += len(raw)
        if texts:
            yield batch.slice(start, len(texts)), texts
