"""Feature stages for ``pyspark.ml`` pipelines; each persists with the pipeline that holds it."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formline.functions.columns import columns_with_prefix, quoted
from formline.session import fresh_path


def _strings(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toListString)


def _floats(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toListFloat)


class _Stored(DefaultParamsReadable, DefaultParamsWritable):
    """Saved and loaded as its params alone."""


class ScaleColumns(Estimator, HasInputCols, _Stored):
    """Standardise listed columns and whole prefix groups in place.

    Uses the population deviation; a constant column is only centred. The columns keep a stable
    order: those listed, then those found by prefix.
    """

    prefixes = _strings("prefixes", "prefixes of further columns to scale")

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), prefixes: Sequence[str] = ()):
        super().__init__()
        self._set(inputCols=list(inputCols), prefixes=list(prefixes))

    def _fit(self, df: DataFrame) -> ScaleColumnsModel:
        prefixes = self.getOrDefault(self.prefixes)
        found = columns_with_prefix(df, prefixes) if prefixes else []
        columns = list(dict.fromkeys([*self.getInputCols(), *found]))
        if not columns:
            return ScaleColumnsModel(inputCols=[], means=[], scales=[])
        row = df.agg(
            *[F.avg(quoted(c)).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(quoted(c)).alias(f"s{i}") for i, c in enumerate(columns)],
        ).first()
        return ScaleColumnsModel(
            inputCols=columns,
            means=[float(row[f"m{i}"] or 0.0) for i in range(len(columns))],
            scales=[float(row[f"s{i}"] or 1.0) for i in range(len(columns))],
        )


class ScaleColumnsModel(Model, HasInputCols, _Stored):
    means = _floats("means", "mean per column")
    scales = _floats("scales", "deviation per column, 1 where it is 0")

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: Sequence[str] = (),
        means: Sequence[float] = (),
        scales: Sequence[float] = (),
    ):
        super().__init__()
        self._set(inputCols=list(inputCols), means=list(means), scales=list(scales))

    def _transform(self, df: DataFrame) -> DataFrame:
        each = zip(
            self.getInputCols(),
            self.getOrDefault(self.means),
            self.getOrDefault(self.scales),
            strict=True,
        )
        return df.withColumns({c: (F.col(quoted(c)) - m) / s for c, m, s in each})


class EncodeColumns(Estimator, HasInputCols, _Stored):
    """One 0/1 column ``{column}_{category}`` per category seen in fitting, in sorted order.

    Unseen and missing categories give zeros throughout. More than ``maxCategories`` categories
    are refused, since each becomes a column; :func:`vector_encoding` has no such limit.
    """

    dropSource = Param(
        Params._dummy(), "dropSource", "drop the encoded columns", TypeConverters.toBoolean
    )
    maxCategories = Param(
        Params._dummy(), "maxCategories", "most categories per column", TypeConverters.toInt
    )

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: Sequence[str] = (),
        dropSource: bool = True,
        maxCategories: int = 1000,
    ):
        super().__init__()
        self._set(
            inputCols=list(inputCols), dropSource=dropSource, maxCategories=maxCategories
        )

    def _fit(self, df: DataFrame) -> EncodeColumnsModel:
        columns, most = self.getInputCols(), self.getOrDefault(self.maxCategories)
        pairs = F.array(
            *[
                F.struct(F.lit(i).alias("i"), F.col(quoted(c)).cast("string").alias("text"))
                for i, c in enumerate(columns)
            ]
        )
        # One scan for all columns; more rows than this mean that some column has too many.
        seen = (
            df.select(F.inline(pairs))
            .where(F.col("text").isNotNull())
            .distinct()
            .limit(most * len(columns) + 1)
            .collect()
        )
        found: list[list[str]] = [[] for _ in columns]
        for row in seen:
            found[row["i"]].append(row["text"])
        for c, values in zip(columns, found, strict=True):
            if len(values) > most:
                raise ValueError(f"column {c} has more than {most} categories")
            numeric = isinstance(df.schema[c].dataType, T.NumericType)
            values.sort(key=Decimal if numeric else None)
        return EncodeColumnsModel(
            inputCols=columns,
            categories=json.dumps(found),
            dropSource=self.getOrDefault(self.dropSource),
        )


class EncodeColumnsModel(Model, HasInputCols, _Stored):
    categories = Param(
        Params._dummy(), "categories", "categories per column as JSON", TypeConverters.toString
    )
    dropSource = Param(
        Params._dummy(), "dropSource", "drop the encoded columns", TypeConverters.toBoolean
    )

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: Sequence[str] = (),
        categories: str = "[]",
        dropSource: bool = True,
    ):
        super().__init__()
        self._set(inputCols=list(inputCols), categories=categories, dropSource=dropSource)

    def _transform(self, df: DataFrame) -> DataFrame:
        sources = self.getInputCols()
        gone = set(sources) if self.getOrDefault(self.dropSource) else set()
        kept = [F.col(quoted(c)) for c in df.columns if c not in gone]
        added = [
            F.when(F.col(quoted(c)).cast("string").eqNullSafe(v), 1.0)
            .otherwise(0.0)
            .alias(f"{c}_{v}")
            for c, values in zip(
                sources, json.loads(self.getOrDefault(self.categories)), strict=True
            )
            for v in values
        ]
        return df.select(*kept, *added)


class AssembleFeatures(Transformer, _Stored):
    """Columns with the given prefixes as vector ``features``, the label column as ``label``.

    Tables without the label column (to be scored) only get the vector. ``missing`` says what becomes
    of rows that lack a feature: ``error``, ``skip`` (the row goes) or ``zero`` (the feature is 0).
    """

    prefixes = _strings("prefixes", "prefixes of the feature columns")
    labelColumn = Param(
        Params._dummy(), "labelColumn", "column to learn", TypeConverters.toString
    )
    missing = Param(
        Params._dummy(), "missing", "error, skip or zero where a feature is missing", TypeConverters.toString
    )

    @keyword_only
    def __init__(
        self, *, prefixes: Sequence[str] = ("X_",), labelColumn: str = "label", missing: str = "error"
    ):
        super().__init__()
        if missing not in ("error", "skip", "zero"):
            raise ValueError(f"missing must be 'error', 'skip' or 'zero', not {missing!r}")
        self._set(prefixes=list(prefixes), labelColumn=labelColumn, missing=missing)

    def _transform(self, df: DataFrame) -> DataFrame:
        features = columns_with_prefix(df, self.getOrDefault(self.prefixes))
        label = self.getOrDefault(self.labelColumn)
        missing = self.getOrDefault(self.missing)
        plain = [c for c in features if not isinstance(df.schema[c].dataType, VectorUDT)]
        numeric = df.withColumns({c: F.col(quoted(c)).cast("double") for c in plain})
        if missing == "zero":
            numeric = numeric.fillna(0.0, [quoted(c) for c in plain])
        invalid = "skip" if missing == "skip" else "error"
        assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid=invalid)
        out = assembler.transform(numeric)
        if label in out.columns:
            out = out.withColumn("label", F.col(quoted(label)).cast("double"))
        return out


class NumberCategories(Estimator, HasInputCols, _Stored):
    """Numbers the categories of columns of any number of them, in the order of their text.

    The distinct categories are sorted in ranges; a category's number is its place in its range plus the sizes of
    the ranges before. The numbers stay a table, in the folder named by ``spark.checkpoint.dir`` until the model is
    saved; only one row per range reaches the driver.
    """

    suffix = Param(Params._dummy(), "suffix", "what the vector columns' names end in", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), suffix: str = "_vector"):
        super().__init__()
        self._set(inputCols=list(inputCols), suffix=suffix)

    def _fit(self, df: DataFrame) -> NumberCategoriesModel:
        columns = self.getInputCols()
        pairs = F.array(
            *[F.struct(F.lit(i).alias("column"), F.col(quoted(c)).cast("string").alias("text")) for i, c in enumerate(columns)]
        )
        distinct = df.select(F.inline(pairs)).where(F.col("text").isNotNull()).distinct()
        spark = df.sparkSession
        ranged, numbered = fresh_path(spark, "categories-ranged"), fresh_path(spark, "categories")
        ordered = distinct.repartitionByRange("column", "text").sortWithinPartitions("column", "text")
        at = F.monotonically_increasing_id()
        ordered.select("column", "text", F.spark_partition_id().alias("range"), at.alias("at")).write.parquet(ranged)
        rows = spark.read.parquet(ranged)
        sizes = rows.groupBy("column", "range").agg(F.count("*").alias("n"), F.min("at").alias("first")).collect()
        before, offsets = [0] * len(columns), []
        for r in sorted(sizes, key=lambda r: (r["column"], r["range"])):
            offsets.append((r["column"], r["range"], before[r["column"]] - r["first"]))
            before[r["column"]] += r["n"]
        shifts = spark.createDataFrame(offsets, "column int, range int, shift bigint")
        number = (F.col("at") + F.col("shift")).alias("number")
        rows.join(F.broadcast(shifts), ["column", "range"]).select("column", "text", number).write.parquet(numbered)
        return NumberCategoriesModel(inputCols=columns, suffix=self.getOrDefault(self.suffix), sizes=before, table=numbered)


class NumberCategoriesModel(Model, HasInputCols, _Stored):
    """Appends a sparse vector ``{column}{suffix}`` per column; unseen and missing categories give zeros throughout."""

    suffix = Param(Params._dummy(), "suffix", "what the vector columns' names end in", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "categories per column", TypeConverters.toListInt)
    table = Param(Params._dummy(), "table", "folder of the numbers", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), suffix: str = "_vector", sizes: Sequence[int] = (), table: str = ""):
        super().__init__()
        self._set(inputCols=list(inputCols), suffix=suffix, sizes=list(sizes), table=table)

    def numbers(self, spark: SparkSession) -> DataFrame:
        """(column, text, number): every category seen in fitting."""
        return spark.read.schema("column int, text string, number bigint").parquet(self.getOrDefault(self.table))

    def _transform(self, df: DataFrame) -> DataFrame:
        numbers = self.numbers(df.sparkSession)
        for i, (c, size) in enumerate(zip(self.getInputCols(), self.getOrDefault(self.sizes), strict=True)):
            key, number = f"_text_{i}", f"_number_{i}"
            known = numbers.where(F.col("column") == i).select(F.col("text").alias(key), F.col("number").alias(number))
            found = df.join(known, F.col(quoted(c)).cast("string") == F.col(key), "left")
            out = f"{c}{self.getOrDefault(self.suffix)}"
            vector = _one_hot_vector(F.col(number), size).alias(out, metadata={"ml_attr": {"num_attrs": size}})
            df = found.select(*[F.col(quoted(x)) for x in df.columns], vector)
        return df

    def write(self):
        return _WithTable(self)

    @classmethod
    def read(cls):
        return _FromTable(cls)


def _one_hot_vector(number: Column, size: int) -> Column:
    """A sparse vector of ``size`` with a one at ``number``, or without any where that is null.

    SQL has no cast to vectors, but its JSON reader makes them, so rows stay out of Python.
    """
    one = F.concat(F.lit('"indices":['), number.cast("string"), F.lit('],"values":[1.0]}}'))
    body = F.concat(F.lit(f'{{"v":{{"type":0,"size":{size},'), F.coalesce(one, F.lit('"indices":[],"values":[]}}')))
    return F.from_json(body, T.StructType([T.StructField("v", VectorUDT())]))["v"]


class _WithTable(DefaultParamsWriter):
    """Saves the table of numbers beside the params."""

    def saveImpl(self, path: str) -> None:  # noqa: N802
        super().saveImpl(path)
        self.instance.numbers(self.sparkSession).write.parquet(f"{path}/categories")


class _FromTable(DefaultParamsReader):
    def load(self, path: str) -> NumberCategoriesModel:
        return super().load(path)._set(table=f"{path}/categories")


def vector_encoding(columns: Sequence[str], suffix: str = "_vector") -> list:
    """Stages for columns of more categories than columns can hold: ``{column}{suffix}``, a sparse vector.

    Positions follow the categories in order; unseen and missing categories give zeros throughout. The
    vectors may be assembled like any feature column.
    """
    return [NumberCategories(inputCols=list(columns), suffix=suffix)]


def vector_entries(name: str) -> tuple[Column, Column]:
    """(indices, values) of a vector column as arrays: the stored entries of sparse vectors, all of dense ones.

    A sparse vector is never spread out, so that a row costs as much as it holds, however wide it is.
    """
    stored = F.unwrap_udt(F.col(quoted(name)))
    values = stored["values"]
    every = F.transform(values, lambda _, i: i)
    return F.coalesce(stored["indices"], every), values


def shape_of(ready: DataFrame) -> tuple[int, int, int]:
    """(rows, features, labels) of an assembled table, in one aggregation."""
    labels = int("label" in ready.columns)
    row = ready.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size(vector_to_array("features"))).alias("width")
    ).first()
    return row["n"], row["width"] or 0, labels


@dataclass(frozen=True)
class FeatureRoles:
    """What the presets do with the columns of a feature table."""

    numerical: Sequence[str]
    categorical: Sequence[str]
    feature_prefixes: Sequence[str]
    label: str
    scaled_prefixes: Sequence[str] = ("X_rolling_", "X_gw_avg_")
    prefix: str = "X_"
    missing: str = "error"


def _plain(roles: FeatureRoles) -> list:
    return [AssembleFeatures(prefixes=[roles.prefix], labelColumn=roles.label, missing=roles.missing)]


def _encoded(roles: FeatureRoles) -> list:
    return [
        EncodeColumns(inputCols=list(roles.categorical)),
        AssembleFeatures(
            prefixes=list(roles.feature_prefixes), labelColumn=roles.label, missing=roles.missing
        ),
    ]


def _scaled(roles: FeatureRoles) -> list:
    scale = ScaleColumns(
        inputCols=list(roles.numerical), prefixes=list(roles.scaled_prefixes)
    )
    return [scale, *_encoded(roles)]


PRESETS: dict[str, Callable[[FeatureRoles], list]] = {
    "identity": lambda roles: [],
    "plain": _plain,
    "encoded": _encoded,
    "scaled": _scaled,
}
