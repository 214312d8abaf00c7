"""Column selection by name and scalar expressions on names, seasons and identifiers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def columns_with_prefix(df: DataFrame, prefixes: str | Sequence[str]) -> list[str]:
    """Column names starting with any of ``prefixes``, in table order."""
    wanted = (prefixes,) if isinstance(prefixes, str) else tuple(prefixes)
    return [c for c in df.columns if c.startswith(wanted)]


def select_prefix(df: DataFrame, prefixes: str | Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in columns_with_prefix(df, prefixes)])


def add_prefix(df: DataFrame, columns: Iterable[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in columns})


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; names that do not are left alone."""
    return df.withColumnsRenamed(dict(names))


def quoted(name: str) -> str:
    """``name`` safe for ``col`` even with dots in it."""
    return "`" + name.replace("`", "``") + "`"


def id_text(df: DataFrame, column: str) -> Column:
    """An identifier as text; a whole number written with ``.0``, as number or as text, loses it."""
    c = F.col(quoted(column))
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        c = c.cast("long")
    return whole_number_text(c.cast("string"))


def whole_number_text(text: Column) -> Column:
    """``12`` for ``12.0``; any other text as it is."""
    return F.regexp_replace(text, r"^\s*(-?\d+)\.0+\s*$", "$1")


def no_nan(df: DataFrame) -> DataFrame:
    """NaN turned into NULL, the engine's only form of missing."""
    floats = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    ]
    if not floats:
        return df
    return df.withColumns(
        {c: F.when(~F.isnan(quoted(c)), F.col(quoted(c))) for c in floats}
    )


def full_name(first: str, second: str) -> Column:
    """``first_second``; NULL when either part is."""
    return F.concat(F.col(first), F.lit("_"), F.col(second))


def clean_name(name: Column, ident: Column, literal: bool = False) -> Column:
    """Entity key from a raw name: no ``_{id}``, underscores for blanks, lower case.

    By default only a trailing id goes; ``literal`` removes it wherever it occurs.
    """
    tag = F.concat(F.lit("_"), ident.cast("string"))
    if literal:
        bare = F.replace(name, tag, F.lit(""))
    else:
        bare = F.when(
            F.endswith(name, tag), F.left(name, F.length(name) - F.length(tag))
        ).otherwise(name)
    return F.lower(F.translate(bare, " ", "_"))


def id_from_name(name: Column) -> Column:
    """The text after the last underscore, for files without an id column."""
    return F.substring_index(name, "_", -1)


def season_start_year(season: Column) -> Column:
    """2019 for ``2019-20``."""
    return F.split_part(season, F.lit("-"), F.lit(1)).cast("int")


def text_of(path: Column, pattern: str) -> Column:
    """First group of ``pattern`` in ``path``, NULL where it does not match."""
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))
