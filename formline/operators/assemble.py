"""Joining weekly facts to the attributes and teams of their season, and cleaning names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.functions.columns import clean_name, full_name, id_text


def entity_attributes(
    attributes: DataFrame,
    ids: DataFrame,
    season: str = "season",
    first: str = "first_name",
    second: str = "second_name",
    ident: str = "player_id",
    position: str = "element_type",
    team: str = "team",
) -> DataFrame:
    """(season, id, position, team): attributes meet the id list on season and full name."""
    named = attributes.select(season, full_name(first, second).alias("_name"), position, team)
    listed = ids.select(
        season, full_name(first, second).alias("_name"), id_text(ids, ident).alias(ident)
    )
    return named.join(listed, [season, "_name"]).select(season, ident, position, team)


def homonyms(
    ids: DataFrame, season: str = "season", first: str = "first_name", second: str = "second_name"
) -> DataFrame:
    """Names that several ids of a season share, with their number; they fan out the id join."""
    return (
        ids.groupBy(season, full_name(first, second).alias("name"))
        .agg(F.count(F.lit(1)).alias("n_ids"))
        .where(F.col("n_ids") > 1)
    )


def assemble(
    facts: DataFrame,
    attributes: DataFrame,
    ids: DataFrame,
    teams: DataFrame,
    season: str = "season",
    first: str = "first_name",
    second: str = "second_name",
    ident: str = "player_id",
    position: str = "element_type",
    team: str = "team",
) -> DataFrame:
    """Facts with position, team and the team list's columns; unmatched facts vanish.

    The dimensions are joined with one another first. No side is marked for broadcast: Spark
    broadcasts those whose size allows it and splits skewed keys of the others.
    """
    described = entity_attributes(
        attributes, ids, season, first, second, ident, position, team
    ).join(teams, [season, team])
    keyed = facts.withColumn(ident, id_text(facts, ident))
    return keyed.join(described, [season, ident])


def clean_names(
    df: DataFrame, name: str, ident: str, out: str | None = None, literal: bool = False
) -> DataFrame:
    """Entity keys from raw names, see :func:`formline.functions.columns.clean_name`."""
    return df.withColumn(out or name, clean_name(F.col(name), F.col(ident), literal))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames under the union of their columns, absent ones NULL."""
    if not frames:
        raise ValueError("no frames to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
