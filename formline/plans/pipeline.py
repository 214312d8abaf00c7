"""The three stages end to end: prepare raw files, search models, score with the best one."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.functions.columns import season_start_year
from formline.models.trials import append_trials, best_trial, read_trials
from formline.models.training import load_pipeline, score_table, search
from formline.operators.assemble import assemble, clean_names, homonyms
from formline.operators.splits import random_split, temporal_split
from formline.operators.windows import close_gaps, lost_periods
from formline.plans.prepare import FeaturePlan, featured_facts, prefixed_features
from formline.sources.catalog import read_season_lists, read_team_list, read_weekly
from formline.sources.prepared import export_prepared, load_stage, write_table

ROW_KEY = "row_key"


@dataclass(frozen=True)
class RawLayout:
    """File names and schemas below the raw folder; weekly files are ``{season}/gws/gw{n}.csv``."""

    weekly_types: Mapping[str, str]
    attributes_file: str = "players_raw.csv"
    attributes_schema: str | None = None
    ids_file: str = "player_idlist.csv"
    ids_schema: str | None = None
    teams_file: str = "master_team_list.csv"
    teams_schema: str | None = None


def clean_facts(
    spark: SparkSession,
    root: str,
    layout: RawLayout,
    plan: FeaturePlan,
    name: str = "player_name",
    ident: str = "player_id",
) -> DataFrame:
    """All weeks joined to attributes and teams, with clean names, closed weeks and start years.

    Week and season come from the paths as ``step`` and ``season``; ``corrupt_cells`` counts the cells
    of a row that do not fit their type.
    """
    facts = read_weekly(
        spark, root, layout.weekly_types, name=name, ident=ident, corrupt="corrupt_cells"
    )
    attributes = read_season_lists(
        spark, root, layout.attributes_file, layout.attributes_schema
    )
    ids = read_season_lists(spark, root, layout.ids_file, layout.ids_schema, {"id": ident})
    teams = read_team_list(spark, f"{root}/{layout.teams_file}", layout.teams_schema)
    whole = clean_names(assemble(facts, attributes, ids, teams, ident=ident), name, ident)
    closed = close_gaps(whole, "season", "step")
    return closed.withColumn(plan.period, season_start_year(F.col("season"))).withColumnsRenamed(
        {"step": plan.step, name: plan.entity}
    )


def prepare(
    spark: SparkSession,
    root: str,
    out_dir: str,
    layout: RawLayout,
    plan: FeaturePlan,
    train_periods: Iterable[int],
    test_periods: Iterable[int],
    fmt: str = "parquet",
) -> dict[str, str]:
    """Write the train, test and master tables and return their paths.

    The cleaned facts and their features are computed once and kept while the tables are written.
    Train and test carry ``row_key``, which names entity, period, step and tie-breakers. It is an error
    if an entity loses a period on the way. Names that several ids share are written as ``homonyms``.
    """
    facts = clean_facts(spark, root, layout, plan).persist()
    featured = featured_facts(facts, plan).withColumn(ROW_KEY, row_key(plan)).persist()
    try:
        check_periods(facts, featured, plan)
        train, test = (
            prefixed_features(half, plan, [ROW_KEY])
            for half in temporal_split(featured, plan.period, train_periods, test_periods)
        )
        paths = export_prepared(train, test, featured, out_dir, fmt)
        ids = read_season_lists(spark, root, layout.ids_file, layout.ids_schema)
        write_table(homonyms(ids), f"{out_dir}/homonyms", fmt)
        return paths | {"homonyms": f"{out_dir}/homonyms"}
    finally:
        featured.unpersist()
        facts.unpersist()


def row_key(plan: FeaturePlan) -> Column:
    """What tells rows apart, as text; NULL parts are written as such."""
    parts = [plan.entity, plan.period, plan.step, *plan.tiebreak]
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in parts])


def check_periods(facts: DataFrame, featured: DataFrame, plan: FeaturePlan) -> None:
    """Raise if an entity that is kept lacks a period of ``facts`` from the first output period on."""
    wanted = facts
    if plan.first_output_period is not None:
        wanted = wanted.where(F.col(plan.period) >= plan.first_output_period)
    wanted = wanted.join(featured.select(plan.entity).distinct(), plan.entity, "left_semi")
    lost = lost_periods(wanted, featured, plan.entity, plan.period).limit(5).collect()
    if lost:
        raise ValueError(f"periods lost on the way: {[tuple(r) for r in lost]}")


def search_models(
    spark: SparkSession,
    paths: Mapping[str, str],
    stages: Sequence,
    regressor: str,
    space: Mapping[str, Sequence],
    experiment: str,
    trials_path: str,
    models_dir: str,
    train_frac: float = 0.8,
    seed: int = 42,
    fmt: str = "parquet",
    key: str | Sequence[str] = ROW_KEY,
    **options,
) -> DataFrame:
    """Search on prepared tables; trial rows and fitted pipelines are stored, rows returned.

    ``key`` tells rows of the training table apart in the random split.
    """
    train, val = load_stage(
        spark,
        "fit",
        train_val_path=paths["train_val_data"],
        splitter=lambda df: random_split(df, key, train_frac, seed),
        fmt=fmt,
    )
    test = load_stage(spark, "test", test_path=paths["test_data"], fmt=fmt)
    rows = search(
        train,
        val,
        test,
        stages,
        regressor,
        space,
        experiment,
        seed=seed,
        models_dir=models_dir,
        **options,
    )
    append_trials(spark, rows, trials_path)
    return read_trials(spark, trials_path, experiment)


def best_model(
    spark: SparkSession,
    trials_path: str,
    models_dir: str,
    experiment: str | None = None,
    metric: str = "val_spearman",
) -> PipelineModel:
    """The stored pipeline of the best run."""
    best = best_trial(read_trials(spark, trials_path, experiment), metric).first()
    if best is None:
        raise ValueError(f"no trials at {trials_path}")
    return load_pipeline(f"{models_dir}/{best['run_id']}")


def score_season(
    spark: SparkSession,
    test_path: str,
    model: PipelineModel,
    out: str = "pred_total_points",
    fmt: str = "parquet",
) -> DataFrame:
    """The prepared test season with the model's prediction."""
    season = load_stage(spark, "predict", predict_path=test_path, fmt=fmt)
    return score_table(model, season, out)
