"""The registered queries: each operator over whole generic tables, ``(spark, sf_dir) -> rows``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.functions import columns as C
from formline.models import training, trials
from formline.models.features import (
    PRESETS,
    EncodeColumns,
    FeatureRoles,
    ScaleColumns,
    shape_of,
    vector_encoding,
    vector_entries,
)
from formline.operators import assemble as assembly
from formline.operators import evaluation, rosters, splits, windows
from formline.plans import proxies as P
from formline.plans.prepare import featured_facts, prefixed_features
from formline.session import fresh_path
from formline.sources import catalog, prepared

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TRAIN_YEARS = (1998, 1999, 2000)
TEST_YEARS = (2001,)
ROLES = FeatureRoles(
    numerical=("X_step", "X_value", "X_previous_total"),
    categorical=("X_club",),
    feature_prefixes=("X_value", "X_club", "X_previous", "X_rolling_"),
    label="label",
)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- windows -------------------------------------------------------------------------------


@query
def rolling_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = P.supplier_months(spark, sf_dir).select("entity", "period", "step", "units")
    return windows.lagged_features(
        months,
        ["entity", "period"],
        "step",
        ["units"],
        averages=False,
        unique_steps=True,
        max_group_rows=None,  # at most twelve months in a year
    ).drop("units")


@query
def step_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = P.supplier_months(spark, sf_dir).select("entity", "period", "step", "units")
    return windows.lagged_features(
        months,
        ["entity", "period"],
        "step",
        ["units"],
        windows=(),
        unique_steps=True,
        max_group_rows=None,
    ).drop("units")


def _sparse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose value is missing for errors, with their day as step."""
    return P.table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        "ts",
        F.dayofmonth("ts").alias("step"),
        F.when(F.col("event_type") != "error", F.round(F.col("value") * 100)).alias("cents"),
    )


def _event_features(spark: SparkSession, sf_dir: str, max_group_rows: int) -> DataFrame:
    return windows.lagged_features(
        _sparse_events(spark, sf_dir),
        ["user_id"],
        "step",
        ["cents"],
        windows=(2, 6),
        tiebreak=["ts", "event_id"],
        max_group_rows=max_group_rows,
    ).drop("cents", "ts")


@query
def event_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_features(spark, sf_dir, windows.GROUP_ROWS)


@query
def event_features_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows through the plan for oversized groups, every user counting as one."""
    return _event_features(spark, sf_dir, 25)


@query
def prev_period_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = P.supplier_months(spark, sf_dir).select("entity", "period", "step", "label")
    return windows.previous_period_total(
        months, "entity", "period", "label", bounded=True
    ).drop("label")


@query
def prev_period_total_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On unaggregated rows, whose number per customer nothing bounds."""
    orders = P.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.year("o_orderdate").alias("period"),
        F.round("o_totalprice").cast("long").alias("price"),
    )
    return windows.previous_period_total(orders, "o_custkey", "period", "price").drop("price")


@query
def period_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = P.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("entity"),
        F.year("l_shipdate").alias("period"),
        "l_quantity",
    )
    return windows.period_totals(lines, "entity", "period", "l_quantity")


@query
def close_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.close_gaps(P.gapped_months(spark, sf_dir), "period", "step", "step_closed")


@query
def distinct_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = P.table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("period"), F.month("l_shipdate").alias("step")
    )
    return windows.distinct_steps(lines, "period", "step")


@query
def period_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = P.order_months(spark, sf_dir)
    kept = months.where((F.col("pending") > 0) | (F.col("period") > 1996))
    return windows.lost_periods(months, kept, "entity", "period")


@query
def drop_inactive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.drop_inactive(P.order_months(spark, sf_dir), "entity", "pending")


@query
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.monthly_features(spark, sf_dir)


# --- splits --------------------------------------------------------------------------------


@query
def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.supplier_months(spark, sf_dir).select(
        "entity",
        "period",
        "step",
        splits.temporal_label("period", TRAIN_YEARS, TEST_YEARS).alias("split"),
    )


@query
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = P.table(spark, sf_dir, "orders").select("o_orderkey")
    return splits.random_label(orders, "o_orderkey", val_frac=1 - 0.8)


# --- columns and assembly ------------------------------------------------------------------


@query
def select_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.select_prefix(P.table(spark, sf_dir, "lineitem"), ["l_r", "l_l"])


@query
def demo_prep(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = P.table(spark, sf_dir, "part").withColumnRenamed("p_size", "p size")
    return prepared.demo_table(parts, ["p_partkey", "p size"], "p_retailprice", "p_partkey")


@query
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = P.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat("c_name", F.lit(" A_"), F.col("c_custkey").cast("string")).alias("raw"),
    )
    return assembly.clean_names(raw, "raw", "c_custkey", "entity").select(
        "c_custkey",
        "entity",
        C.clean_name(F.col("raw"), F.col("c_custkey"), literal=True).alias("entity_literal"),
        C.id_from_name(F.col("raw")).alias("id_from_name"),
    )


@query
def season_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.order_seasons(spark, sf_dir).select(
        "o_orderkey", "season", C.season_start_year(F.col("season")).alias("starting_year")
    )


@query
def assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = P.order_seasons(spark, sf_dir)
    return assembly.assemble(facts, *P.season_dimensions(spark, sf_dir))


@query
def homonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = P.table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("season"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("first_name"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("second_name"),
    )
    return assembly.homonyms(listed)


@query
def union_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = P.table(spark, sf_dir, "orders")
    extra = {"F": ["o_totalprice"], "O": ["o_orderpriority"], "P": ["o_custkey", "o_totalprice"]}
    return assembly.union_all(
        [
            orders.where(F.col("o_orderstatus") == status).select("o_orderkey", *names)
            for status, names in extra.items()
        ]
    ).select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")


# --- feature stages ------------------------------------------------------------------------


@query
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = P.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return EncodeColumns(inputCols=["p_brand", "p_type"]).fit(parts).transform(parts)


@query
def one_hot_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer names, far too many for columns, as vectors: where the one stands, and their sum."""
    customers = P.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    encoded = Pipeline(stages=vector_encoding(["c_name"])).fit(customers).transform(customers)
    indices, ones = vector_entries("c_name_vector")
    return encoded.select(
        "c_custkey",
        F.coalesce(F.get(indices, F.array_position(ones, F.lit(1.0)) - 1).cast("bigint"), F.lit(-1)).alias("position"),
        F.aggregate(ones, F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


@query
def identity_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preset without stages leaves the table as it is."""
    months = P.supplier_months(spark, sf_dir)
    return Pipeline(stages=PRESETS["identity"](ROLES)).fit(months).transform(months)


@query
def feature_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = P.monthly_features(spark, sf_dir)
    ready = Pipeline(stages=PRESETS["plain"](ROLES)).fit(table).transform(table)
    return spark.createDataFrame([shape_of(ready)], "n_rows long, n_features int, n_labels int")


@query
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = P.table(spark, sf_dir, "part").select(
        "p_partkey", "p_size", "p_retailprice", F.lit(7).alias("p_constant")
    )
    scaled = ScaleColumns(inputCols=["p_size", "p_constant"], prefixes=["p_retail"])
    out = scaled.fit(parts).transform(parts)
    return out.select("p_partkey", *[F.round(c, 6).alias(c) for c in parts.columns[1:]])


@query
def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = P.monthly_features(spark, sf_dir)
    ready = Pipeline(stages=PRESETS["plain"](ROLES)).fit(table).transform(table)
    return ready.select(
        "entity",
        "period",
        "step",
        F.posexplode(vector_to_array("features")).alias("pos", "value"),
    )


# --- evaluation ----------------------------------------------------------------------------


@query
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = evaluation.regression_metrics(P.regression_rows(spark, sf_dir), "y", "p")
    digits = {"mse": 1, "rmse": 4, "mae": 4, "r2": 6}
    return row.select(*[F.round(m, d).alias(m) for m, d in digits.items()])


@query
def stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = evaluation.stage_metrics(P.regression_rows(spark, sf_dir), "y", "p")
    share = F.endswith("metric", F.lit("_r2"))
    value = F.when(share, F.round("value", 6)).otherwise(F.round("value", 1))
    return long.select("stage", "metric", value.alias("value"))


@query
def spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = evaluation.spearman(P.regression_rows(spark, sf_dir), "y", "p")
    return row.select(F.round("rho", 8).alias("rho"))


@query
def average_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In ranges of few rows, as when the values exceed one task."""
    return evaluation.average_ranks(
        P.table(spark, sf_dir, "lineitem"), "l_extendedprice", rows_per_range=10_000
    )


@query
def ols_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evaluation.ols_trend(P.regression_rows(spark, sf_dir), "y", "p", ["stage"])
    digits = {"slope": 8, "intercept": 3, "r2": 8, "lo": 2, "hi": 2}
    return rows.select("stage", *[F.round(c, d).alias(c) for c, d in digits.items()])


@query
def scatter_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = P.table(spark, sf_dir, "orders").withColumn("month", F.month("o_orderdate"))
    return evaluation.scatter_points(orders, "o_totalprice", "month", ["o_orderkey"])


@query
def scatter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.scatter_counts(P.regression_rows(spark, sf_dir), "y", "p", 40)


# --- rosters -------------------------------------------------------------------------------


@query
def player_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = P.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("name"),
        F.month("l_shipdate").alias("step"),
        F.col("l_quantity").alias("points"),
    )
    facts = lines.join(P.supplier_players(spark, sf_dir), "name")
    return rosters.player_pool(
        facts, "name", "position", "value", "club", "points", steps=["step"]
    )


@query
def week_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pool of one month."""
    facts = P.supplier_facts(spark, sf_dir).join(P.supplier_players(spark, sf_dir), "name")
    names = ("name", "position", "value", "club", "points")
    return rosters.player_pool(facts, *names, where=F.col("step") == 40)


@query
def legality_any_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams of all suppliers that a customer ever used: most are too large."""
    teams = P.customer_suppliers(spark, sf_dir)
    flags = rosters.team_legality(teams, P.supplier_pool(spark, sf_dir), P.ROSTER_RULES)
    return flags.select(
        "team", "n_players", "total_value", "max_club", "positions_legal", "value_legal", "clubs_legal", "legal"
    )


@query
def team_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rosters.team_totals(
        P.rosters(spark, sf_dir), P.supplier_pool(spark, sf_dir), P.ROSTER_RULES
    )


@query
def team_legality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rosters.team_legality(
        P.rosters(spark, sf_dir), P.supplier_pool(spark, sf_dir), P.ROSTER_RULES
    ).select("team", "positions_legal", "value_legal", "clubs_legal", "legal")


@query
def open_clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options: the suppliers a customer uses beyond its roster."""
    teams = P.rosters(spark, sf_dir)
    options = P.customer_suppliers(spark, sf_dir).join(teams, ["team", "name"], "left_anti")
    return rosters.open_clubs(options, teams, P.supplier_pool(spark, sf_dir), P.ROSTER_RULES)


@query
def refresh_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the last month, which is read off the ship dates inside the same query."""
    facts = P.supplier_facts(spark, sf_dir)
    shipped = P.table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").alias("day"))
    last = shipped.select(P.running_month("day")).scalar()
    week = facts.where(F.col("step") == last)
    latest = rosters.first_per_name(week, ["name"], "points", ["fixture"])
    return rosters.refresh_points(P.rosters(spark, sf_dir), latest)


def _swap_inputs(spark: SparkSession, sf_dir: str) -> tuple:
    return P.rosters(spark, sf_dir), P.supplier_pool(spark, sf_dir), P.ROSTER_RULES


@query
def swap_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rosters.swap_candidates(*_swap_inputs(spark, sf_dir))


@query
def swap_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All swaps of the customers who have the dearest supplier."""
    teams, pool, rules = _swap_inputs(spark, sf_dir)
    dearest = pool.orderBy(F.desc("value"), "name").limit(1).select("name")
    return rosters.swap_list(teams, pool, teams.join(F.broadcast(dearest), "name").select("team"), rules)


@query
def best_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rosters.best_swap(*_swap_inputs(spark, sf_dir))


@query
def apply_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    teams, pool, rules = _swap_inputs(spark, sf_dir)
    return rosters.apply_swap(teams, rosters.best_swap(teams, pool, rules))


@query
def transfer_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the suppliers of most units to those of most lines."""
    return rosters.transfer_cost(
        P.rosters(spark, sf_dir, "units"),
        P.rosters(spark, sf_dir, "n_lines"),
        P.supplier_pool(spark, sf_dir),
    )


@query
def weekly_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rosters.weekly_reward(
        P.rosters(spark, sf_dir), P.supplier_facts(spark, sf_dir), "step", order=["fixture"]
    )


@query
def cheaper_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rosters.cheaper_options(*_swap_inputs(spark, sf_dir))


#: Every transfer after the first costs 500 points.
_PAID = rosters.TransferCharge(n_free=1, penalty=500)


@query
def improve_rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Until no team improves."""
    return rosters.improve_rosters(*_swap_inputs(spark, sf_dir)).drop("settled")


@query
def improve_with_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Until no team improves by more than its transfers cost."""
    return rosters.improve_rosters(*_swap_inputs(spark, sf_dir), charge=_PAID).drop("settled")


@query
def settled_rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Until no team improves, with whether each has settled."""
    return rosters.improve_rosters(*_swap_inputs(spark, sf_dir))


@query
def settled_with_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Until no team improves by more than its transfers cost, with whether each has settled."""
    return rosters.improve_rosters(*_swap_inputs(spark, sf_dir), charge=_PAID)


@query
def restarted_rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of eleven climbs per team, ten of them from perturbed starts."""
    return rosters.restarted_rosters(*_swap_inputs(spark, sf_dir), charge=_PAID)


@query
def repair_rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams over the budget, brought within it."""
    return rosters.repair_rosters(*_swap_inputs(spark, sf_dir))


# --- trials --------------------------------------------------------------------------------


@query
def best_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = trials.best_trial(P.supplier_trials(spark, sf_dir), "val_r2")
    return best.select("run_id", F.col("metrics")["val_r2"].alias("value"))


@query
def trials_to_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trials.trials_to_drop(P.supplier_trials(spark, sf_dir), "val_mae")


# --- files ---------------------------------------------------------------------------------

SEASON_DIR, STEP_DIR = r"/season=([^/]+)/", r"/step=(\d+)/"


def _write_weeks(spark: SparkSession, sf_dir: str) -> str:
    """Supplier months as one CSV folder per season and step; later seasons have more columns.

    There, whole numbers have decimals and ids a trailing ``.0``, as where a column has gaps, one header
    is not ASCII, and notes have line breaks.
    """
    root = fresh_path(spark, "weeks")
    for era in ("old", "new"):
        _write_era(spark, sf_dir, root, era)
    # a week without rows: its file holds a header and nothing else
    nothing = spark.createDataFrame([], "name string, element long, units double, label long")
    prepared.write_table(nothing.coalesce(1), f"{root}/none/season=1990-91/step=1", "csv")
    return root


def _write_era(spark: SparkSession, sf_dir: str, root: str, era: str) -> None:
    months = P.supplier_months(spark, sf_dir).select(
        "period",
        F.concat(F.lit("Supplier_"), F.col("entity").cast("string")).alias("name"),
        F.col("entity").alias("element"),
        F.col("entity").cast("double").alias("eléments"),
        "units",
        "label",
        F.col("label").cast("double").alias("labels"),
        F.when(F.col("returned") > 0, F.col("returned").cast("double")).alias("returned"),
        F.concat(F.lit("supplier,\n"), F.col("entity").cast("string")).alias("note"),
        F.concat("period", F.lit("-"), F.lpad(((F.col("period") + 1) % 100).cast("string"), 2, "0"))
        .alias("season"),
        "step",
    )
    headers = {
        "old": (F.col("period") < 1998, ["name", "element", "units", "label"]),
        "new": (F.col("period") >= 1998, ["labels", "returned", "note", "name", "units", "eléments"]),
    }
    which, names = headers[era]
    rows = months.where(which).select(*names, "season", "step")
    # Rebalancing gathers a week in one file, but splits a week that outgrows a partition.
    prepared.write_table(rows.hint("rebalance", "season", "step"), f"{root}/{era}", "csv", ["season", "step"])


@query
def file_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _write_weeks(spark, sf_dir)
    files = catalog.file_catalog(spark, root, STEP_DIR, SEASON_DIR)
    return files.select("season", "step").distinct()


def _read_weeks(spark: SparkSession, root: str, store: str | None = None) -> DataFrame:
    types = {"units": "double", "label": "bigint", "returned": "bigint"}
    renames = {"name": "player_name", "element": "player_id", "eléments": "player_id", "labels": "label"}
    return catalog.read_weekly(
        spark, root, types, STEP_DIR, SEASON_DIR, renames, encoding="UTF-8", corrupt="corrupt_cells", store=store
    ).select(
        "season", "step", "player_id", "player_name", "units", "label", "returned", "note", "corrupt_cells"
    )


@query
def weekly_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_weeks(spark, _write_weeks(spark, sf_dir))


@query
def weekly_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older seasons' files read and stored, then the later ones' added: only these are read then."""
    root, store = fresh_path(spark, "weeks"), fresh_path(spark, "weekly-store")
    _write_era(spark, sf_dir, root, "old")
    catalog.weekly_store(spark, root, store, STEP_DIR, SEASON_DIR, "UTF-8")
    _write_era(spark, sf_dir, root, "new")
    return _read_weeks(spark, root, store)


def _export(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The three prepared tables, from features computed once."""
    plan = P.SUPPLIER_MONTH_PLAN
    facts = P.described_months(spark, sf_dir, plan.first_input_period)
    featured = featured_facts(facts, plan).persist()
    table = prefixed_features(featured, plan, ["period", "step"])
    train, test = splits.temporal_split(table, "period", TRAIN_YEARS, TEST_YEARS)
    try:
        return prepared.export_prepared(
            train, test, featured, fresh_path(spark, "prepared"), partition_by=["period"]
        )
    finally:
        featured.unpersist()


@query
def prepared_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _export(spark, sf_dir)
    train = prepared.load_stage(
        spark, "predict", predict_path=paths["train_val_data"]
    ).withColumn("split", F.lit("train"))
    test = prepared.load_stage(spark, "test", test_path=paths["test_data"]).withColumn(
        "split", F.lit("test")
    )
    return train.unionByName(test)


# --- models --------------------------------------------------------------------------------


def _frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, val, test) through the prepared tables."""
    paths = _export(spark, sf_dir)
    train, val = prepared.load_stage(
        spark,
        "fit",
        train_val_path=paths["train_val_data"],
        splitter=lambda df: splits.random_split(df, ["entity", "period", "step"], 0.8),
    )
    test = prepared.load_stage(spark, "test", test_path=paths["test_data"])
    return train, val, test


def _fit_report(frames: tuple, preset: str, estimator) -> tuple[DataFrame, PipelineModel]:
    """(stage, n_rows, fits) and the model: rows of each stage, and whether the train stage beats the mean.

    The labels of the generic tables are noise, so nothing is to be expected beyond the train stage.
    """
    model, metrics = training.train_and_evaluate(*frames, PRESETS[preset](ROLES), estimator)
    r2 = metrics.where(F.endswith("metric", F.lit("_r2"))).select("stage", "value")
    sizes = assembly.union_all(
        [f.select(F.lit(name).alias("stage")) for name, f in zip(("train", "val", "test"), frames, strict=True)]
    )
    fits = F.when(F.col("stage") == "train", F.col("value") > 0).alias("fits")
    rows = sizes.groupBy("stage").agg(F.count(F.lit(1)).alias("n_rows")).join(r2, "stage")
    return rows.select("stage", "n_rows", fits), model


@query
def train_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many trees as the smallest searched setting."""
    forest = training.random_forest(n_estimators=min(training.FOREST_SPACE["n_estimators"]))
    return _fit_report(_frames(spark, sf_dir), "encoded", forest)[0]


@query
def train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many trees as the smallest searched setting; whether the train error falls, and never rises on the way."""
    boosted = training.boosted_trees(n_estimators=min(training.BOOSTING_SPACE["n_estimators"]))
    report, model = _fit_report(_frames(spark, sf_dir), "encoded", boosted)
    history = model.stages[-1].getHistory()
    steady = all(b <= a * (1 + 1e-9) for a, b in zip(history, history[1:], strict=False))
    fits = F.when(F.col("stage") == "train", F.lit(history[-1] < history[0]))
    return report.withColumns({"fits": fits, "never_rises": F.lit(steady)})


@query
def train_linear_svr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted until it settles; the objective is compared with a fit to a hundredth of the tolerance."""
    frames = _frames(spark, sf_dir)
    report, model = _fit_report(frames, "scaled", training.linear_svr(epsilon=0.5, max_iter=500))
    fitted = model.stages[-1]
    ready = PipelineModel(model.stages[:-1]).transform(frames[0])
    longer = training.linear_svr(epsilon=0.5, tol=1e-6, max_iter=500).fit(ready)
    least, reached = min(longer.getHistory()), min(fitted.getHistory())
    return report.withColumns(
        {"converged": F.lit(fitted.getConverged()), "near_least": F.lit(reached <= 1.02 * least)}
    )


@query
def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows, and whether the prediction is weights times features plus intercept."""
    train, _, test = _frames(spark, sf_dir)
    stages = [*PRESETS["scaled"](ROLES), training.linear_svr(epsilon=0.5, max_iter=500)]
    model = Pipeline(stages=stages).fit(train)
    scored = training.score_table(model, test, "scored")
    weights = F.lit([float(w) for w in model.stages[-1].getOrDefault("coefficients")])
    product = F.aggregate(
        F.zip_with(vector_to_array("features"), weights, lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x
    )
    whole = product + model.stages[-1].getOrDefault("intercept")
    return PipelineModel(model.stages[:-1]).transform(scored).select(
        "entity", "period", "step", F.col("label").cast("bigint").alias("label"),
        (F.abs(F.col("scored") - whole) < 1e-9).alias("same"),
    )


@query
def pipeline_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether predictions before saving and after loading agree, for each row."""
    train, _, test = _frames(spark, sf_dir)
    forest = training.random_forest(n_estimators=min(training.FOREST_SPACE["n_estimators"]))
    stages = [*PRESETS["scaled"](ROLES), forest]
    model = Pipeline(stages=stages).fit(train)
    path = fresh_path(spark, "pipeline")
    training.save_pipeline(model, path)
    before = training.score_table(model, test, "before")
    both = training.score_table(training.load_pipeline(path), before, "after")
    same = F.col("before") == F.col("after")
    return both.select("entity", "period", "step", same.alias("same"))


@query
def trial_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two experiments searched, logged and read back by name: runs, parameters and metrics of each.

    All settings of both grids: linear regressors share their passes, forests their trees.
    """
    frames = _frames(spark, sf_dir)
    path = fresh_path(spark, "trials")
    searches = {
        "svr": ("linear_svr", training.SVR_SPACE, {"max_iter": 500}),
        "forest": ("random_forest", training.FOREST_SPACE, None),
    }
    for name, (regressor, space, fixed) in searches.items():
        rows = training.search(*frames, PRESETS["scaled"](ROLES), regressor, space, name, fixed=fixed)
        trials.append_trials(spark, rows, path)
    names = lambda column: F.array_join(F.array_sort(F.map_keys(column)), ",")
    found = [trials.read_trials(spark, path, name) for name in searches]
    return (
        assembly.union_all(found)
        .groupBy("experiment", "seed", names("params").alias("params"), names("metrics").alias("metrics"))
        .agg(F.countDistinct("run_id").alias("n_runs"))
    )
