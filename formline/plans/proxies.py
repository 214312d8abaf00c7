"""The generic tables recast as entities, periods, steps and rosters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formline.operators.evaluation import regression_metrics
from formline.operators.rosters import RosterRules
from formline.plans.prepare import FeaturePlan, feature_table

SUPPLIER_MONTH_PLAN = FeaturePlan(
    entity="entity",
    period="period",
    step="step",
    stats=("units", "returned", "pending"),
    label="label",
    base=("value", "club", "step", "previous_total"),
    activity="gw_avg_units",
    first_input_period=1996,
    first_output_period=1997,
    one_row_per_step=True,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def supplier_months(
    spark: SparkSession, sf_dir: str, first_year: int | None = None
) -> DataFrame:
    """One row per supplier, year and month; partial sums leave the scan, not rows."""
    lines = table(spark, sf_dir, "lineitem")
    if first_year is not None:
        # A plain comparison on the stored column, so that the scan can skip row groups.
        lines = lines.where(F.col("l_shipdate") >= F.lit(f"{first_year}-01-01").cast("timestamp_ntz"))
    return lines.groupBy(
        F.col("l_suppkey").alias("entity"),
        F.year("l_shipdate").alias("period"),
        F.month("l_shipdate").alias("step"),
    ).agg(
        F.sum("l_quantity").alias("units"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if(F.col("l_linestatus") == "O").alias("pending"),
        F.count(F.lit(1)).alias("label"),
    )


def described_months(
    spark: SparkSession, sf_dir: str, first_year: int | None = None
) -> DataFrame:
    """Supplier months with the supplier's club and value."""
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("entity"),
        F.col("s_nationkey").alias("club"),
        F.round("s_acctbal").alias("value"),
    )
    return supplier_months(spark, sf_dir, first_year).join(suppliers, "entity")


def monthly_features(
    spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("period", "step")
) -> DataFrame:
    """The feature table of the supplier months."""
    plan = SUPPLIER_MONTH_PLAN
    return feature_table(described_months(spark, sf_dir, plan.first_input_period), plan, keep)


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, year and month with the number of pending orders."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_custkey").alias("entity"),
            F.year("o_orderdate").alias("period"),
            F.month("o_orderdate").alias("step"),
        )
        .agg(F.count_if(F.col("o_orderstatus") == "P").alias("pending"))
    )


def gapped_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier months whose steps after March are two later in odd years."""
    postponed = (F.col("step") > 3) & (F.col("period") % 2 == 1)
    return supplier_months(spark, sf_dir).select(
        "entity", "period", F.when(postponed, F.col("step") + 2).otherwise(F.col("step")).alias("step")
    )


def season_label(day: Column) -> Column:
    """``1998-99`` for a day in 1998."""
    year = F.year(day)
    return F.concat(
        year.cast("string"), F.lit("-"), F.lpad(((year + 1) % 100).cast("string"), 2, "0")
    )


def order_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with season and week-like step."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("player_id"),
        season_label(F.col("o_orderdate")).alias("season"),
        F.month("o_orderdate").alias("step"),
    )


def season_dimensions(
    spark: SparkSession, sf_dir: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(attributes, ids, teams) of the customers active in each season."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("player_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("second_name"),
        F.col("c_mktsegment").alias("element_type"),
        F.col("c_nationkey").alias("team"),
    )
    active = (
        order_seasons(spark, sf_dir).select("season", "player_id").distinct().join(customers, "player_id")
    )
    attributes = active.select("season", "first_name", "second_name", "element_type", "team")
    ids = active.select("season", "first_name", "second_name", "player_id")
    nations = table(spark, sf_dir, "nation")
    teams = (
        active.select("season", "team")
        .distinct()
        .join(nations, F.col("team") == F.col("n_nationkey"))
        .select("season", "team", F.col("n_name").alias("team_name"))
    )
    return attributes, ids, teams


def regression_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price against a price guessed from the quantity."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("stage"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * 1500).alias("p"),
    )


ROSTER_RULES = RosterRules(
    positions={1: (0, 3), 2: (0, 3), 3: (0, 3), 4: (0, 3)},
    size=8,
    max_value=40_000,
    max_per_club=2,
)


def customer_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units and lines per customer and supplier."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("team"), F.col("l_suppkey").alias("name"))
        .agg(F.sum("l_quantity").alias("units"), F.count(F.lit(1)).alias("n_lines"))
    )


def rosters(spark: SparkSession, sf_dir: str, by: str = "units") -> DataFrame:
    """The eight suppliers a customer buys most from, a top-n taken before and after the shuffle."""
    best = Window.partitionBy("team").orderBy(F.col(by).desc(), "name")
    return (
        customer_suppliers(spark, sf_dir)
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= ROSTER_RULES.size)
        .select("team", "name")
    )


def running_month(day: str) -> Column:
    """Months since the end of 1994."""
    return (F.year(day) - 1995) * 12 + F.month(day)


def supplier_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points per supplier, running month and line status; two rows a month are two fixtures."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_suppkey").alias("name"),
            running_month("l_shipdate").alias("step"),
            F.col("l_linestatus").alias("fixture"),
        )
        .agg(F.sum("l_quantity").alias("points"))
    )


def supplier_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position, value and club per supplier."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("name"),
        (F.col("s_suppkey") % 4 + 1).cast("int").alias("position"),
        F.round("s_acctbal").cast("long").alias("value"),
        F.col("s_nationkey").alias("club"),
    )


def supplier_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers with the units they ever sold as points."""
    sold = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("name"))
        .agg(F.sum("l_quantity").alias("points"))
    )
    return sold.join(supplier_players(spark, sf_dir), "name").select(
        "name", "position", "value", "club", "points"
    )


def supplier_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trial row per supplier: the quantity model's scores on its lines."""
    scores = regression_metrics(regression_rows(spark, sf_dir), "y", "p", ["supplier"])
    measures = [
        part for m in scores.columns[1:] for part in (F.lit(f"val_{m}"), F.round(m, 4))
    ]
    return scores.select(
        F.concat(F.lit("run-"), F.col("supplier").cast("string")).alias("run_id"),
        F.lit("quantity").alias("experiment"),
        F.lit(42).cast("long").alias("seed"),
        F.create_map(F.lit("slope"), F.lit("1500")).alias("params"),
        F.create_map(*measures).alias("metrics"),
    )
