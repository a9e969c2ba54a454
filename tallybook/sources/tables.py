"""Readers of the given parquet tables, and their shapes as the operators' inputs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.schemas import PLAYER_HISTORY

# The customer-year history: bounds on a year's order value in place of points per game.
CUSTOMER_HISTORY = replace(
    PLAYER_HISTORY,
    attrs=("segment", "nation"),
    bands=(("star", 800_000), ("good", 500_000), ("average", 250_000)),
)
FIRST_YEAR = 1995
LAST_YEAR = 2001

# Rows of game_details are put in this order to choose among copies.
DETAIL_ORDER = ("line_no", "part_id", "pts")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact_sum(column: Column) -> Column:
    """Sum of money amounts, the same in whatever order the rows come."""
    return F.sum(column.cast("decimal(18,2)")).cast("double")


def player_seasons(
    spark: SparkSession, sf_dir: str, first: int | None = None, last: int | None = None
) -> DataFrame:
    """One row per customer and year, of the years from ``first`` to ``last`` if given.

    Orders are reduced before they meet the customers, so that a customer with very many orders
    costs the join no more than one row per year. The bounds are on the order date itself, as a
    bound on the year would not reach the scan.
    """
    facts = yearly(table(spark, sf_dir, "orders"), first, last)
    return facts.join(customers(spark, sf_dir), "o_custkey").select(
        "player_name", "segment", "nation", "season", "gp", "pts", "reb", "ast"
    )


def yearly(orders: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Orders reduced to one row per customer and year."""
    kind = orders.schema["o_orderdate"].dataType
    if first is not None:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(f"{first}-01-01").cast(kind))
    if last is not None:
        orders = orders.filter(F.col("o_orderdate") < F.lit(f"{last + 1}-01-01").cast(kind))
    return orders.groupBy("o_custkey", F.year("o_orderdate").alias("season")).agg(
        F.count(F.lit(1)).cast("int").alias("gp"),
        exact_sum(F.col("o_totalprice")).alias("pts"),
        F.max("o_totalprice").alias("reb"),
        F.min("o_totalprice").alias("ast"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_name").alias("player_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
    )


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, with the customer's name and the year."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("player_name")
    )
    orders = table(spark, sf_dir, "orders")
    return orders.join(customers, "o_custkey").select(
        F.col("o_orderkey").alias("order_id"),
        "player_name",
        F.year("o_orderdate").alias("season"),
    )


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: order as game, supplier as player, return flag as team.

    Names are in ``player_names``: they join what the operators have left of the rows.
    """
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("game_id"),
        F.col("l_suppkey").alias("player_id"),
        F.col("l_returnflag").alias("team_id"),
        F.col("l_returnflag").alias("team_abbreviation"),
        F.col("l_linestatus").alias("start_position"),
        F.col("l_quantity").alias("pts"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_id"),
    )


def player_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("player_id"), F.col("s_name").alias("player_name")
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order; the home team is the customer's nation."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"
    )
    status = F.col("o_orderstatus")
    orders = table(spark, sf_dir, "orders")
    return orders.join(customers, "o_custkey").select(
        F.col("o_orderkey").alias("game_id"),
        (F.col("o_orderkey") % 100).alias("pts_home"),
        (F.col("o_custkey") % 100).alias("pts_away"),
        F.when(status == "F", 1).when(status == "O", 0).alias("home_team_wins"),
        F.col("c_nationkey").alias("home_team_id"),
        ((F.col("c_nationkey") + 1) % 25).alias("visitor_team_id"),
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows per nation, the second under another city."""
    regions = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), "r_name"
    )
    home = (
        table(spark, sf_dir, "nation")
        .join(regions, "n_regionkey")
        .select(
            F.col("n_nationkey").alias("team_id"),
            F.col("n_name").alias("abbreviation"),
            F.col("n_name").alias("nickname"),
            F.col("r_name").alias("city"),
            F.col("r_name").alias("arena"),
            F.lit(None).cast("int").alias("yearfounded"),
        )
    )
    return home.unionByName(home.withColumn("city", F.concat(F.lit("old "), F.col("city"))))
