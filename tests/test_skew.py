"""One key with a third of all rows: the work on it is reduced map-side or split."""

import re

import pytest
from pyspark.sql import functions as F

from tallybook.operators import dims, facts, graph, idempotent, scd
from tallybook.sources import tables as src
from tests.oracle import DATA
from tests.test_plans import final_plan, plan

SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}
SKEWED = "SortMergeJoin(skew=true)"


@pytest.fixture
def splitting(spark):
    for name, value in SPLITTING.items():
        spark.conf.set(name, value)
    yield
    for name in SPLITTING:
        spark.conf.unset(name)


@pytest.fixture
def hot(spark):
    """300,000 rows of 1,000 keys, a third of them of key 7."""
    rows = spark.range(0, 300_000, 1, 8)
    spread = F.xxhash64("id")
    return rows.select(
        "id",
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(spread, F.lit(1000))).cast("int").alias("k"),
        (F.col("id") % 5).cast("int").alias("season"),
        spread.alias("payload"),
    )


def test_denormalize_splits_a_hot_key(spark, splitting, hot):
    dim = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("name"))
    wide = facts.fact_denormalize(hot, [(dim, ["k"], ["name"])])
    assert SKEWED in final_plan(wide)
    assert wide.count() == 300_000 and wide.filter("name is null").isEmpty()


def test_asof_splits_a_hot_entity(spark, splitting, hot):
    snapshots = spark.range(1000).select(
        F.col("id").cast("int").alias("k"),
        F.explode(F.sequence(F.lit(0), F.lit(4))).alias("current_season"),
    )
    snapshots = snapshots.withColumn("label", F.when(F.col("current_season") < 2, "a").otherwise("b"))
    records = scd.scd2_full(snapshots, "k", "current_season", ["label"], 4)
    held = scd.scd2_asof(hot, records, "k", "season", ["label"])
    assert SKEWED in final_plan(held)
    counts = {r.label: r["count"] for r in held.groupBy("label").count().collect()}
    assert counts == {"a": 120_000, "b": 180_000}


def test_snapshot_asof_spreads_a_hot_entity_over_its_periods(spark, splitting, hot):
    snapshots = spark.range(1000).select(
        F.col("id").cast("int").alias("k"),
        F.explode(F.sequence(F.lit(0), F.lit(4))).alias("current_season"),
    )
    snapshots = snapshots.withColumn("label", F.when(F.col("current_season") < 4, "a").otherwise("b"))
    late = idempotent.snapshot_asof(hot, snapshots, "k", "season", "current_season", "label")
    assert late.count() == 240_000
    assert re.search(r"Exchange hashpartitioning\(k#\d+, season#\d+", plan(late))


def test_opponents_split_a_hot_subject(spark, splitting, hot):
    edges = hot.select(
        F.col("k").cast("string").alias("subject_identifier"),
        F.lit("player").alias("subject_type"),
        F.col("id").cast("string").alias("object_identifier"),
        F.lit("player").alias("object_type"),
        F.lit("plays_against").alias("edge_type"),
        F.lit('{"num_games":1,"subject_points":2.0}').alias("properties"),
    )
    vertices = spark.range(1000).select(
        F.col("id").cast("string").alias("identifier"),
        F.lit("player").alias("type"),
        F.lit('{"player_name":"n","number_of_games":2,"total_points":4.0}').alias("properties"),
    )
    stats = graph.opponent_stats(vertices, edges)
    assert SKEWED in final_plan(stats)
    assert stats.count() == 300_000


def shuffled_rows(df) -> int:
    """Rows written to the first shuffle, from the metrics of the executed plan."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan().executedPlan()
    found = []

    def visit(n):
        children = n.children()
        for i in range(children.size()):
            visit(children.apply(i))
        if "QueryStage" in n.nodeName():
            visit(n.plan())
        if n.nodeName() == "Exchange":
            found.append(n.metrics().apply("shuffleRecordsWritten").value())

    visit(node)
    return found[0]


def test_copies_are_reduced_before_the_shuffle(spark, hot):
    """100,000 copies of one key leave each of the 8 tasks as one row."""
    one_each = facts.first_per(hot.filter("k = 7"), ["k"])
    assert shuffled_rows(one_each) == 8
    report = facts.duplicate_report(hot, ["k"])
    assert shuffled_rows(report) <= 8 * 1000


def test_additivity_reduces_a_hot_entity_before_the_shuffle(hot):
    check = dims.additivity_check(hot, "k", "season")
    assert shuffled_rows(check) <= 8 * 1000 * 5


def test_a_dedup_per_player_has_a_limit_on_both_sides_of_a_shuffle(spark, splitting):
    details = src.game_details(spark, str(DATA / "sf0.001"))
    text = plan(graph.plays_in_edges(details, ["player_id"], ["game_id"]))
    limit, exchange = text.index("WindowGroupLimit"), text.index("Exchange hashpartitioning(player_id")
    assert limit < exchange < text.rindex("WindowGroupLimit")
