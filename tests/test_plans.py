"""Plans as they would be on large tables: nothing is small enough to be broadcast."""

import re

import pytest

from tallybook.operators import cumulative as cu
from tallybook.operators import graph, idempotent, scd
from tallybook.plans import QUERIES
from tallybook.sources import tables as src
from tests.fixtures import details, rows_of, seasons
from tests.oracle import DATA

SF = str(DATA / "sf0.001")
FORBIDDEN = (
    "BroadcastNestedLoopJoin",
    "CartesianProduct",
    "Python",
    "ArrowEval",
    "MapInPandas",
)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan after adaptive execution."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("overwrite_period", "enum_subpartition")])
def test_no_nested_loops_and_no_python(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SF))
    assert not [word for word in FORBIDDEN if word in text]


def test_full_scd_needs_one_exchange_on_the_key(spark, no_broadcast):
    players = cu.cumulative_backfill(seasons(spark), 2000, 2002)
    full = scd.scd2_full(players, "player_name", "current_season", ["scoring_class", "is_active"], 2002)
    assert plan(full).count("Exchange hashpartitioning") == 1
    assert "collect_list" not in plan(full)


def test_pairs_share_one_exchange(spark, no_broadcast):
    text = final_plan(graph.player_pairs(details(spark)))
    assert "ReusedExchange" in text
    assert len(re.findall(r"Exchange hashpartitioning\(game_id#\d+, _low", text)) == 2  # one and its reuse
    assert "SortMergeJoin" in text


def test_building_pairs_starts_no_job(spark):
    d = details(spark)
    spark.sparkContext.setJobGroup("pairs", "building")
    try:
        graph.player_pair_edges(d, block_rows=2)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("pairs")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_edges_are_made_without_a_join(spark, no_broadcast):
    rows = src.game_details(spark, SF)
    for edges in (graph.plays_in_edges(rows), graph.plays_on_edges(rows)):
        assert "Join" not in plan(edges)
    players = plan(QUERIES["player_vertices"](spark, SF))
    join = players.index("SortMergeJoin")
    assert "l_quantity" in players[join:] and players[join:].count("HashAggregate") >= 2


def test_integrity_needs_no_join_and_three_exchanges(spark, no_broadcast):
    vertices = spark.createDataFrame([("1", "player")], "identifier string, type string")
    edges = spark.createDataFrame(
        [("1", "player", "2", "game", "plays_in")],
        "subject_identifier string, subject_type string, object_identifier string, object_type string, edge_type string",
    )
    text = plan(graph.graph_integrity(vertices, edges))
    assert "Join" not in text and text.count("Exchange hashpartitioning") <= 3


def test_all_dimensions_are_checked_in_one_scan(spark, no_broadcast):
    assert plan(QUERIES["additivity_check"](spark, SF)).count("FileScan") == 1


def test_dedup_limits_before_the_exchange(spark):
    text = plan(QUERIES["fact_dedup"](spark, SF))
    below = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below


def test_filters_reach_the_scan(spark):
    window = plan(QUERIES["bounded_window"](spark, SF))
    assert "GreaterThanOrEqual(ts" in window and "LessThan(ts" in window
    assert "value" not in window.split("ReadSchema")[1]
    assert "GreaterThanOrEqual(ts" in plan(QUERIES["retention_filter"](spark, SF))


def test_step_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "players")
    facts = seasons(spark)
    idempotent.overwrite_period(cu.cumulative_backfill(facts, 2000, 2002), path, "current_season", idempotent.ALL)
    table = spark.read.parquet(path)
    assert re.search(r"PartitionFilters: \[[^\]]*current_season#\d+ = 2001", plan(cu.cumulative_step(table, facts, 2002)))
    lookup = plan(cu.snapshot_lookup(table, 2001, "A"))
    assert re.search(r"PartitionFilters: \[[^\]]*current_season#\d+ = 2001", lookup)
    assert "EqualTo(player_name,A)" in lookup


def test_incremental_scd_joins_once_and_prunes(spark, no_broadcast, tmp_path):
    path = str(tmp_path / "scd")
    players = cu.cumulative_backfill(seasons(spark), 2000, 2002)
    tracked = ["scoring_class", "is_active"]
    history = scd.scd2_full(players, "player_name", "current_season", tracked, 2001)
    idempotent.overwrite_period(history, path, "current_season", idempotent.ALL)
    now = cu.cumulative_snapshot(seasons(spark), 2002, 2000)
    text = plan(scd.scd2_incremental(spark.read.parquet(path), now, "player_name", tracked, 2002))
    assert text.count("SortMergeJoin") == 1
    assert len(re.findall(r"PartitionFilters: \[[^\]]*current_season#\d+ = 2001", text)) == 3  # one of them stops at a row


def test_step_on_a_bucketed_table_shuffles_the_new_facts_only(spark, no_broadcast, tmp_path):
    facts = seasons(spark)
    backfill = cu.cumulative_backfill(facts, 2000, 2002)

    def save(df):
        idempotent.overwrite_period_bucketed(
            df, "bucketed_players", "current_season", "player_name", 8, str(tmp_path / "b")
        )

    save(backfill)
    table = spark.table("bucketed_players")
    step = cu.cumulative_step(table, facts, 2002)
    assert plan(step).count("Exchange hashpartitioning") == 1
    save(step)
    again = spark.table("bucketed_players")
    assert rows_of(again.select(backfill.columns)) == rows_of(backfill)

    tracked = ["scoring_class", "is_active"]
    history = scd.scd2_full(table, "player_name", "current_season", tracked, 2001)
    assert plan(history).count("Exchange hashpartitioning") == 0
    spark.sql("drop table bucketed_players")


def test_logs_are_parsed_once(spark):
    for name in ("raw_logs_to_facts", "raw_logs_rejects"):
        assert plan(QUERIES[name](spark, SF)).count("from_json") == 1
