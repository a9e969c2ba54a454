"""Deduplication of a feed along a tree of batches."""

import random

import pytest
from pyspark.sql import functions as F

from tallybook.operators import facts
from tests.fixtures import rows_of

ROWS = "game_id int, player_id int, pts double, pos string"
GRAIN = ["game_id", "player_id"]


def feed(n=400, seed=3):
    """Copies within and across batches, ties, nulls; one grain has a third of the rows."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        grain = (1, 1) if hot else (draw.choice([1, 2, None]), draw.randrange(30))
        rows.append((*grain, draw.choice([None, 1.0, 2.5, float("nan")]), draw.choice([None, "C", "G"])))
    return rows


def batches(rows, n):
    return [rows[i::n] for i in range(n)]


def built(spark, parts, order_by=("pts",)):
    nodes = []
    for part in parts:
        nodes = facts.dedup_feed(nodes, spark.createDataFrame(part, ROWS), GRAIN, order_by)
    return nodes


@pytest.mark.parametrize("n", [1, 2, 5, 8])
def test_equals_fact_dedup_in_any_order(spark, n):
    rows = feed()
    whole = spark.createDataFrame(rows, ROWS)
    parts = batches(rows, n)
    random.Random(n).shuffle(parts)
    found = facts.dedup_rows(built(spark, parts), GRAIN, ["pts"])
    assert found.columns == [*whole.columns, "copies"]
    # as text: NaN is not equal to itself
    assert repr(rows_of(found.drop("copies"))) == repr(rows_of(facts.fact_dedup(whole, GRAIN, ["pts"])))
    copies = whole.groupBy(*GRAIN).agg(F.count(F.lit(1)).alias("copies"))
    assert rows_of(found, *GRAIN, "copies") == rows_of(copies, *GRAIN, "copies")


def test_a_batch_costs_its_path(spark):
    """Nodes are the binary digits of the number of batches; those a batch does not merge with stay."""
    parts = batches(feed(70), 7)
    nodes, sizes = [], []
    for part in parts:
        before = nodes
        nodes = facts.dedup_feed(nodes, spark.createDataFrame(part, ROWS), GRAIN, ["pts"])
        sizes.append([size for size, _ in nodes])
        assert all(old is new for old, new in zip(before, nodes[:-1]))
    assert sizes == [[1], [2], [2, 1], [4], [4, 1], [4, 2], [4, 2, 1]]
    # an earlier list still gives the feed up to its batch
    early = built(spark, parts[:3])
    facts.dedup_feed(early, spark.createDataFrame(parts[3], ROWS), GRAIN, ["pts"])
    assert facts.dedup_rows(early, GRAIN, ["pts"]).agg(F.sum("copies")).first()[0] == 30


def test_nodes_are_tables_and_batches_reduce_map_side(spark):
    nodes = built(spark, batches(feed(60), 2))
    plan = nodes[0][1]._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Exchange" not in plan
    batch = facts.dedup_batch(spark.createDataFrame(feed(60), ROWS), GRAIN, ["pts"])
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") == 1 and "partial_min" in plan and "partial_count" in plan


def test_empty_batches_and_grain_alone(spark):
    nodes = built(spark, [[], feed(9), []])
    assert facts.dedup_rows(nodes, GRAIN, ["pts"]).agg(F.sum("copies")).first()[0] == 9
    only = spark.createDataFrame([(1, 2), (1, 2), (None, 3)], "game_id int, player_id int")
    assert rows_of(facts.dedup_batch(only, GRAIN)) == [(1, 2, 2), (None, 3, 1)]
