from functools import reduce

import pytest
from pyspark.sql import functions as F

from tallybook.operators import cumulative as cu
from tallybook.plans import queries
from tallybook.schemas import PLAYER_HISTORY, PLAYERS, HistorySpec
from tallybook.sources.tables import CUSTOMER_HISTORY, FIRST_YEAR, LAST_YEAR, player_seasons
from tests.fixtures import rows_of, seasons
from tests.oracle import DATA

EXPECTED = [
    ("A", 2000, 1, 0.0, 0.0, "bad", 0, True),
    ("A", 2001, 2, 0.0, 21.0, "star", 0, True),
    ("A", 2002, 3, 0.0, 22.0, "star", 0, True),
    ("B", 2000, 1, 20.0, 20.0, "good", 0, True),
    ("B", 2001, 1, 20.0, 20.0, "good", 1, False),
    ("B", 2002, 2, 20.0, 15.5, "good", 0, True),
    ("C", 2002, 1, 10.0, 10.0, "bad", 0, True),
    ("D", 2001, 1, 30.0, 30.0, "star", 0, True),
    ("D", 2002, 1, 30.0, 30.0, "star", 1, False),
]


def summary(players):
    return rows_of(
        players.select(
            "player_name",
            "current_season",
            F.size("season_stats"),
            F.get("season_stats", F.lit(0))["pts"],
            F.try_element_at("season_stats", F.lit(-1))["pts"],
            "scoring_class",
            "year_since_last_season",
            "is_active",
        )
    )


def names_and_types(schema):
    """Names, and types without nullability."""
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def loop(spark, facts, first, last, spec, empty):
    """One step per period, each from the one before."""
    snapshots = [empty]
    for period in range(first, last + 1):
        snapshots.append(cu.cumulative_step(snapshots[-1], facts, period, spec, first=period == first))
    return reduce(lambda a, b: a.unionByName(b), snapshots[1:])


def test_backfill(spark):
    players = cu.cumulative_backfill(seasons(spark), 2000, 2002)
    assert summary(players) == EXPECTED
    assert names_and_types(players.schema) == names_and_types(PLAYERS)
    stats = {r.player_name: r.season_stats for r in players.filter("current_season = 2002").collect()}
    assert [tuple(e) for e in stats["B"]] == [(2000, 60, 20.0, 5.0, 5.0), (2002, 61, 15.5, 5.0, 5.0)]


def test_steps_equal_backfill(spark):
    facts = seasons(spark)
    empty = spark.createDataFrame([], PLAYERS)
    steps = loop(spark, facts, 2000, 2002, PLAYER_HISTORY, empty)
    assert summary(steps) == EXPECTED
    assert names_and_types(steps.schema) == names_and_types(PLAYERS)


def test_snapshot_equals_backfill(spark):
    facts = seasons(spark)
    players = cu.cumulative_backfill(facts, 2000, 2002)
    for period in (2000, 2001, 2002):
        one = cu.cumulative_snapshot(facts, period, 2000)
        whole = players.filter(F.col("current_season") == period)
        assert rows_of(one.select(players.columns)) == rows_of(whole)


def test_step_takes_only_its_two_periods(spark):
    """A whole table of snapshots and facts may be given; other periods stay out."""
    facts = seasons(spark)
    players = cu.cumulative_backfill(facts, 2000, 2002)
    step = cu.cumulative_step(players, facts, 2002)
    assert summary(step) == [r for r in EXPECTED if r[1] == 2002]


def test_step_refuses_a_missing_past(spark):
    facts = seasons(spark)
    players = cu.cumulative_backfill(facts, 2000, 2001)
    later = facts.withColumn("season", F.lit(2003)).dropDuplicates(["player_name"])
    with pytest.raises(Exception, match="no snapshot of period 2002"):
        cu.cumulative_step(players, later, 2003).collect()
    assert cu.cumulative_step(players, later, 2003, first=True).count() == later.count()


def test_several_facts_in_one_period_are_refused(spark):
    facts = seasons(spark)
    twice = facts.unionByName(facts.filter("player_name = 'B' and season = 2000"))
    told = "several facts in one period for B, 2000"
    for build in (
        lambda: cu.cumulative_backfill(twice, 2000, 2002),
        lambda: cu.cumulative_snapshot(twice, 2001, 2000),
        lambda: cu.cumulative_step(spark.createDataFrame([], PLAYERS), twice, 2000, first=True),
    ):
        with pytest.raises(Exception, match=told):
            build().collect()


def test_step_attributes_latest_known_wins(spark):
    facts = seasons(spark).withColumn(
        "height", F.when(F.col("season") == 2002, F.lit(None)).otherwise(F.col("height"))
    )
    before = cu.cumulative_backfill(facts, 2000, 2001)
    step = {r.player_name: r.height for r in cu.cumulative_step(before, facts, 2002).collect()}
    assert step == {"A": "6-9", "B": "6-10", "C": None, "D": "6-5"}


def test_step_without_activity(spark):
    facts = seasons(spark)
    step = cu.cumulative_step(cu.cumulative_backfill(facts, 2000, 2001), facts, 2002, with_active=False)
    assert "is_active" not in step.columns and step.count() == 4


def test_backfill_that_starts_late(spark):
    """Facts before the first period open the entity's rows but are not in its history."""
    players = cu.cumulative_backfill(seasons(spark), 2001, 2002)
    got = rows_of(
        players.select(
            "player_name",
            "current_season",
            F.size("season_stats"),
            "scoring_class",
            "year_since_last_season",
            "is_active",
        )
    )
    assert got == sorted(
        [
            ("A", 2001, 1, "star", 0, True),
            ("A", 2002, 2, "star", 0, True),
            ("B", 2001, 0, "bad", None, None),
            ("B", 2002, 1, "good", 0, True),
            ("C", 2002, 1, "bad", 0, True),
            ("D", 2001, 1, "star", 0, True),
            ("D", 2002, 1, "star", 1, False),
        ],
        key=repr,
    )
    later = cu.cumulative_snapshot(seasons(spark), 2001, 2001)
    assert rows_of(later.select("player_name", "is_active")) == [("A", True), ("B", None), ("D", True)]


def test_backfill_that_ends_early(spark):
    players = cu.cumulative_backfill(seasons(spark), 2000, 2001)
    assert summary(players) == [r for r in EXPECTED if r[1] <= 2001]


def test_spine_and_attributes(spark):
    facts = seasons(spark)
    spine = cu.period_spine(facts, "player_name", "season", 2001, 2002)
    assert rows_of(spine) == [
        ("A", 2001), ("A", 2002), ("B", 2001), ("B", 2002), ("C", 2002), ("D", 2001), ("D", 2002)
    ]
    attrs = cu.static_attributes(facts, "player_name", ["height", "college"])
    assert rows_of(attrs)[0] == ("A", "6-9", "Duke")


def test_reads(spark):
    players = cu.cumulative_backfill(seasons(spark), 2000, 2002)
    history = cu.unnest_history(players, 2002, "A")
    assert rows_of(history, "season", "gp", "pts") == [(2000, 70, 0.0), (2001, 71, 21.0), (2002, 72, 22.0)]
    assert cu.unnest_history(players, 2001).count() == 4
    assert cu.snapshot_lookup(players, 2000, "B").count() == 1
    assert cu.snapshot_lookup(players).count() == 9
    ends = cu.first_last(players, 2002).filter("player_name = 'A'").collect()[0]
    assert (ends.first_season.pts, ends.latest_season.pts) == (0.0, 22.0)
    assert rows_of(cu.improvement_ratio(players, 2002)) == [("A", 22.0), ("D", 1.0)]


def test_spec_is_checked():
    with pytest.raises(ValueError):
        HistorySpec(stats=("gp", "season", "pts"))


def test_steps_equal_backfill_on_the_tables(spark):
    """Attributes differ by definition (greatest ever against latest so far)."""
    sf = str(DATA / "sf0.001")
    facts = player_seasons(spark, sf).cache()
    backfill = cu.cumulative_backfill(facts, FIRST_YEAR, LAST_YEAR, CUSTOMER_HISTORY)
    steps = loop(spark, facts, FIRST_YEAR, LAST_YEAR, CUSTOMER_HISTORY, backfill.limit(0))
    left = backfill.drop(*CUSTOMER_HISTORY.attrs)
    right = steps.select(left.columns)
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
    assert left.count() == queries.cumulative_backfill(spark, sf).count()
