import pytest
from pyspark.sql import functions as F

from tallybook.operators import cumulative as cu
from tallybook.operators import scd
from tallybook.schemas import PLAYERS_SCD
from tests.fixtures import rows_of, seasons

KEY, PERIOD = "player_name", "current_season"
TRACKED = ["scoring_class", "is_active"]
OUT = [KEY, *TRACKED, "start_season", "end_season"]

AT_2001 = [
    ("A", "bad", True, 2000, 2000),
    ("A", "star", True, 2001, 2001),
    ("B", "good", False, 2001, 2001),
    ("B", "good", True, 2000, 2000),
    ("D", "star", True, 2001, 2001),
]
AT_2002 = [
    ("A", "bad", True, 2000, 2000),
    ("A", "star", True, 2001, 2002),
    ("B", "good", False, 2001, 2001),
    ("B", "good", True, 2000, 2000),
    ("B", "good", True, 2002, 2002),
    ("C", "bad", True, 2002, 2002),
    ("D", "star", False, 2002, 2002),
    ("D", "star", True, 2001, 2001),
]


@pytest.fixture
def players(spark):
    return cu.cumulative_backfill(seasons(spark), 2000, 2002)


def full(players, upto, **kw):
    return scd.scd2_full(players, KEY, PERIOD, TRACKED, upto, **kw)


def test_full(players):
    assert rows_of(full(players, 2001), *OUT) == AT_2001
    assert rows_of(full(players, 2002), *OUT) == AT_2002
    found = {f.name: f.dataType for f in full(players, 2002).schema.fields}
    assert found == {f.name: f.dataType for f in PLAYERS_SCD.fields}


@pytest.mark.parametrize("options", [{"null_safe": False}, {"chunk": 1}, {"chunk": 2}, {"chunk": 100}])
def test_full_forms_agree(players, options):
    assert rows_of(full(players, 2002, **options), *OUT) == AT_2002


def test_incremental_equals_full(players):
    step = scd.scd2_incremental(full(players, 2001), players, KEY, TRACKED, 2002)
    assert rows_of(step, *OUT) == AT_2002
    assert {r.current_season for r in step.collect()} == {2002}


def test_incremental_parts(players):
    closed, last = scd.scd2_split(full(players, 2001), 2001)
    now = players.filter("current_season = 2002")
    assert rows_of(closed, *OUT) == [("A", "bad", True, 2000, 2000), ("B", "good", True, 2000, 2000)]
    assert rows_of(scd.scd2_unchanged(last, now, KEY, TRACKED), *OUT) == [("A", "star", True, 2001, 2002)]
    assert rows_of(scd.scd2_changed(last, now, KEY, TRACKED), *OUT) == [
        ("B", "good", False, 2001, 2001),
        ("B", "good", True, 2002, 2002),
        ("D", "star", False, 2002, 2002),
        ("D", "star", True, 2001, 2001),
    ]
    assert rows_of(scd.scd2_new(last, now, KEY, TRACKED), *OUT) == [("C", "bad", True, 2002, 2002)]


def test_incremental_with_an_absent_entity(players):
    present = players.filter("not (player_name = 'D' and current_season = 2002)")
    step = scd.scd2_incremental(full(players, 2001), present, KEY, TRACKED, 2002)
    assert rows_of(step.filter("player_name = 'D'")) == []
    with pytest.raises(Exception, match="no row in period 2002 for D"):
        scd.scd2_incremental(
            full(players, 2001), present, KEY, TRACKED, 2002, missing="raise"
        ).collect()
    whole = scd.scd2_incremental(full(players, 2001), players, KEY, TRACKED, 2002, missing="raise")
    assert rows_of(whole, *OUT) == AT_2002


def test_incremental_refuses_a_missing_past(players):
    later = players.filter("current_season = 2002").withColumn("current_season", F.lit(2003))
    with pytest.raises(Exception, match="no snapshot of period 2002"):
        scd.scd2_incremental(full(players, 2000), later, KEY, TRACKED, 2003).collect()
    anew = scd.scd2_incremental(full(players, 2000), later, KEY, TRACKED, 2003, first=True)
    assert anew.count() == later.count()


def test_asof_with_open_and_far_ends(spark, players):
    """The same records whether their open ends are a period, NULL, far or very far."""
    facts = players.select("player_name", F.col("current_season").alias("season"))
    records = full(players, 2002)
    real = scd.scd2_asof(facts, records, KEY, "season", TRACKED)
    expected = rows_of(real, KEY, "season", "start_season", *TRACKED)
    very_far = scd.scd2_open_end(records, "far_future").withColumn(
        "end_season", F.when(F.col("is_open"), 99_991_231).otherwise(F.col("end_season"))
    )
    for style in (scd.scd2_open_end(records), scd.scd2_open_end(records, "far_future"), very_far):
        for width in (1, 8):
            held = scd.scd2_asof(facts, style, KEY, "season", TRACKED, width)
            assert rows_of(held, KEY, "season", "start_season", *TRACKED) == expected


NULLS = "player_name string, current_season int, scoring_class string, is_active boolean"


def test_null_values(spark):
    """NULL is a value when null-safe. If not, it hides the change in the full build, where
    values still keep their groups, and loses the row in the incremental one."""
    rows = [("X", 1, "a", True), ("X", 2, None, True), ("X", 3, "a", True), ("X", 4, "a", True)]
    df = spark.createDataFrame(rows, NULLS)
    assert rows_of(full(df, 4), *OUT) == sorted(
        [("X", "a", True, 1, 1), ("X", None, True, 2, 2), ("X", "a", True, 3, 4)], key=repr
    )
    assert rows_of(full(df, 4, chunk=2), *OUT) == rows_of(full(df, 4), *OUT)
    assert rows_of(full(df, 4, null_safe=False), *OUT) == sorted(
        [("X", "a", True, 1, 4), ("X", None, True, 2, 2)], key=repr
    )
    first = full(df, 1)
    safe = scd.scd2_incremental(first, df, KEY, TRACKED, 2)
    assert rows_of(safe, *OUT) == sorted([("X", "a", True, 1, 1), ("X", None, True, 2, 2)], key=repr)
    assert scd.scd2_incremental(first, df, KEY, TRACKED, 2, null_safe=False).count() == 0


def test_ranges_end_with_their_last_row(spark):
    """Where periods are missing, a range ends with its last row, not before the next one."""
    rows = [("X", 1, "a", True), ("X", 5, "a", True), ("X", 9, "b", True), ("X", 10, "b", True)]
    df = spark.createDataFrame(rows, NULLS)
    expected = [("X", "a", True, 1, 5), ("X", "b", True, 9, 10)]
    for options in ({}, {"null_safe": False}, {"chunk": 3}):
        assert rows_of(full(df, 10, **options), *OUT) == expected


def test_streaks_and_preview(players):
    streaks = scd.with_streaks(players.select(KEY, PERIOD, *TRACKED), KEY, PERIOD, TRACKED)
    assert rows_of(streaks, KEY, PERIOD, "change_indicator", "streak_identifier") == [
        ("A", 2000, 0, 0), ("A", 2001, 1, 1), ("A", 2002, 0, 1),
        ("B", 2000, 0, 0), ("B", 2001, 1, 1), ("B", 2002, 1, 2),
        ("C", 2002, 0, 0), ("D", 2001, 0, 0), ("D", 2002, 1, 1),
    ]
    shown = scd.scd2_preview(players, KEY, PERIOD, TRACKED)
    assert rows_of(shown, *OUT) == [("B", "good", True, 2002, 2002)]
    before = scd.with_previous(players, KEY, PERIOD, TRACKED).filter("player_name = 'B'")
    assert rows_of(before, PERIOD, "previous_scoring_class", "previous_is_active") == [
        (2000, None, None), (2001, "good", True), (2002, "good", False)
    ]


def test_types_0_1_3(players):
    cols = ["scoring_class"]
    assert ("A", "bad") in rows_of(scd.scd0(players, KEY, PERIOD, cols))
    assert ("A", "star") in rows_of(scd.scd1(players, KEY, PERIOD, cols))
    assert ("A", "bad", "star") in rows_of(scd.scd3(players, KEY, PERIOD, cols))


@pytest.mark.parametrize("width", [1, 3, 8])
def test_asof(spark, players, width):
    facts = spark.createDataFrame(
        [(1, "A", 2000), (2, "A", 2002), (3, "B", 2001), (4, "C", 2001), (5, "Z", 2002)],
        "id int, player_name string, season int",
    )
    held = scd.scd2_asof(facts, full(players, 2002), KEY, "season", TRACKED, width)
    assert rows_of(held, "id", *TRACKED, "start_season") == [
        (1, "bad", True, 2000),
        (2, "star", True, 2001),
        (3, "good", False, 2001),
        (4, None, None, None),
        (5, None, None, None),
    ]


def test_open_end(players):
    records = full(players, 2002)
    null = scd.scd2_open_end(records).filter("player_name = 'A'")
    assert rows_of(null, "start_season", "end_season", "is_open") == [
        (2000, 2000, False), (2001, None, True)
    ]
    far = scd.scd2_open_end(records, "far_future").filter("is_open")
    assert {r.end_season for r in far.collect()} == {9999}
    with pytest.raises(ValueError):
        scd.scd2_open_end(records, "other")


def test_ranges_cover_the_spine_without_overlap(players):
    spread = full(players, 2002).select(
        KEY, F.explode(F.sequence("start_season", "end_season")).alias(PERIOD), *TRACKED
    )
    rows = players.select(KEY, PERIOD, *TRACKED)
    assert rows_of(spread) == rows_of(rows)
