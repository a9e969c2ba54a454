"""Operators on random inputs against plain Python."""

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tallybook.operators import cumulative as cu
from tallybook.operators import facts, scd
from tallybook.schemas import PLAYER_HISTORY, HistorySpec

KEY, PERIOD, TRACKED = "player_name", "current_season", ["scoring_class", "is_active"]
RANGES = [KEY, *TRACKED, "start_season", "end_season"]


def random_snapshots(seed, gaps):
    rng = random.Random(seed)
    rows = []
    for entity in range(150):
        periods = range(rng.randint(1, 12), rng.randint(12, 40))
        label, active = "a", True
        for p in periods:
            if rng.random() < 0.3:
                label = rng.choice(["a", "b", None])
            if rng.random() < 0.2:
                active = rng.choice([True, False])
            if not (gaps and rng.random() < 0.3):
                rows.append((f"e{entity}", p, label, active))
    rng.shuffle(rows)
    return rows


def brute_ranges(rows, upto):
    out = []
    rows = sorted((r for r in rows if r[1] <= upto), key=lambda r: (r[0], r[1]))
    for (name, label, active), run in groupby(rows, key=lambda r: (r[0], r[2], r[3])):
        run = list(run)
        out.append((name, label, active, run[0][1], run[-1][1]))
    return sorted(out, key=repr)


def collected(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "player_name string, current_season int, scoring_class string, is_active boolean"
    )


@pytest.mark.parametrize("gaps", [False, True])
def test_full_history(spark, gaps):
    rows = random_snapshots(1, gaps)
    df = frame(spark, rows)
    for chunk in (None, 1, 7):
        got = scd.scd2_full(df, KEY, PERIOD, TRACKED, 30, chunk=chunk)
        assert collected(got, *RANGES) == brute_ranges(rows, 30)


def test_incremental_follows_full(spark):
    """Period by period on entities that, once known, have a row in every period."""
    rng = random.Random(2)
    rows = []
    for entity in range(60):
        label = "a"
        for p in range(rng.randint(1, 5), 7):
            label = rng.choice([label, "a", "b", None])
            rows.append((f"e{entity}", p, label, rng.random() < 0.7))
    df = frame(spark, rows).cache()
    history = scd.scd2_full(df, KEY, PERIOD, TRACKED, 1)
    for p in range(2, 7):
        history = scd.scd2_incremental(history, df, KEY, TRACKED, p)
        assert collected(history, *RANGES) == brute_ranges(rows, p)


def test_asof(spark):
    rows = random_snapshots(4, gaps=True)
    records = scd.scd2_full(frame(spark, rows), KEY, PERIOD, TRACKED, 40)
    ranges = brute_ranges(rows, 40)
    rng = random.Random(5)
    asked = [(i, f"e{rng.randint(0, 160)}", rng.randint(0, 45)) for i in range(800)]
    expected = []
    for i, name, p in asked:
        held = [r for r in ranges if r[0] == name and r[3] <= p <= r[4]]
        expected.append((i, held[0][1], held[0][2]) if held else (i, None, None))
    df = spark.createDataFrame(asked, "id int, player_name string, season int")
    for width in (1, 5):
        got = scd.scd2_asof(df, records, KEY, "season", TRACKED, width)
        assert collected(got, "id", *TRACKED) == sorted(expected, key=repr)


SPEC = HistorySpec(attrs=("town",), stats=("season", "pts"), score="pts")


def brute_players(rows, first, last):
    """(name, season, history, class, gap, active) by direct definition."""
    out = []
    by_name = {}
    for name, town, season, pts in rows:
        by_name.setdefault(name, {})[season] = pts
    for name, seasons in by_name.items():
        for p in range(max(first, min(seasons)), last + 1):
            past = [(s, x) for s, x in sorted(seasons.items()) if first <= s <= p]
            score = past[-1][1] if past else None
            label = next((n for n, b in PLAYER_HISTORY.bands if score is not None and score > b), "bad")
            gap = p - past[-1][0] if past else None
            out.append((name, p, str(past), label, gap, None if gap is None else gap == 0))
    return sorted(out, key=repr)


@pytest.mark.parametrize("first,last", [(1, 12), (5, 9), (4, 30)])
def test_backfill_and_snapshots(spark, first, last):
    rng = random.Random(first)
    rows = [
        (f"p{i}", rng.choice(["x", None]), s, rng.choice([None, 5.0, 10.0, 10.5, 16.0, 25.0]))
        for i in range(80)
        for s in rng.sample(range(1, 13), rng.randint(1, 6))
    ]
    df = spark.createDataFrame(rows, "player_name string, town string, season int, pts double")

    def shown(players):
        return sorted(
            (
                (r.player_name, r.current_season, str([(e.season, e.pts) for e in r.season_stats]),
                 r.scoring_class, r.year_since_last_season, r.is_active)
                for r in players.collect()
            ),
            key=repr,
        )

    expected = brute_players(rows, first, last)
    assert shown(cu.cumulative_backfill(df, first, last, SPEC)) == expected
    for period in (first, (first + last) // 2, last):
        one = cu.cumulative_snapshot(df, period, first, SPEC)
        assert shown(one) == [r for r in expected if r[1] == period]


def test_first_row_per_key_with_a_third_of_copies(spark):
    rng = random.Random(8)
    rows = [(7, 7, rng.randint(0, 50), "x") for _ in range(1000)]
    rows += [(rng.randint(0, 300), rng.randint(0, 3), rng.randint(0, 9), rng.choice("ab")) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k int, l int, n int, s string").repartition(8)
    best = {}
    for k, line, n, s in rows:
        best[k, line] = min(best.get((k, line), (n, s)), (n, s))
    got = facts.fact_dedup(df, ["k", "l"], ["n"])
    assert collected(got, "k", "l", "n", "s") == sorted(((*k, *v) for k, v in best.items()), key=repr)
    assert got.filter(F.col("k") == 7).filter(F.col("l") == 7).count() == 1
