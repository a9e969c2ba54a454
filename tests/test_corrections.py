"""Late corrections: replay of a cumulative table, splicing of a type 2 history."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tallybook.operators import cumulative as cu
from tallybook.operators import idempotent as idem
from tallybook.operators import scd
from tallybook.schemas import HistorySpec
from tests.fixtures import rows_of, seasons
from tests.test_plans import final_plan, plan

SPEC = HistorySpec(key="k", attrs=("a",), stats=("season", "pts"), bands=(("high", 5.0),))
FACT = "k string, a string, season int, pts double"
TRACKED = ["scoring_class", "is_active"]
OUT = ["k", *TRACKED, "start_season", "end_season", "current_season"]
FIRST, LAST = 2000, 2009


def facts(draw, n=25, before=True):
    """Some entities are known before the first period, some by that alone."""
    rows = {}
    for i in range(n):
        for year in range(FIRST - 2 if before else FIRST, LAST + 1):
            if draw.random() < 0.35:
                rows[f"e{i}", year] = (f"e{i}", f"a{i}", year, float(draw.randrange(11)))
    return rows


def corrected(draw, rows, since, n=30):
    """Changes, additions (also of new entities) and removals, and the facts they lead to."""
    fixes, after = {}, dict(rows)
    for _ in range(n):
        k, year = f"e{draw.randrange(25)}" if draw.random() < 0.9 else f"n{draw.randrange(3)}", draw.randrange(since, LAST + 1)
        gone = draw.random() < 0.3
        fixes[k, year] = (k, f"a{k[1:]}" if k[0] == "e" else k, year, float(draw.randrange(11)), gone)
    for at, (*fact, gone) in fixes.items():
        after.pop(at, None)
        if not gone:
            after[at] = tuple(fact)
    return list(fixes.values()), list(after.values())


def known_stays_visible(rows, fixes):
    """Leaves out the one case that a table cannot tell: an entity known before the first period
    only, all of whose entries from its first correction on are withdrawn."""
    hidden = set()
    for k in {r[0] for r in rows}:
        years = sorted(r[2] for r in rows if r[0] == k)
        first_fix = min((f[2] for f in fixes if f[0] == k), default=None)
        inside = [y for y in years if y >= FIRST]
        if first_fix is not None and years[0] < FIRST and inside and inside[0] <= first_fix:
            hidden.add(k)
    return hidden


@pytest.mark.parametrize("seed,since", [(1, 2000), (2, 2004), (3, 2009)])
def test_replay_equals_the_backfill_of_corrected_facts(spark, seed, since):
    draw = random.Random(seed)
    before = facts(draw)
    fixes, after = corrected(draw, before, since)
    hidden = known_stays_visible(before.values(), fixes)
    old = cu.cumulative_backfill(spark.createDataFrame(list(before.values()), FACT), FIRST, LAST, SPEC)
    new = cu.cumulative_backfill(spark.createDataFrame(after, FACT), FIRST, LAST, SPEC)
    late = spark.createDataFrame(fixes, FACT + ", gone boolean")
    got = cu.cumulative_replay(old, late, since, FIRST, LAST, SPEC, removed="gone")
    fine = ~F.col("k").isin(sorted(hidden))
    assert got.columns == old.columns
    assert rows_of(got.filter(fine)) == rows_of(new.filter((F.col("current_season") >= since) & fine))
    kept, rewritten, gone = cu.replay_parts(old, late, since, FIRST, LAST, SPEC, removed="gone")
    reached = {f[0] for f in fixes}
    assert not {r.k for r in kept.filter(f"current_season = {LAST}").collect()} & reached
    assert {r.k for r in rewritten.collect()} <= reached and {r.k for r in gone.collect()} <= reached


def stored(spark, tmp_path, rows):
    path = str(tmp_path / "players")
    idem.overwrite_period(cu.cumulative_backfill(rows, 2000, 2002), path, "current_season", idem.ALL)
    return path


def test_replay_reads_no_period_before_and_rewrites_the_table(spark, tmp_path):
    path = stored(spark, tmp_path, seasons(spark))
    late = seasons(spark).filter("player_name = 'A' and season = 2001").withColumn("pts", F.lit(3.0).cast("float"))
    for _ in range(2):  # the second replay changes nothing
        replayed = cu.cumulative_replay(spark.read.parquet(path), late, 2001, 2000, 2002)
        read = {int(x.rsplit("=", 1)[1]) for x in idem.read_partitions(replayed, path)}
        assert read == {2001, 2002}
        with pytest.raises(ValueError, match="2001"):
            idem.overwrite_period(replayed, path, "current_season", [2001, 2002])
        idem.replace_periods(replayed, path, "current_season", [2001, 2002])
        changed = F.when(F.expr("player_name = 'A' and season = 2001"), F.lit(3.0)).otherwise(F.col("pts")).cast("float")
        expected = cu.cumulative_backfill(seasons(spark).withColumn("pts", changed), 2000, 2002)
        assert rows_of(spark.read.parquet(path).select(expected.columns)) == rows_of(expected)


def test_replay_leaves_entities_without_corrections_unshuffled(spark, tmp_path):
    path = stored(spark, tmp_path, seasons(spark))
    late = seasons(spark).filter("player_name = 'A' and season = 2001")
    kept, _, _ = cu.replay_parts(spark.read.parquet(path), late, 2001, 2000, 2002)
    text = final_plan(kept)
    assert "BroadcastHashJoin" in text and "LeftAnti" in text
    assert "SortMergeJoin" not in text


def test_corrections_that_are_refused(spark):
    players = cu.cumulative_backfill(seasons(spark), 2000, 2002)
    a = seasons(spark).filter("player_name = 'A'")
    for late, message in (
        (a.filter("season = 2000"), "outside the bounds"),
        (a.filter("season = 2001").withColumn("season", F.lit(2003)), "outside the bounds"),
        (a.filter("season = 2001").union(a.filter("season = 2001")), "several facts in one period"),
    ):
        with pytest.raises(Exception, match=message):
            cu.cumulative_replay(players, late, 2001, 2000, 2002).collect()
    none = cu.cumulative_replay(players, a.limit(0), 2001, 2000, 2002)
    assert rows_of(none) == rows_of(players.filter("current_season >= 2001"))


# Splicing


def history(spark, rows, upto=LAST):
    df = spark.createDataFrame(rows, "k string, current_season int, scoring_class string, is_active boolean")
    return scd.scd2_full(df, "k", "current_season", TRACKED, upto)


def grid(draw, n=30):
    """One row per entity and period from its first one on, few values, NULL among them."""
    rows = {}
    for i in range(n):
        for year in range(draw.randrange(FIRST, LAST + 1), LAST + 1):
            rows[f"e{i}", year] = (f"e{i}", year, draw.choice(["x", "y", None]), draw.random() < 0.7)
    return rows


@pytest.mark.parametrize("seed,share", [(1, 0.05), (2, 0.3), (3, 0.9)])
def test_splicing_equals_the_full_build(spark, seed, share):
    draw = random.Random(seed)
    rows = grid(draw)
    after, late = dict(rows), []
    for i in range(33):
        for year in range(FIRST, LAST + 1):
            if draw.random() < share:
                gone = draw.random() < 0.25
                value = (f"e{i}", year, draw.choice(["x", "y", None]), True)
                late.append((*value, gone))
                after.pop((f"e{i}", year), None)
                if not gone:
                    after[f"e{i}", year] = value
    fixes = spark.createDataFrame(late, "k string, current_season int, scoring_class string, is_active boolean, gone boolean")
    before = history(spark, list(rows.values()))
    got = scd.scd2_correct(before, fixes, "k", TRACKED, LAST, removed="gone")
    assert rows_of(got, *OUT) == rows_of(history(spark, list(after.values())), *OUT)


def test_splits_moves_and_merges(spark):
    rows = [("s", y, "x", True) for y in range(2000, 2005)]
    rows += [("m", y, "x" if y != 2002 else "y", True) for y in range(2000, 2005)]
    rows += [("v", y, "x" if y < 2002 else "y", True) for y in range(2000, 2005)]
    rows += [("o", y, "x", True) for y in range(2000, 2005)]
    late = [("s", 2002, "y", True), ("m", 2002, "x", True), ("v", 2002, "x", True), ("n", 2003, "z", False)]
    fixes = spark.createDataFrame(late, "k string, current_season int, scoring_class string, is_active boolean")
    got = scd.scd2_correct(history(spark, rows, 2004), fixes, "k", TRACKED, 2004)
    assert rows_of(got, "k", "scoring_class", "start_season", "end_season") == [
        ("m", "x", 2000, 2004),
        ("n", "z", 2003, 2003),
        ("o", "x", 2000, 2004),
        ("s", "x", 2000, 2001),
        ("s", "x", 2003, 2004),
        ("s", "y", 2002, 2002),
        ("v", "x", 2000, 2002),
        ("v", "y", 2003, 2004),
    ]


def test_splicing_refuses_and_ignores(spark):
    rows = [("s", y, "x", True) for y in range(2000, 2005)]
    shape = "k string, current_season int, scoring_class string, is_active boolean"
    before = history(spark, rows, 2004)
    for late, message in (
        ([("s", 2005, "y", True)], "after the snapshot"),
        ([("s", None, "y", True)], "after the snapshot"),
        ([("s", 2001, "y", True), ("s", 2001, "z", True)], "several corrections"),
    ):
        with pytest.raises(Exception, match=message):
            scd.scd2_correct(before, spark.createDataFrame(late, shape), "k", TRACKED, 2004).collect()
    same = scd.scd2_correct(before, spark.createDataFrame([], shape), "k", TRACKED, 2004)
    assert rows_of(same, *OUT) == rows_of(before, *OUT)


def test_only_corrected_entities_are_shuffled(spark, tmp_path):
    path = str(tmp_path / "scd")
    history(spark, list(grid(random.Random(5), 200).values())).write.parquet(path)
    fixes = spark.createDataFrame([("e7", 2009, "z", True)], "k string, current_season int, scoring_class string, is_active boolean")
    fixes.write.parquet(str(tmp_path / "late"))
    fixes = spark.read.parquet(str(tmp_path / "late"))
    got = scd.scd2_correct(spark.read.parquet(path), fixes, "k", TRACKED, LAST)
    text = plan(got)
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    others, own = text.split("Union")[1].split("LeftSemi")[0], text.split("LeftSemi")[0]
    assert "LeftAnti" in others and own.count("Window") >= 2
    # the sweep and the merge share one exchange of the corrected entities' rows
    assert len(re.findall(r"Exchange hashpartitioning\(k#\d+, \d+\), ENSURE", text)) <= 3
