"""Surrogate keys and the hybrid types of dimensions."""

import random

from pyspark.sql import functions as F

from tallybook.operators import hybrid, scd
from tests.fixtures import rows_of


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k string")


def test_keys_follow_the_order_and_stay(spark):
    draw = random.Random(2)
    first = [f"n{draw.randrange(500):03}" for _ in range(900)] + [None]
    keys = hybrid.surrogate_keys(names(spark, first), "k")
    in_order = [None, *sorted({x for x in first if x})]
    assert sorted(rows_of(keys, "surrogate_key", "k")) == [(i + 1, k) for i, k in enumerate(in_order)]
    again = hybrid.surrogate_keys(names(spark, first[::-1]).repartition(13), "k")
    assert rows_of(again) == rows_of(keys)

    more = [f"m{i}" for i in range(20)] + first[:50]
    grown = hybrid.surrogate_keys(names(spark, more), "k", keys)
    assert rows_of(grown.filter(F.col("surrogate_key") <= len(in_order))) == rows_of(keys)
    new = grown.filter(F.col("surrogate_key") > len(in_order))
    assert rows_of(new, "surrogate_key", "k") == [(len(in_order) + i + 1, k) for i, k in enumerate(sorted(more[:20]))]
    assert rows_of(hybrid.surrogate_keys(names(spark, more), "k", grown)) == rows_of(grown)


def test_keys_of_several_columns_and_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "a"), (1, "a")], "p int, q string")
    got = hybrid.surrogate_keys(df, ["p", "q"], name="sk")
    assert rows_of(got, "sk", "p", "q") == [(1, None, "a"), (2, 1, None), (3, 1, "a")]
    assert hybrid.surrogate_keys(df.limit(0), ["p", "q"]).count() == 0
    assert rows_of(hybrid.surrogate_keys(df.limit(0), ["p", "q"], got, "sk")) == rows_of(got)


def test_a_key_with_most_rows_is_one_key(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    got = hybrid.surrogate_keys(df, "k")
    assert got.count() == got.select("surrogate_key").distinct().count() == 16_668
    assert got.agg(F.max("surrogate_key")).first()[0] == 16_668


def test_mini_dimension(spark):
    rows = [("a", 1, "x", 1), ("a", 2, "x", 1), ("a", 3, None, 1), ("a", 4, "x", 1), ("b", 2, None, 1), ("b", 3, None, 1)]
    df = spark.createDataFrame(rows, "k string, t int, band string, size int")
    mini, history = hybrid.scd4(df, "k", "t", ["band", "size"])
    assert rows_of(mini, "profile_key", "band", "size") == [(1, None, 1), (2, "x", 1)]
    assert rows_of(history, "k", "profile_key", "start_season", "end_season") == [
        ("a", 1, 3, 3), ("a", 2, 1, 2), ("a", 2, 4, 4), ("b", 1, 2, 3),
    ]
    later = df.unionByName(spark.createDataFrame([("c", 4, "a", 9)], df.schema))
    grown, _ = hybrid.scd4(later, "k", "t", ["band", "size"], mini)
    assert rows_of(grown, "profile_key", "band", "size") == [(1, None, 1), (2, "x", 1), (3, "a", 9)]


RECORDS = [("a", "x", True, 1, 2, 4), ("a", None, True, 3, 4, 4), ("b", "y", False, 2, 4, 4)]
SHAPE = "k string, scoring_class string, is_active boolean, start_season int, end_season int, current_season int"


def test_current_values_beside_old_ones(spark):
    got = hybrid.scd6(spark.createDataFrame(RECORDS, SHAPE), "k", ["scoring_class", "is_active"])
    assert rows_of(got, "k", "start_season", "scoring_class", "current_scoring_class", "is_current") == [
        ("a", 1, "x", None, False), ("a", 3, None, None, True), ("b", 2, "y", "y", True),
    ]


def test_record_and_durable_keys_stay_over_increments(spark):
    before = spark.createDataFrame(RECORDS, SHAPE)
    keyed, known = hybrid.scd7(before, "k")
    assert rows_of(keyed, "k", "start_season", "record_key", "durable_key") == [("a", 1, 1, 1), ("a", 3, 2, 1), ("b", 2, 3, 2)]
    now = [("a", 5, "x", True), ("b", 5, "y", False), ("0", 5, "z", True)]
    current = spark.createDataFrame(now, "k string, current_season int, scoring_class string, is_active boolean")
    after = scd.scd2_incremental(before, current, "k", ["scoring_class", "is_active"], 5)
    keyed, _ = hybrid.scd7(after, "k", known)
    assert rows_of(keyed, "k", "start_season", "end_season", "record_key", "durable_key") == [
        ("0", 5, 5, 4, 3), ("a", 1, 2, 1, 1), ("a", 3, 4, 2, 1), ("a", 5, 5, 5, 1), ("b", 2, 5, 3, 2),
    ]
