"""Distinct counts from mergeable structures."""

import random

import pytest
from pyspark.sql import functions as F

from tallybook.operators import dims
from tests.fixtures import rows_of
from tests.test_plans import no_broadcast, plan  # noqa: F401


def rows(spark, n=4000):
    draw = random.Random(8)
    ids = [0, 1, 32767, 32768, 32769, -1, -40000, 2**40, None] + [draw.randrange(70_000) for _ in range(500)]
    data = [(draw.choice(["a", "b", None]), draw.randrange(4), draw.choice(ids)) for _ in range(n)]
    return spark.createDataFrame(data, "kind string, day int, entity long")


@pytest.mark.parametrize("keep", [["kind"], ["day"], ["kind", "day"], []])
def test_rollup_equals_count_distinct(spark, keep):
    df = rows(spark)
    got = dims.distinct_rollup(dims.distinct_structures(df, ["kind", "day"], "entity"), keep)
    assert rows_of(got) == rows_of(df.groupBy(*keep).agg(F.count_distinct("entity").alias("entities")))


def test_batches_merge(spark):
    df = rows(spark)
    parts = [dims.distinct_structures(df.filter(F.col("day") % 2 == i), ["kind"], "entity") for i in (0, 1)]
    merged = dims.merged_structures(parts[0].unionByName(parts[1]), ["kind"])
    twice = dims.merged_structures(merged.unionByName(parts[0]), ["kind"])
    expected = rows_of(df.groupBy("kind").agg(F.count_distinct("entity").alias("entities")))
    assert rows_of(dims.distinct_rollup(twice, ["kind"])) == expected


def test_rollup_does_not_read_the_grain(spark, tmp_path, no_broadcast):  # noqa: F811
    path = str(tmp_path / "members")
    dims.distinct_structures(rows(spark), ["kind", "day"], "entity").write.parquet(path)
    text = plan(dims.distinct_rollup(spark.read.parquet(path), ["kind"]))
    assert "entity" not in text and "Expand" not in text


def test_a_member_with_most_rows_is_reduced_before_the_exchange(spark, no_broadcast):  # noqa: F811
    df = spark.range(100_000).select(F.lit("hot").alias("kind"), (F.col("id") % 1000 + 1).alias("entity"))
    text = plan(dims.distinct_structures(df, ["kind"], "entity"))
    assert text.count("partial_bitmap_construct_agg") == 1
    assert dims.distinct_structures(df, ["kind"], "entity").count() == 1


def test_empty_and_null_entities(spark):
    df = rows(spark).filter("entity is null")
    structures = dims.distinct_structures(df, ["kind"], "entity")
    assert structures.count() == 0
    assert rows_of(dims.distinct_rollup(structures, [])) == [(0,)]


@pytest.mark.parametrize("kind", ["hll", "theta"])
def test_sketches_are_near(spark, kind):
    df = spark.range(60_000).select((F.col("id") % 3).alias("day"), (F.col("id") % 20_000).alias("entity"))
    sketches = dims.distinct_sketches(df, ["day"], "entity", kind)
    (total,) = dims.sketch_rollup(sketches, [], kind).first()
    assert abs(total - 20_000) / 20_000 < 4 * 1.04 / 64
    text = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "entity string").withColumn("day", F.lit(1))
    assert dims.sketch_rollup(dims.distinct_sketches(text, ["day"], "entity", kind), ["day"], kind).first()["entities"] == 2


def test_overlap_of_members(spark):
    data = [("a", i) for i in range(900)] + [("b", i) for i in range(600, 1500)] + [("c", 5000)]
    sketches = dims.distinct_sketches(spark.createDataFrame(data, "kind string, entity int"), ["kind"], "entity", "theta")
    assert rows_of(dims.sketch_overlap(sketches, "kind")) == [("a", "b", 300), ("a", "c", 0), ("b", "c", 0)]
