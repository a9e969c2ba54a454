import pytest
from pyspark.sql import functions as F

from tallybook.operators import dims
from tests.fixtures import rows_of


@pytest.fixture
def rides(spark):
    """Driver 1 uses two cars on day 1; the home town is one per driver."""
    return spark.createDataFrame(
        [
            (1, "car", "X", 1, 5), (1, "van", "X", 1, 7), (2, "car", "Y", 1, 1),
            (1, "car", "X", 2, 2), (2, "car", "Y", 2, 4), (2, "car", "Y", 2, 4),
            (None, "car", "Y", 2, 3),
        ],
        "driver int, kind string, town string, day int, km int",
    )


def test_additivity(rides):
    kind = dims.additivity_check(rides, "driver", "kind").collect()[0]
    assert tuple(kind) == (3, 2, 1, False)
    town = dims.additivity_check(rides, "driver", "town").collect()[0]
    assert tuple(town) == (2, 2, 0, True)
    by_day = dims.additivity_check(rides, "driver", "kind", "day")
    assert rows_of(by_day) == [(1, 3, 2, 1, False), (2, 2, 2, 0, True)]


def test_additivity_of_nothing(rides):
    assert tuple(dims.additivity_check(rides.limit(0), "driver", "kind").collect()[0]) == (0, 0, 0, True)


def test_rollup(rides):
    by_town = dims.entity_counts(rides, ["kind", "town"], "driver", ["km"])
    summed = dims.additive_rollup(by_town, ["kind"], ["km"], dims.additivity_checks(rides, "driver", ["town"]))
    assert rows_of(summed, "kind", "km", "entities") == [("car", 19, 2), ("van", 7, 1)]
    by_kind = dims.entity_counts(rides, ["day", "kind"], "driver", ["km"])
    for checked in (
        dims.additivity_checks(rides, "driver", ["kind"]),
        dims.additivity_checks(rides, "driver", ["kind", "town"]),
        dims.additivity_checks(rides, "driver", ["town"]),  # additive, but another dimension goes
        dims.additivity_checks(rides, "driver", ["kind"]).limit(0),
    ):
        with pytest.raises(Exception, match="not additive"):
            dims.additive_rollup(by_kind, ["day"], ["km"], checked).collect()
    with pytest.raises(ValueError, match="name its dimension"):
        dims.additive_rollup(by_kind, ["day"], ["km"], dims.additivity_check(rides, "driver", "town"))
    right = dims.entity_counts(rides, ["day"], "driver", ["km"])
    assert rows_of(right, "day", "km", "entities") == [(1, 13, 2), (2, 13, 2)]


def test_several_dimensions_at_once(spark, rides):
    rows = rides.unionByName(rides.limit(1).withColumn("kind", F.lit(None).cast("string")))
    together = {r.dimension: tuple(r)[1:] for r in dims.additivity_checks(rows, "driver", ["kind", "town", "day"]).collect()}
    for dim in ("kind", "town", "day"):
        assert together[dim] == tuple(dims.additivity_check(rows, "driver", dim).collect()[0])


def test_enums(spark, rides, tmp_path):
    bad = dims.enum_validate(rides, {"kind": ["car"], "town": ["X", "Y"], "day": [1]})
    assert rows_of(bad, "column_name", "value", "n_rows") == [("day", "2", 4), ("kind", "van", 1)]
    wide = spark.range(99).select("id", (F.col("id") % 49).alias("few"), (F.col("id") % 50).alias("many"))
    guess = dims.enum_candidates(wide.withColumn("three", F.col("id") % 3), ["id", "three"], exact=False)
    assert rows_of(guess, "column_name", "is_candidate") == [("id", False), ("three", True)]
    edge = dims.enum_candidates(wide, ["few", "many"])
    assert rows_of(edge) == [("few", 49, True), ("many", 50, False)]
    parts = dims.enum_subpartition(rides, str(tmp_path / "e"), "day", "kind", ["car", "van"])
    assert rows_of(parts, "day", "kind", "n_rows", "is_missing") == [
        (1, "car", 2, False), (1, "van", 1, False), (2, "car", 4, False), (2, "van", 0, True)
    ]


def test_enum_members_that_look_like_numbers(spark, tmp_path):
    df = spark.createDataFrame([(1, "01"), (1, "1")], "day int, kind string")
    parts = dims.enum_subpartition(df.withColumn("x", F.lit(1)), str(tmp_path / "e"), "day", "kind", ["01", "1"])
    assert rows_of(parts, "kind", "n_rows") == [("01", 1), ("1", 1)]


def test_members_outside_the_domain_are_listed(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0), (1, "z", 0), (2, None, 0), (2, None, 0)], "day int, kind string, x int")
    parts = dims.enum_subpartition(df, str(tmp_path / "e"), "day", "kind", ["a", "b"])
    assert rows_of(parts, "day", "kind", "n_rows", "is_missing", "in_domain") == sorted(
        [
            (1, "a", 1, False, True), (1, "b", 0, True, True), (1, "z", 1, False, False),
            (2, "a", 0, True, True), (2, "b", 0, True, True), (2, None, 2, False, False),
        ],
        key=repr,
    )


def test_shared_schema(spark):
    apps = spark.createDataFrame([(1, "web", None)], "app_id int, label string, lang string")
    dbs = spark.createDataFrame([(1, "main", 5)], "db_id int, label string, size int")
    one = dims.shared_schema(
        {
            "app": (apps, "app_id", {"name": F.col("label"), "lang": F.col("lang")}),
            "db": (dbs, "db_id", {"name": F.col("label"), "size": F.col("size"), "owner": F.lit("me")}),
        },
        common=["name", "owner"],
    )
    assert one.columns == ["id", "type", "name", "owner", "properties"]
    assert rows_of(one) == sorted(
        [("1", "app", "web", None, {}), ("1", "db", "main", "me", {"size": "5"})], key=repr
    )


def test_flexible_schema(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "b", 4)], "id int, x string, y int")
    folded = dims.flexible_schema(df, ["id"], ["x", "y"])
    assert rows_of(folded) == [(1, {"x": "a"}), (2, {}), (3, {"x": "b", "y": "4"})]
    back = folded.select("id", dims.property_value("other_properties", "y", "int").alias("y"))
    assert rows_of(back) == [(1, None), (2, None), (3, 4)]
