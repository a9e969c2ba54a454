"""Flexible schemas as VARIANT: types kept, columns by fill rate, and back."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.operators import variants as va
from tests.fixtures import rows_of

ROWS = "id int, a bigint, b date, c string, d decimal(9,3), e array<int>"


def bag(spark):
    day = datetime.date(2020, 1, 31)
    rows = [
        (1, 5, day, None, Decimal("1.250"), [1, 2]),
        (2, None, None, "5", None, None),
        (3, 7, day, None, None, []),
        (4, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, ROWS)


def folded(spark):
    return va.fold_properties(bag(spark), ["id"], ["a", "b", "c", "d", "e"])


def keys_of(df):
    return df.select("id", F.array_sort(F.map_keys(F.col("properties").cast("map<string,variant>"))).alias("k"))


def text(df):
    return rows_of(df.select("id", F.to_json("properties").alias("j")))


def test_fold_keeps_types_and_leaves_out_nulls(spark):
    kept = folded(spark)
    assert rows_of(keys_of(kept)) == [(1, ["a", "b", "d", "e"]), (2, ["c"]), (3, ["a", "b", "e"]), (4, [])]
    kinds = {"a": "bigint", "b": "date", "c": "string", "d": "decimal(9,3)", "e": "array<int>"}
    back = kept.select("id", *[va.property_of("properties", k, t).alias(k) for k, t in kinds.items()])
    assert rows_of(back) == rows_of(bag(spark))


def test_fill_rates(spark):
    rates = {r["key"]: (r["n_filled"], r["fill_rate"], r["value_type"]) for r in va.fill_rates(folded(spark)).collect()}
    assert rates["a"] == (2, 0.5, "BIGINT")
    assert rates["b"] == (2, 0.5, "DATE")
    assert rates["c"] == (1, 0.25, "STRING")
    assert rates["e"] == (2, 0.5, "ARRAY<BIGINT>")


@pytest.mark.parametrize("min_fill", [0.1, 0.5, 1.0])
def test_round_trip(spark, min_fill):
    before = folded(spark)
    keys = va.promoted_keys(before, min_fill)
    promoted = va.promote(before, keys)
    assert set(promoted.columns) == {"id", "properties", *keys}
    assert not any(set(r["k"]) & set(keys) for r in keys_of(promoted).collect())
    assert text(va.demote(promoted, list(keys))) == text(before)


def test_promoted_columns_have_their_types(spark):
    before = folded(spark)
    kinds = dict(va.promote(before, va.promoted_keys(before, 0.5)).dtypes)
    assert kinds["a"] == "bigint" and kinds["b"] == "date" and kinds["e"] == "array<bigint>"


def test_what_does_not_fit_stays(spark):
    """Text that looks like a number is no number; nulls, arrays and broken text are no bags."""
    rows = [(1, '{"a":1,"z":null}'), (2, "[1]"), (3, "bad"), (4, None), (5, '{"a":"7"}'), (6, '{"a":{"a":1}}')]
    parsed = va.parse_properties(spark.createDataFrame(rows, "id int, j string"), "j").drop("j")
    promoted = va.promote(parsed, {"a": "bigint"})
    assert rows_of(promoted, "id", "a") == [(1, 1), (2, None), (3, None), (4, None), (5, None), (6, None)]
    assert text(va.demote(promoted, ["a"])) == text(parsed)
    assert va.promoted_keys(parsed, 0.1) == {}
    assert {r["key"]: r["n_filled"] for r in va.fill_rates(parsed).collect()} == {"a": 3}


def test_keys_with_odd_names(spark):
    parsed = va.parse_properties(spark.createDataFrame([(1, '{"x.y":1,"a b":2,"$":3,"":4}')], "id int, j string"), "j")
    keys = va.promoted_keys(parsed)
    assert set(keys) == {"x.y", "a b", "$", ""}
    promoted = va.promote(parsed, {k: keys[k] for k in ("x.y", "a b", "$")})
    assert tuple(promoted.select("`x.y`", "`a b`", "`$`").first()) == (1, 2, 3)
    assert keys_of(promoted).first()["k"] == [""]


def test_refusals_and_empty(spark):
    before = folded(spark)
    with pytest.raises(ValueError, match="exist"):
        va.promote(before, {"id": "bigint"})
    with pytest.raises(ValueError, match="above 0"):
        va.promoted_keys(before, 0)
    none = before.filter("id < 0")
    assert va.promoted_keys(none) == {} and va.promote(none, {"a": "bigint"}).collect() == []
    assert va.promote(before, {}).columns == before.columns
    assert text(va.fold_properties(bag(spark), ["id"], [])) == [(i, "{}") for i in (1, 2, 3, 4)]


def test_promoted_columns_are_read_alone(spark, tmp_path):
    before = folded(spark)
    path = str(tmp_path / "promoted")
    va.promote(before, va.promoted_keys(before)).write.parquet(path)
    plan = spark.read.parquet(path).filter("a > 5").select("a")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:bigint>" in plan and "GreaterThan(a,5)" in plan
