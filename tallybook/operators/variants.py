"""Flexible schemas as VARIANT: properties that keep their types, and the columns that earn a place
of their own by how often they are filled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.sources.shared import staged

PROPERTIES = "properties"
# A key filled in this share of the rows is worth a column.
MIN_FILL = 0.5


def _bag(name: str) -> Column:
    return F.col(name).cast("map<string,variant>")


def fold_properties(
    df: DataFrame, keep: Sequence[str], fold: Sequence[str], name: str = PROPERTIES
) -> DataFrame:
    """``keep``, and the filled ones of ``fold`` in one VARIANT, with their types.

    Decimals lose zeros at their end, nothing else changes; a row without any has an empty object.
    """
    return df.select(*keep, _object({c: F.col(c) for c in fold}).alias(name))


def _object(columns: Mapping[str, Column]) -> Column:
    """A VARIANT of the columns that are filled."""
    if not columns:
        return F.parse_json(F.lit("{}"))
    names = F.array(*[F.lit(n) for n in columns])
    values = F.array(*[F.to_variant_object(F.struct(c.alias("v"))) for c in columns.values()])
    inner = F.transform(values, lambda v: F.variant_get(v, "$.v", "variant"))
    filled = F.map_filter(F.map_from_arrays(names, inner), lambda _, v: _is_filled(v))
    return F.to_variant_object(filled)


def _is_filled(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


def parse_properties(df: DataFrame, json_col: str, name: str = PROPERTIES) -> DataFrame:
    """A text column of JSON as VARIANT; NULL where it is not valid or no object."""
    parsed = F.try_parse_json(json_col)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    return df.withColumn(name, F.when(is_object, parsed))


def property_of(name: str, key: str, kind: str) -> Column:
    """One key as a column; NULL where it is absent or does not fit the type."""
    return F.try_variant_get(F.try_element_at(_bag(name), F.lit(key)), "$", kind)


def _fits(name: str, key: str, kind: str) -> Column:
    """Text that looks like a number is no number, and a number no text."""
    held = F.schema_of_variant(F.try_element_at(_bag(name), F.lit(key)))
    return (held == "STRING") == F.lit(kind.upper() == "STRING")


def value_of(df: DataFrame, key: str, kind: str, name: str = PROPERTIES) -> Column:
    """A key wherever it is: in its column, or in the VARIANT."""
    return F.col(key).cast(kind) if key in df.columns else property_of(name, key, kind)


def fill_rates(df: DataFrame, name: str = PROPERTIES) -> DataFrame:
    """Per key: n_filled, fill_rate over all rows, and the type that holds all its values.

    One pass, written: each row also sends an entry without a key, which counts the rows. A key
    whose value is JSON's null is not filled.
    """
    none = F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("variant").alias("value"))
    entries = F.map_entries(F.map_filter(_bag(name), lambda _, v: _is_filled(v)))
    empty = F.array().cast("array<struct<key:string,value:variant>>")
    entry = F.explode(F.concat(F.array(none), F.coalesce(entries, empty)))
    keys = df.select(entry.alias("e")).groupBy(F.col("e.key").alias("key")).agg(
        F.count(F.lit(1)).alias("n_filled"), F.schema_of_variant_agg("e.value").alias("value_type")
    )
    keys = staged(keys, "keys")
    rate = F.col("n_filled") / keys.filter("key is null").select("n_filled").scalar()
    return keys.filter("key is not null").withColumn("fill_rate", rate)


def promoted_keys(df: DataFrame, min_fill: float = MIN_FILL, name: str = PROPERTIES) -> dict[str, str]:
    """The keys that are filled often enough, with their types, most filled first.

    There are at most 1 / ``min_fill`` times as many as a row has keys on average. Keys whose
    values have no common type, or are objects, stay where they are.
    """
    if min_fill <= 0:
        raise ValueError("min_fill must be above 0, which bounds the number of columns")
    plain = ~F.col("value_type").rlike("VARIANT|OBJECT|VOID")
    often = fill_rates(df, name).filter((F.col("fill_rate") >= min_fill) & plain)
    found = often.select("key", "n_filled", "value_type").collect()
    return {r["key"]: r["value_type"] for r in sorted(found, key=lambda r: (-r["n_filled"], r["key"]))}


def promote(df: DataFrame, keys: Mapping[str, str], name: str = PROPERTIES) -> DataFrame:
    """``keys`` as typed columns; the VARIANT keeps the others, and what does not fit its column.

    A key that is a column's name already fails. Written as Parquet, a query on promoted columns
    reads these alone.
    """
    clash = [k for k in keys if k in df.columns]
    if clash:
        raise ValueError(f"columns exist already: {clash}")
    columns = {k: F.when(_fits(name, k, kind), property_of(name, k, kind)) for k, kind in keys.items()}
    moved = F.array(*[F.when(c.isNotNull(), F.lit(k)) for k, c in columns.items()])
    left = F.map_filter(_bag(name), lambda k, _: ~F.array_contains(F.array_compact(moved), k))
    rest = F.to_variant_object(left).alias(name) if keys else F.col(name)
    return df.select(
        *[c for c in df.columns if c != name], *[c.alias(k) for k, c in columns.items()], rest
    )


def demote(df: DataFrame, keys: Sequence[str], name: str = PROPERTIES) -> DataFrame:
    """The columns ``keys`` back in the VARIANT, where they are filled. What the VARIANT kept of a
    key, because it did not fit the column, stays."""
    added = _object({k: F.col(k) for k in keys}).cast("map<string,variant>")
    before = F.map_filter(_bag(name), lambda k, _: ~F.array_contains(F.map_keys(added), k))
    bag = F.when(before.isNotNull(), F.map_concat(before, added)).when(F.size(added) > 0, added)
    merged = F.to_variant_object(bag)
    return df.select(*[c for c in df.columns if c not in (name, *keys)], merged.alias(name))
