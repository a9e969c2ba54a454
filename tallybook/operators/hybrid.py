"""Hybrid dimensions: stable surrogate keys, and the types 4, 6 and 7 that rest on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions import as_list
from tallybook.operators.scd import END, SNAPSHOT, START, Key, scd2_full
from tallybook.sources.shared import staged


def surrogate_keys(
    df: DataFrame, natural: Key, known: DataFrame | None = None, name: str = "surrogate_key"
) -> DataFrame:
    """One row per natural key with a number of its own, from 1 on.

    Keys in ``known``, an earlier result, keep their numbers for good. New ones follow the
    greatest number in the order of the natural key, NULL first, so a rerun over the same rows
    gives the same numbers, however they are spread.

    Numbers are given in parallel: the distinct new keys are dealt out by ranges of their order and
    written, each range numbers its own, and raises them by the rows of the ranges before it, of
    which there is one small row each.
    """
    keys = as_list(natural)
    new = df.select(*keys).distinct()
    if known is not None:
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
        new = new.alias("n").join(known.select(*keys).alias("o"), same, "left_anti")
    order = [F.col(k).asc_nulls_first() for k in keys]
    ranged = staged(new.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "new-keys")
    over_ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("_range").count().select(
        "_range", F.coalesce(F.sum("count").over(over_ranges), F.lit(0)).alias("_before")
    )
    taken = F.lit(0).cast("bigint")
    if known is not None:
        taken = known.agg(F.coalesce(F.max(name), F.lit(0).cast("bigint"))).scalar()
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    numbered = ranged.withColumn("_own", own).join(before, "_range").select(
        *keys, (F.col("_own") + F.col("_before") + taken).cast("bigint").alias(name)
    )
    return numbered if known is None else known.select(*keys, name).unionByName(numbered)


def scd4(
    df: DataFrame,
    key: Key,
    period: str,
    banded: Sequence[str],
    known: DataFrame | None = None,
    name: str = "profile_key",
) -> tuple[DataFrame, DataFrame]:
    """Type 4: (mini-dimension, history) of fast-changing attributes, given in bands.

    The mini-dimension has a row and a key for every combination of the ``banded`` columns that
    occurs, so its size is bounded by the bands. The history has a record for each stretch of
    periods in which an entity's combination stays, with its key in place of the attributes. Rows
    are unique on (key, period). ``known``, an earlier mini-dimension, keeps its keys.
    """
    mini = surrogate_keys(df, banded, known, name)
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"m.{c}")) for c in banded]
    keyed = df.alias("f").join(mini.alias("m"), same).select(*[F.col(f"f.{k}").alias(k) for k in (*as_list(key), period)], name)
    last = keyed.agg(F.max(period)).scalar()
    history = scd2_full(keyed, key, period, [name], last).drop(SNAPSHOT)
    return mini, history


def scd6(records: DataFrame, key: Key, tracked: Sequence[str]) -> DataFrame:
    """Type 6: type 2 records with ``current_<column>`` from the entity's latest record beside the
    values of their own time, and ``is_current``. One exchange on the key, which the type 2 build
    already has; an entity's records are few."""
    entity = Window.partitionBy(*as_list(key))
    latest = F.max(START).over(entity)
    now = {f"current_{c}": F.max_by(c, START).over(entity) for c in tracked}
    return records.withColumns({**now, "is_current": F.col(START) == latest})


def scd7(
    records: DataFrame,
    key: Key,
    known: tuple[DataFrame, DataFrame] | None = None,
) -> tuple[DataFrame, tuple[DataFrame, DataFrame]]:
    """Type 7: (records with ``record_key`` and ``durable_key``, the key tables to pass as ``known``).

    A record's key is that of its entity and start, so it stays when the record's end moves; the
    durable key is the entity's own. Facts that carry both join the values of their time and the
    current ones.
    """
    of_entity, of_record = known or (None, None)
    durable = surrogate_keys(records, key, of_entity, "durable_key")
    by_record = surrogate_keys(records, [*as_list(key), START], of_record, "record_key")
    keyed = records.join(durable, as_list(key)).join(by_record, [*as_list(key), START])
    columns: list[str | Column] = [*as_list(key), *[c for c in records.columns if c not in as_list(key)]]
    return keyed.select(*columns, "record_key", "durable_key"), (durable, by_record)
