"""Activity as bit history: the periods in which an entity was active, as one integer.

Bit 0 stands for the current period, bit n for the one n periods before. A step to the next period
shifts all bits by one; activity over any window is a mask and a count of bits. An entity costs
eight bytes whatever it did, and rows of facts need no more than one aggregate with a map-side half.
The history reaches back ``HORIZON`` periods; older ones drop out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions import as_list
from tallybook.operators.checks import failing_without
from tallybook.operators.scd import Key

# Periods of a history; the sign bit stays free.
HORIZON = 63


def _bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n.cast("int"))


def _mask(n: int) -> Column:
    if not 1 <= n <= HORIZON:
        raise ValueError(f"a window has 1 to {HORIZON} periods")
    return F.lit((1 << n) - 1).cast("bigint")


def activity_bits(facts: DataFrame, key: Key, period: str, as_of: int) -> DataFrame:
    """(key, as_of, activity): the bits of every entity with a fact up to ``as_of``.

    Any number of facts of one entity and period is one bit. Facts after ``as_of``, or without a
    key or period, take no part; one known only from before the horizon has no bit set.
    """
    keys = as_list(key)
    rows = facts.select(*keys, (F.lit(as_of) - F.col(period)).alias("_age")).filter(F.col("_age") >= 0)
    rows = rows.dropna(subset=keys)
    bit = F.when(F.col("_age") < HORIZON, _bit(F.col("_age"))).otherwise(F.lit(0).cast("bigint"))
    bits = rows.groupBy(*keys).agg(F.bit_or(bit).alias("activity"))
    return bits.select(*keys, F.lit(as_of).alias("as_of"), "activity")


def activity_step(
    before: DataFrame, facts: DataFrame, key: Key, period: str, as_of: int, first: bool = False
) -> DataFrame:
    """The rows of ``activity_bits`` for ``as_of`` from those of the period before and the facts of
    ``as_of`` alone: shifted by one, with the new bit. Both sides have a row per entity when they
    meet. Without rows of the period before the query fails; ``first`` allows it."""
    keys = as_list(key)
    old = before.filter(F.col("as_of") == as_of - 1).select(*keys, F.col("activity").alias("_old"))
    new = facts.filter(F.col(period) == as_of).select(*keys).dropna().distinct().withColumn("_new", F.lit(1).cast("bigint"))
    if not first:
        new = failing_without(old, new, f"no activity of period {as_of - 1}")
    shifted = F.shiftleft(F.coalesce("_old", F.lit(0).cast("bigint")), 1).bitwiseAND(_mask(HORIZON))
    activity = shifted.bitwiseOR(F.coalesce("_new", F.lit(0).cast("bigint")))
    return old.join(new, keys, "full_outer").select(*keys, F.lit(as_of).alias("as_of"), activity.alias("activity"))


def active_periods(activity: Column, window: int = HORIZON) -> Column:
    """In how many of the last ``window`` periods the entity was active."""
    return F.bit_count(activity.bitwiseAND(_mask(window)))


def active_in(activity: Column, age: int) -> Column:
    """Whether it was active ``age`` periods ago."""
    return F.shiftright(activity, age).bitwiseAND(F.lit(1).cast("bigint")) == 1


def periods_since(activity: Column) -> Column:
    """Periods since the last active one; NULL if none is within the horizon."""
    lowest = activity.bitwiseAND(-activity)
    return F.when(activity != 0, F.bit_count(lowest - 1))


def longest_run(activity: Column) -> Column:
    """Length of the longest run of active periods, of the ones between the zeros of its digits."""
    runs = F.split(F.bin(activity), "0")
    return F.array_max(F.transform(runs, lambda x: F.length(x)))


def is_returning(activity: Column, pause: int) -> Column:
    """Active now, not in the ``pause`` periods before, and active before that."""
    between = _mask(pause + 1).bitwiseXOR(F.lit(1).cast("bigint"))
    older = F.shiftright(activity, pause + 1)
    return active_in(activity, 0) & (activity.bitwiseAND(between) == 0) & (older != 0)


def retention(bits: DataFrame) -> DataFrame:
    """(cohort, n, entities, returned): of the entities first active in a period within the horizon,
    how many were active n periods later, for every n up to ``as_of``. One row per entity is
    spread over its at most ``HORIZON`` later periods and summed map-side."""
    oldest = F.length(F.bin("activity")) - 1
    seen = bits.filter("activity <> 0").select("as_of", "activity", oldest.alias("_oldest"))
    spread = seen.select(
        (F.col("as_of") - F.col("_oldest")).alias("cohort"),
        "activity",
        "_oldest",
        F.explode(F.sequence(F.lit(0), F.col("_oldest"))).alias("n"),
    )
    active = F.call_function("shiftright", F.col("activity"), F.col("_oldest") - F.col("n"))
    return spread.groupBy("cohort", "n").agg(
        F.count(F.lit(1)).alias("entities"), F.sum(active.bitwiseAND(F.lit(1).cast("bigint"))).alias("returned")
    )
