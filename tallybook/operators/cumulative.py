"""Cumulative tables: one row per entity and period, with the whole history as an array.

A history holds at most one entry per period: facts are unique on (key, period), and a query
over facts that are not fails. So no array and no window partition outgrows the number of
periods, however uneven the source is: the hot part of the work, reducing raw rows to that
grain, is a plain aggregate with a map-side half.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions import (
    as_list,
    classify,
    first_entry,
    is_current,
    last_entry,
    recency,
    recency_step,
)
from tallybook.operators.checks import check, failing_without
from tallybook.schemas import PLAYER_HISTORY, HistorySpec


def _unique(facts: DataFrame, spec: HistorySpec) -> Column:
    """True, or the query fails, as the row's key has another row in the same period. Shares
    the exchange and the sort of other windows on the key."""
    by_period = Window.partitionBy(*spec.keys).orderBy(spec.period)
    twice = F.lag(spec.period).over(by_period) == F.col(spec.period)
    return check(~F.coalesce(twice, F.lit(False)), "several facts in one period for", [*spec.keys, spec.period])


def _entry(spec: HistorySpec, side: str | None = None) -> Column:
    prefix = f"{side}." if side else ""
    return F.struct(*[F.col(prefix + c).alias(c) for c in spec.stats])


def cumulative_step(
    snapshots: DataFrame,
    facts: DataFrame,
    period: int,
    spec: HistorySpec = PLAYER_HISTORY,
    with_active: bool = True,
    first: bool = False,
) -> DataFrame:
    """Snapshot of ``period`` from the snapshot before it and the facts of ``period``.

    Both inputs are filtered here, so that no other pair of periods can be joined by mistake
    and a table partitioned by period is pruned to one partition. Both sides have one row per
    key, or the query fails: the only exchange is the one on the key. It also fails if the
    snapshot before is empty, as every history would start anew; ``first`` allows that for the
    first period of all.
    """
    before = snapshots.filter(F.col(spec.snapshot) == period - 1)
    now = facts.filter(F.col(spec.period) == period)
    now = now.withColumn("_one", _unique(now, spec)).filter("_one").drop("_one")
    if not first:
        now = failing_without(before, now, f"no snapshot of period {period - 1}")
    before, now = before.alias("b"), now.alias("n")
    same = [F.col(f"n.{k}") == F.col(f"b.{k}") for k in spec.keys]
    joined = now.join(before, same, "full_outer")

    present = F.col(f"n.{spec.period}").isNotNull()
    old_history = F.coalesce(F.col(f"b.{spec.history}"), F.array().cast(_history_type(before, spec)))
    grown = F.concat(old_history, F.array(_entry(spec, "n")))
    label = classify(F.col(f"n.{spec.score}"), spec.bands, spec.lowest)

    columns = [
        F.coalesce(F.col(f"n.{c}"), F.col(f"b.{c}")).alias(c) for c in (*spec.keys, *spec.attrs)
    ]
    columns += [
        F.when(present, grown).otherwise(F.col(f"b.{spec.history}")).alias(spec.history),
        F.when(present, label).otherwise(F.col(f"b.{spec.label}")).alias(spec.label),
        recency_step(present, F.col(f"b.{spec.gap}")).alias(spec.gap),
        F.lit(period).alias(spec.snapshot),
    ]
    if with_active:
        columns.append(present.alias(spec.active))
    return joined.select(*columns)


def _history_type(snapshots: DataFrame, spec: HistorySpec):
    return snapshots.schema[spec.history].dataType


def cumulative_backfill(
    facts: DataFrame,
    first: int,
    last: int,
    spec: HistorySpec = PLAYER_HISTORY,
) -> DataFrame:
    """Every snapshot from ``first`` to ``last`` in one pass, with one exchange on the key.

    Each fact row holds until the entity's next one, so it is repeated over the periods in
    between rather than joined to a table of periods. Facts before ``first`` start the
    entity's rows at ``first`` but stay out of its history. Attributes are the entity's
    greatest values over all facts. Several facts of one entity and period fail the query.
    """
    return _spread(facts, first, last, spec, F.lit(first))


def _spread(facts: DataFrame, first: int, last: int, spec: HistorySpec, since: Column) -> DataFrame:
    """The rows of ``cumulative_backfill`` from the period ``since`` on, an expression on facts."""
    by_period = Window.partitionBy(*spec.keys).orderBy(spec.period)
    so_far = by_period.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = by_period.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = F.col(spec.period) >= first
    entry = F.when(counted, _entry(spec))
    starts = F.greatest(F.col(spec.period), F.lit(first), since)
    ends = F.least(F.coalesce(F.lead(spec.period).over(by_period) - 1, F.lit(last)), F.lit(last))

    held = facts.select(
        *spec.keys,
        *[F.max(c).over(whole).alias(c) for c in spec.attrs],
        F.collect_list(entry).over(so_far).alias(spec.history),
        F.when(counted, F.col(spec.score)).alias("_score"),
        F.when(counted, F.col(spec.period)).alias("_last"),
        starts.alias("_starts"),
        ends.alias("_ends"),
        _unique(facts, spec).alias("_one"),
    )
    spread = held.filter(F.col("_one") & (F.col("_starts") <= F.col("_ends"))).withColumn(
        spec.snapshot, F.explode(F.sequence("_starts", "_ends"))
    )
    return spread.select(
        *spec.keys,
        *spec.attrs,
        spec.history,
        classify(F.col("_score"), spec.bands, spec.lowest).alias(spec.label),
        recency(F.col(spec.snapshot), F.col("_last")).alias(spec.gap),
        spec.snapshot,
        is_current(F.col(spec.snapshot), F.col("_last")).alias(spec.active),
    )


def replay_parts(
    snapshots: DataFrame,
    corrections: DataFrame,
    since: int,
    first: int,
    last: int,
    spec: HistorySpec = PLAYER_HISTORY,
    removed: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, rewritten, gone): what corrected facts make of the snapshots ``since`` to ``last``.

    ``corrections`` holds facts as they should have been, one per (key, period), none before
    ``since`` or after ``last``: a fact replaces the one of its key and period or is new, and one
    whose column ``removed`` is true never was. A history holds all entries so far, so a
    correction reaches every later snapshot of its entity and no other entity, and the ``last``
    snapshot has all that is needed to build them again: its entries, with the corrected ones
    changed, are spread over the periods from the entity's first corrected one on.

    ``kept`` are the rows that no correction reaches, ``rewritten`` those built again, ``gone`` the
    (key, snapshot) pairs that have no row any more. Snapshots before ``since`` are not read. Kept
    rows are not shuffled while the corrected entities are few enough for Spark to broadcast.

    Attributes are the greater of the table's and the corrections'. Facts before ``first`` are not
    in histories: an entity that they make known from ``first`` on is known still, if a row from
    its first corrected period on has an empty history.
    """
    keys = spec.keys
    in_scope = F.col(spec.period).between(since, last)
    changed = corrections.filter(check(F.coalesce(in_scope, F.lit(False)), "corrected period outside the bounds:", [spec.period]))
    changed = changed.withColumn("_one", _unique(changed, spec)).filter("_one").drop("_one")
    reach = changed.groupBy(*keys).agg(F.min(spec.period).alias("_since"))
    read = snapshots.filter(F.col(spec.snapshot).between(since, last))

    of = reach.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_since")
    reached = [F.col(k) == F.col(f"_of_{k}") for k in keys] + [F.col(spec.snapshot) >= F.col("_since")]
    kept = read.join(of, reached, "left_anti")
    dirty = read.join(of, reached, "left_semi")

    latest = snapshots.filter(F.col(spec.snapshot) == last).join(reach.select(*keys), keys, "left_semi")
    entries = latest.select(*keys, *spec.attrs, F.inline(spec.history))
    standing = entries.join(changed.select(*keys, spec.period), [*keys, spec.period], "left_anti")
    valid = changed if removed is None else changed.filter(~F.coalesce(F.col(removed), F.lit(False)))
    # an entity known by earlier facts alone: a fact before the first period, in no history
    known = dirty.filter(F.size(spec.history) == 0).groupBy(*keys).agg(*[F.max(c).alias(c) for c in spec.attrs])
    nothing = [F.lit(None).cast(valid.schema[c].dataType).alias(c) for c in spec.stats if c != spec.period]
    period_type = valid.schema[spec.period].dataType
    known = known.select(*keys, *spec.attrs, F.lit(first - 1).cast(period_type).alias(spec.period), *nothing)
    columns = [*keys, *spec.attrs, *spec.stats]
    facts = standing.select(columns).unionByName(valid.select(columns)).unionByName(known.select(columns))
    rewritten = _spread(facts.join(reach, keys), first, last, spec, F.col("_since"))
    rewritten = rewritten.select(read.columns)
    gone = dirty.select(*keys, spec.snapshot).join(rewritten.select(*keys, spec.snapshot), [*keys, spec.snapshot], "left_anti")
    return kept, rewritten, gone


def cumulative_replay(
    snapshots: DataFrame,
    corrections: DataFrame,
    since: int,
    first: int,
    last: int,
    spec: HistorySpec = PLAYER_HISTORY,
    removed: str | None = None,
) -> DataFrame:
    """Snapshots ``since`` to ``last`` as the backfill over corrected facts gives them: what
    ``replay_parts`` keeps and what it builds again. They replace those periods of the table;
    since they also read them, write them through ``idempotent.replace_periods``."""
    kept, rewritten, _ = replay_parts(snapshots, corrections, since, first, last, spec, removed)
    return kept.unionByName(rewritten)


def cumulative_snapshot(
    facts: DataFrame, period: int, first: int, spec: HistorySpec = PLAYER_HISTORY
) -> DataFrame:
    """The rows that ``cumulative_backfill`` gives for one ``period``, built alone.

    Without attributes the filter on the period reaches the scan. A window gathers the history
    at the entity's last row, after one exchange and one sort; an aggregate would sort map-side
    as well, to no use, as facts are already unique per entity and period.
    """
    kept = facts if spec.attrs else facts.filter(F.col(spec.period) <= period)
    counted = F.col(spec.period).between(first, period)
    by_period = Window.partitionBy(*spec.keys).orderBy(spec.period)
    whole = by_period.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = kept.select(
        *spec.keys,
        *[F.max(c).over(whole).alias(c) for c in spec.attrs],
        F.collect_list(F.when(counted, _entry(spec))).over(whole).alias(spec.history),
        F.min(spec.period).over(whole).alias("_first"),
        F.lead(spec.period).over(by_period).alias("_next"),
        _unique(kept, spec).alias("_one"),
    ).filter(F.col("_one") & F.col("_next").isNull() & (F.col("_first") <= period))
    latest = last_entry(F.col(spec.history))
    return rows.select(
        *spec.keys,
        *spec.attrs,
        spec.history,
        classify(latest[spec.score], spec.bands, spec.lowest).alias(spec.label),
        recency(F.lit(period), latest[spec.period]).alias(spec.gap),
        F.lit(period).alias(spec.snapshot),
        is_current(F.lit(period), latest[spec.period]).alias(spec.active),
    )


def period_spine(
    facts: DataFrame,
    key: str | Sequence[str],
    period: str,
    first: int,
    last: int,
    name: str | None = None,
) -> DataFrame:
    """(entity, period) from the entity's first period, or ``first`` if later, to ``last``."""
    keys = as_list(key)
    starts = facts.groupBy(*keys).agg(F.greatest(F.min(period), F.lit(first)).alias("_starts"))
    return starts.filter(F.col("_starts") <= last).select(
        *keys, F.explode(F.sequence(F.col("_starts"), F.lit(last))).alias(name or period)
    )


def static_attributes(
    facts: DataFrame, key: str | Sequence[str], attrs: Sequence[str]
) -> DataFrame:
    """One row per entity with the greatest non-null value of each attribute."""
    return facts.groupBy(*as_list(key)).agg(*[F.max(c).alias(c) for c in attrs])


def unnest_history(
    snapshots: DataFrame,
    period: int,
    key_value: object = None,
    spec: HistorySpec = PLAYER_HISTORY,
) -> DataFrame:
    """History entries of one snapshot as rows; of one entity if ``key_value`` is given."""
    return snapshot_lookup(snapshots, period, key_value, spec).select(
        *spec.keys, F.inline(spec.history)
    )


def snapshot_lookup(
    snapshots: DataFrame,
    period: int | None = None,
    key_value: object = None,
    spec: HistorySpec = PLAYER_HISTORY,
) -> DataFrame:
    """Rows of one snapshot and one entity; both filters reach the scan. Without, all rows.

    With a key of several columns, ``key_value`` is a tuple with a value for each.
    """
    rows = snapshots
    if period is not None:
        rows = rows.filter(F.col(spec.snapshot) == period)
    if key_value is not None:
        values = key_value if isinstance(key_value, (list, tuple)) else [key_value]
        for k, value in zip(spec.keys, values, strict=True):
            rows = rows.filter(F.col(k) == value)
    return rows


def first_last(snapshots: DataFrame, period: int, spec: HistorySpec = PLAYER_HISTORY) -> DataFrame:
    """First and latest history entry of each entity of one snapshot."""
    return snapshot_lookup(snapshots, period, spec=spec).select(
        *spec.keys,
        first_entry(F.col(spec.history)).alias("first_season"),
        last_entry(F.col(spec.history)).alias("latest_season"),
    )


def improvement_ratio(
    snapshots: DataFrame,
    period: int,
    label: str = "star",
    spec: HistorySpec = PLAYER_HISTORY,
    name: str = "avg_stats",
) -> DataFrame:
    """Latest score over first score, a first score of 0 counting as 1, for one class."""
    start = first_entry(F.col(spec.history))[spec.score].cast("double")
    latest = last_entry(F.col(spec.history))[spec.score].cast("double")
    return (
        snapshot_lookup(snapshots, period, spec=spec)
        .filter(F.col(spec.label) == label)
        .select(*spec.keys, (latest / F.when(start == 0, F.lit(1.0)).otherwise(start)).alias(name))
    )
