"""Slowly changing dimensions.

Rows are unique on (key, period) and, as snapshots of a cumulative table, have no gaps: "the
previous row" is then "the previous period". With ``null_safe`` a NULL is a value like others;
without it a comparison with NULL is unknown, which counts as no change in the full build and
loses the row in the incremental one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions import all_equal, any_differs, as_list
from tallybook.operators.checks import check, failing_without

# One key column or several.
Key = str | Sequence[str]

# Names of the range and snapshot columns.
START = "start_season"
END = "end_season"
SNAPSHOT = "current_season"
FAR_FUTURE = 9999


def with_previous(df: DataFrame, key: Key, order: str, cols: Sequence[str]) -> DataFrame:
    """Each of ``cols`` beside its value in the entity's previous row."""
    w = Window.partitionBy(*as_list(key)).orderBy(order)
    return df.withColumns({f"previous_{c}": F.lag(c).over(w) for c in cols})


def with_streaks(
    df: DataFrame, key: Key, order: str, cols: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Adds the change flag (0 or 1) and the number of changes so far, the streak."""
    w = Window.partitionBy(*as_list(key)).orderBy(order)
    pairs = [(F.col(c), F.lag(c).over(w)) for c in cols]
    changed = F.lag(order).over(w).isNotNull() & any_differs(pairs, null_safe)
    flagged = df.withColumn("change_indicator", F.when(changed, 1).otherwise(0))
    return flagged.withColumn("streak_identifier", F.sum("change_indicator").over(w))


def _merge_runs(df: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Neighbouring ranges of equal ``tracked`` values become one range.

    Only the first and last range of a run are kept, then the last one's end is carried to the
    first. All windows share one partitioning and order, hence one exchange.
    """
    w = Window.partitionBy(*keys).orderBy(START)
    opens = F.lag(START).over(w).isNull() | any_differs(
        [(F.col(c), F.lag(c).over(w)) for c in tracked], null_safe=True
    )
    closes = F.lead(START).over(w).isNull() | any_differs(
        [(F.col(c), F.lead(c).over(w)) for c in tracked], null_safe=True
    )
    edges = df.select("*", opens.alias("_opens"), closes.alias("_closes")).filter(
        "_opens or _closes"
    )
    until = F.when(F.col("_closes"), F.col(END)).otherwise(F.lead(END).over(w))
    return (
        edges.withColumn("_until", until)
        .filter("_opens")
        .select(*keys, *tracked, START, F.col("_until").alias(END))
    )


def scd2_full(
    df: DataFrame,
    key: Key,
    period: str,
    tracked: Sequence[str],
    upto: int,
    null_safe: bool = True,
    chunk: int | None = None,
) -> DataFrame:
    """Whole type 2 history up to and with period ``upto``: one row per run of equal values.

    One exchange, on the key. For very long histories ``chunk`` first merges within stretches
    of that many periods, each a task's work of its own, and then the few ranges that are left.
    """
    rows = df.filter(F.col(period) <= upto)
    if null_safe:
        ranges = rows.select(*as_list(key), *tracked, F.col(period).alias(START), F.col(period).alias(END))
        if chunk:
            ranges = ranges.withColumn("_chunk", F.floor(F.col(START) / chunk))
            ranges = _merge_runs(ranges, [*as_list(key), "_chunk"], tracked)
        ranges = _merge_runs(ranges, as_list(key), tracked)
    else:
        ranges = (
            with_streaks(rows.select(*as_list(key), period, *tracked), key, period, tracked, null_safe)
            .groupBy(*as_list(key), "streak_identifier", *tracked)
            .agg(F.min(period).alias(START), F.max(period).alias(END))
        )
    return ranges.select(*as_list(key), *tracked, START, END, F.lit(upto).alias(SNAPSHOT))


def scd2_preview(
    df: DataFrame, key: Key, period: str, tracked: Sequence[str], min_streak: int = 2
) -> DataFrame:
    """Ranges of all periods, without each entity's first ``min_streak`` ones."""
    ranges = df.select(*as_list(key), *tracked, F.col(period).alias(START), F.col(period).alias(END))
    w = Window.partitionBy(*as_list(key)).orderBy(START)
    return (
        _merge_runs(ranges, as_list(key), tracked)
        .withColumn("_nth", F.row_number().over(w))
        .filter(F.col("_nth") > min_streak)
        .drop("_nth")
    )


def scd2_split(prev_scd: DataFrame, prev_period: int) -> tuple[DataFrame, DataFrame]:
    """(closed, open) records of the snapshot ``prev_period``; both filters reach the scan."""
    snapshot = prev_scd.filter(F.col(SNAPSHOT) == prev_period)
    return (
        snapshot.filter(F.col(END) < prev_period).drop(SNAPSHOT),
        snapshot.filter(F.col(END) == prev_period).drop(SNAPSHOT),
    )


def _pair_up(
    last: DataFrame, current: DataFrame, key: Key, tracked: Sequence[str], period: str, how: str
) -> DataFrame:
    """Entities of ``current`` beside their open record, whose columns start with ``_old_``.

    One row per key on both sides, so no key can be hot.
    """
    old = last.select(
        *as_list(key),
        *[F.col(c).alias(f"_old_{c}") for c in (*tracked, START, END)],
        F.lit(True).alias("_had"),
    )
    new = current.select(*as_list(key), *tracked, F.col(period).alias("_now"))
    return new.join(old, as_list(key), how)


def _pairs(tracked: Sequence[str]) -> list[tuple[Column, Column]]:
    return [(F.col(c), F.col(f"_old_{c}")) for c in tracked]


def _record(tracked: Sequence[str], old: bool, start: str, end: str) -> Column:
    prefix = "_old_" if old else ""
    return F.struct(
        *[F.col(prefix + c).alias(c) for c in tracked],
        F.col(start).alias(START),
        F.col(end).alias(END),
    )


def scd2_unchanged(
    last: DataFrame,
    current: DataFrame,
    key: Key,
    tracked: Sequence[str],
    period: str = SNAPSHOT,
    null_safe: bool = True,
) -> DataFrame:
    """Open records whose values hold in this period too, with their end moved to it."""
    joined = _pair_up(last, current, key, tracked, period, "inner")
    return joined.filter(all_equal(_pairs(tracked), null_safe)).select(
        *as_list(key), *tracked, F.col(f"_old_{START}").alias(START), F.col("_now").alias(END)
    )


def scd2_changed(
    last: DataFrame,
    current: DataFrame,
    key: Key,
    tracked: Sequence[str],
    period: str = SNAPSHOT,
    null_safe: bool = True,
) -> DataFrame:
    """Two records per changed entity: the old one as it ended, and one that starts now."""
    joined = _pair_up(last, current, key, tracked, period, "inner")
    records = F.array(
        _record(tracked, True, f"_old_{START}", f"_old_{END}"),
        _record(tracked, False, "_now", "_now"),
    )
    return joined.filter(any_differs(_pairs(tracked), null_safe)).select(*as_list(key), F.inline(records))


def scd2_new(
    last: DataFrame, current: DataFrame, key: Key, tracked: Sequence[str], period: str = SNAPSHOT
) -> DataFrame:
    """Records of entities that have no open one."""
    keys = as_list(key)
    fresh = current.join(last.select(*keys), keys, "left_anti")
    return fresh.select(*keys, *tracked, F.col(period).alias(START), F.col(period).alias(END))


def scd2_incremental(
    prev_scd: DataFrame,
    current: DataFrame,
    key: Key,
    tracked: Sequence[str],
    period: int,
    period_col: str = SNAPSHOT,
    null_safe: bool = True,
    missing: str = "drop",
    first: bool = False,
) -> DataFrame:
    """Type 2 snapshot of ``period`` from the one before it and the rows of ``period``.

    The query fails if the snapshot before is empty, as every record would start anew;
    ``first`` allows that for the first period of all.

    Closed records pass through without a shuffle. Open ones meet this period's rows in a
    single join, and each row yields its extended, its closed and opened, or its first record.
    An entity with an open record but no row in ``period`` loses that record
    (``missing='drop'``) or fails the query (``missing='raise'``).
    """
    if missing not in ("drop", "raise"):
        raise ValueError("missing must be 'drop' or 'raise'")
    closed, last = scd2_split(prev_scd, period - 1)
    rows = current.filter(F.col(period_col) == period)
    if not first:
        before = prev_scd.filter(F.col(SNAPSHOT) == period - 1)
        rows = failing_without(before, rows, f"no snapshot of period {period - 1}")
    how = "full_outer" if missing == "raise" else "left"
    joined = _pair_up(last, rows, key, tracked, period_col, how)

    opened = _record(tracked, False, "_now", "_now")
    extended = _record(tracked, False, f"_old_{START}", "_now")
    ended = _record(tracked, True, f"_old_{START}", f"_old_{END}")
    records = (
        F.when(F.col("_had").isNull(), F.array(opened))
        .when(all_equal(_pairs(tracked), null_safe), F.array(extended))
        .when(any_differs(_pairs(tracked), null_safe), F.array(ended, opened))
    )
    if missing == "raise":
        told = F.concat_ws(", ", *[F.col(k).cast("string") for k in as_list(key)])
        gone = F.raise_error(F.concat(F.lit(f"no row in period {period} for "), told))
        records = F.when(F.col("_now").isNull(), gone).otherwise(records)
    moved = joined.select(*as_list(key), F.inline(records))
    return closed.select(*moved.columns).unionByName(moved).withColumn(SNAPSHOT, F.lit(period))


def scd2_correct(
    history: DataFrame,
    corrections: DataFrame,
    key: Key,
    tracked: Sequence[str],
    upto: int,
    period: str = SNAPSHOT,
    removed: str | None = None,
) -> DataFrame:
    """The type 2 snapshot ``upto`` with late corrections spliced in; equals ``scd2_full`` over the
    corrected rows.

    ``corrections`` has the true values of some past periods, one row per (key, period): they
    replace the values of that period, or give it some where it had none. A row whose column
    ``removed`` is true says that the period has no row. A period after ``upto`` fails the query,
    and so do two corrections of one period.

    Records of corrected entities are cut at the corrected periods, the corrected ones put in
    between, and neighbours of equal values merged; so records split, move, merge or vanish. That
    takes one exchange, of those entities' records alone. All other records pass through, without
    a shuffle while the corrected keys are few enough for Spark to broadcast.
    """
    keys = as_list(key)
    records = history.filter(F.col(SNAPSHOT) == upto).drop(SNAPSHOT).select(*keys, *tracked, START, END)
    known = F.coalesce(F.col(period) <= upto, F.lit(False))
    late = corrections.filter(check(known, "correction after the snapshot:", [*keys, period]))
    gone = F.coalesce(F.col(removed), F.lit(False)) if removed else F.lit(False)
    touched = late.select(*keys).distinct()
    others = records.join(touched, keys, "left_anti")
    own = records.join(touched, keys, "left_semi")

    # records and corrections in order of their starts; a record before a correction of its start
    kind = records.schema[START].dataType
    events = own.select(
        *keys, F.lit(0).alias("_fix"), F.col(START).alias("_at"), F.struct(*tracked, END).alias("_record"), F.lit(None).cast("boolean").alias("_gone")
    ).unionByName(
        late.select(
            *keys,
            F.lit(1).alias("_fix"),
            F.col(period).cast(kind).alias("_at"),
            F.struct(*tracked, F.col(period).cast(kind).alias(END)).alias("_record"),
            gone.alias("_gone"),
        )
    )
    in_order = Window.partitionBy(*keys).orderBy("_at", "_fix")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    twice = (F.col("_fix") == 1) & (F.lag("_fix").over(in_order) == 1) & (F.lag("_at").over(in_order) == F.col("_at"))
    within = F.last(F.when(F.col("_fix") == 0, F.col("_record")), ignorenulls=True).over(so_far)
    swept = events.select(
        *keys,
        "_fix",
        "_at",
        "_record",
        "_gone",
        within.alias("_within"),
        F.lead("_at").over(in_order).alias("_next"),
        check(~F.coalesce(twice, F.lit(False)), "several corrections of one period for", [*keys, "_at"]).alias("_one"),
    ).filter("_one")

    def piece(record: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(f"{record}.{c}").alias(c) for c in tracked], start.cast(kind).alias(START), end.cast(kind).alias(END)
        )

    # what is left of a record after an event: up to its end or to where the next event stands
    left_from = F.col("_at") + F.col("_fix")
    left_to = F.least(F.col(f"_within.{END}"), F.col("_next") - 1)
    rest = F.when(F.col("_within").isNotNull() & (left_from <= left_to), piece("_within", left_from, left_to))
    fixed = F.when((F.col("_fix") == 1) & ~F.col("_gone"), piece("_record", F.col("_at"), F.col("_at")))
    pieces = swept.select(*keys, F.inline(F.array_compact(F.array(fixed, rest))))
    spliced = _merge_runs(pieces, keys, tracked)
    return others.unionByName(spliced.select(*others.columns)).withColumn(SNAPSHOT, F.lit(upto))


def scd2_join(
    left: DataFrame,
    right: DataFrame,
    key: Key,
    left_cols: Sequence[str],
    right_cols: Sequence[str],
    how: str = "inner",
    chunk: int | None = None,
) -> DataFrame:
    """The common refinement of two type 2 tables: one row per entity and stretch of periods in
    which neither side's record changes, with the columns of both.

    ``how`` says which stretches stay: 'inner' those where both sides have a record, 'left' those
    of the left side, 'full' all that any side has; columns of an absent side are NULL. Records
    do not overlap within an entity and side. An end may be NULL, for an open record; a stretch in
    which all records are open has a NULL end. Gaps of a side are stretches of their own. Rows
    without a key or a start, or that end before they start, take no part.

    A sweep in place of a join: each record gives an event at its start and one after its end, and
    a window carries both sides' last events along. So an entity costs the sum of its records, not
    their product, in one exchange. With ``chunk`` an entity's events are swept in stretches of
    that many periods, each a task's work of its own, with the state at a stretch's start taken
    from a summary row per stretch: for entities with very many records.
    """
    if how not in ("inner", "left", "full"):
        raise ValueError("how must be 'inner', 'left' or 'full'")
    keys = as_list(key)
    kinds = {f.name: f.dataType for f in left.schema}
    sides = {"l": (left, left_cols), "r": (right, right_cols)}
    shapes = {
        s: F.struct(*[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in cols], F.lit(None).cast("boolean").alias("_on"))
        for s, (df, cols) in sides.items()
    }

    def events(side: str) -> DataFrame:
        df, cols = sides[side]
        other = "r" if side == "l" else "l"
        # a side's event is never NULL on its own side, so that the last one can be found
        opens = F.struct(*[F.col(c) for c in cols], F.lit(True).alias("_on"))
        closes = F.struct(*[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in cols], F.lit(False).alias("_on"))
        both = F.array(
            F.struct(F.col(START).alias("_at"), F.lit(1).alias("_opens"), opens.alias(f"_{side}")),
            F.when(
                F.col(END).isNotNull(),
                F.struct((F.col(END) + 1).alias("_at"), F.lit(0).alias("_opens"), closes.alias(f"_{side}")),
            ),
        )
        sound = F.col(START).isNotNull() & (F.col(END).isNull() | (F.col(END) >= F.col(START)))
        for k in keys:
            sound = sound & F.col(k).isNotNull()
        rows = df.filter(sound).select(*keys, F.inline(F.array_compact(both)))
        return rows.withColumn(f"_{other}", F.when(F.lit(False), shapes[other]))

    rows = events("l").unionByName(events("r"))
    by = keys
    carried = {s: F.lit(None) for s in sides}
    after = F.lit(None)
    if chunk:
        rows = rows.withColumn("_chunk", F.floor(F.col("_at") / chunk))
        by = [*keys, "_chunk"]
        latest = {
            s: F.max_by(f"_{s}", F.when(F.col(f"_{s}").isNotNull(), F.struct("_at", "_opens"))) for s in sides
        }
        summary = rows.groupBy(*by).agg(
            F.min("_at").alias("_first"), *[latest[s].alias(f"_last_{s}") for s in sides]
        )
        over_chunks = Window.partitionBy(*keys).orderBy("_chunk")
        before = over_chunks.rowsBetween(Window.unboundedPreceding, -1)
        summary = summary.select(
            *by,
            F.lead("_first").over(over_chunks).alias("_after"),
            *[F.last(f"_last_{s}", ignorenulls=True).over(before).alias(f"_before_{s}") for s in sides],
        )
        rows = rows.join(summary, by)
        carried = {s: F.col(f"_before_{s}") for s in sides}
        after = F.col("_after")

    in_order = Window.partitionBy(*by).orderBy("_at", "_opens")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    now = {s: F.coalesce(F.last(f"_{s}", ignorenulls=True).over(so_far), carried[s]) for s in sides}
    swept = rows.select(
        *keys,
        F.col("_at").alias(START),
        F.coalesce(F.lead("_at").over(in_order), after).alias("_next"),
        *[now[s].alias(f"_{s}") for s in sides],
    )
    on = {s: F.coalesce(F.col(f"_{s}._on"), F.lit(False)) for s in sides}
    stays = {"inner": on["l"] & on["r"], "left": on["l"], "full": on["l"] | on["r"]}[how]
    # of several events at one period the last one tells what holds from there on
    shown = swept.filter(stays & (F.col("_next").isNull() | (F.col("_next") > F.col(START))))
    return shown.select(
        *keys,
        F.col(START).cast(kinds[START]).alias(START),
        (F.col("_next") - 1).cast(kinds[START]).alias(END),
        *[F.col(f"_{s}.{c}").alias(c) for s, (_, cols) in sides.items() for c in cols],
    )


def scd0(df: DataFrame, key: Key, period: str, cols: Sequence[str]) -> DataFrame:
    """First value ever seen; later ones are ignored."""
    return df.groupBy(*as_list(key)).agg(*[F.min_by(c, period).alias(c) for c in cols])


def scd1(df: DataFrame, key: Key, period: str, cols: Sequence[str]) -> DataFrame:
    """Latest value only."""
    return df.groupBy(*as_list(key)).agg(*[F.max_by(c, period).alias(c) for c in cols])


def scd3(df: DataFrame, key: Key, period: str, cols: Sequence[str]) -> DataFrame:
    """One row per entity with the original and the current value of each column."""
    return df.groupBy(*as_list(key)).agg(
        *[F.min_by(c, period).alias(f"original_{c}") for c in cols],
        *[F.max_by(c, period).alias(f"current_{c}") for c in cols],
    )


# Buckets that a record of the as-of join is spread over; a longer one keeps its range whole.
SPREAD = 16


def scd2_asof(
    facts: DataFrame,
    scd: DataFrame,
    key: Key,
    period: str,
    cols: Sequence[str],
    width: int = 8,
) -> DataFrame:
    """Each fact with the record that held in its own period; facts without one are kept.

    Records do not overlap within an entity, so the row count stays. An end may be NULL or lie
    in the far future. The join is on the entity and a bucket of ``width`` periods, with the
    range as a further condition: a record lies in each bucket it touches, a fact in one. So a
    fact meets a few records of its entity rather than all, and an entity with very many facts
    spreads over its buckets, which adaptive execution can split further. Records that are open
    or touch more than ``SPREAD`` buckets, a few at most per entity, are not copied: they meet
    the facts in a second join, on the entity and the range alone.
    """
    keys = as_list(key)
    first, last = (F.floor(F.col(c) / width) for c in (START, END))
    long = F.col(END).isNull() | (last - first >= SPREAD)

    def named(records: DataFrame, mark: str, *more: Column) -> DataFrame:
        return records.select(
            *[F.col(k).alias(f"{mark}_of_{k}") for k in keys],
            *more,
            F.lit(True).alias(f"{mark}_held"),
            *[F.col(c).alias(f"{mark}_{c}") for c in (START, END, *cols)],
        )

    def within(mark: str) -> list[Column]:
        at, end = F.col(period), F.col(f"{mark}_{END}")
        same = [F.col(k) == F.col(f"{mark}_of_{k}") for k in keys]
        return [*same, at >= F.col(f"{mark}_{START}"), end.isNull() | (at <= end)]

    short = named(scd.filter(~long), "_s", F.explode(F.sequence(first, last)).alias("_in_bucket"))
    bucketed = facts.withColumn("_bucket", F.floor(F.col(period) / width))
    joined = bucketed.join(short, [F.col("_bucket") == F.col("_in_bucket"), *within("_s")], "left")
    joined = joined.join(named(scd.filter(long), "_l"), within("_l"), "left")
    return joined.select(
        *[F.col(c) for c in facts.columns],
        *[
            F.when(F.col("_s_held"), F.col(f"_s_{c}")).otherwise(F.col(f"_l_{c}")).alias(c)
            for c in (START, END, *cols)
        ],
    )


def scd2_open_end(scd: DataFrame, style: str = "null") -> DataFrame:
    """Open records show their end as NULL or as a far-future period."""
    if style not in ("null", "far_future"):
        raise ValueError("style must be 'null' or 'far_future'")
    end_type = scd.schema[END].dataType
    shown = F.lit(None if style == "null" else FAR_FUTURE).cast(end_type)
    is_open = F.col(END) == F.col(SNAPSHOT)
    return scd.withColumns(
        {END: F.when(is_open, shown).otherwise(F.col(END)), "is_open": is_open}
    )
