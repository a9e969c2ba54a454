"""Every operator as a named query over the given tables: (spark, folder) -> DataFrame.

Arrays, structs and JSON are flattened in the results, so that they compare as plain values.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.functions import classify, first_entry, last_entry, prop, props, recency_step
from tallybook.operators import bithistory, cumulative, dims, facts, graph, hybrid, idempotent, reach, scd, variants
from tallybook.operators.checks import check
from tallybook.sources import tables as src
from tallybook.sources.shared import shared_folder, staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPEC = src.CUSTOMER_HISTORY
KEY = "player_name"
TRACKED = ["scoring_class", "is_active"]
FIRST, LAST = src.FIRST_YEAR, src.LAST_YEAR
REPLAY = LAST - 2
EPOCH = date(2024, 1, 1)
LAST_DAY = 29  # 30 January, counted from the epoch


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All years. A year outside the bounds fails the query rather than be cut from it."""
    known = F.col("season").between(FIRST, LAST)
    return src.player_seasons(spark, sf_dir).filter(check(known, "year outside the bounds:", ["season"]))


def _new_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.player_seasons(spark, sf_dir, LAST, LAST)


def _players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cumulative.cumulative_backfill(_facts(spark, sf_dir), FIRST, LAST, SPEC)


def _snapshot(spark: SparkSession, sf_dir: str, period: int) -> DataFrame:
    return cumulative.cumulative_snapshot(_facts(spark, sf_dir), period, FIRST, SPEC)


def _scd(spark: SparkSession, sf_dir: str, upto: int) -> DataFrame:
    return scd.scd2_full(_players(spark, sf_dir), KEY, "current_season", TRACKED, upto)


def _flat(players: DataFrame) -> DataFrame:
    history = F.col("season_stats")
    latest = last_entry(history)
    kept = [c for c in players.columns if c != "season_stats"]
    return players.select(
        *kept,
        F.size(history).alias("n_seasons"),
        F.array_join(F.transform(history, lambda e: e["season"].cast("string")), ",").alias("seasons"),
        F.aggregate(history, F.lit(0), lambda n, e: n + e["gp"]).alias("all_gp"),
        first_entry(history)["pts"].alias("first_pts"),
        *[latest[c].alias(f"latest_{c}") for c in ("season", "gp", "pts", "reb", "ast")],
    )


# Cumulative tables


@query
def cumulative_step(spark, sf_dir):
    before = _snapshot(spark, sf_dir, LAST - 1)
    return _flat(cumulative.cumulative_step(before, _new_facts(spark, sf_dir), LAST, SPEC))


@query
def cumulative_step_without_activity(spark, sf_dir):
    before = _snapshot(spark, sf_dir, LAST - 1)
    today = _new_facts(spark, sf_dir)
    return _flat(cumulative.cumulative_step(before, today, LAST, SPEC, with_active=False))


@query
def cumulative_backfill(spark, sf_dir):
    return _flat(_players(spark, sf_dir))


def _corrected_facts(spark, sf_dir):
    """Facts of the last three years that change where orders still pending ('P') are left out:
    the year's row as it should have been, or marked as removed where no order is left."""
    orders = src.table(spark, sf_dir, "orders")
    whole = src.player_seasons(spark, sf_dir, REPLAY, LAST)
    pending = src.yearly(orders.filter("o_orderstatus = 'P'"), REPLAY, LAST).select("o_custkey", "season")
    settled = src.yearly(orders.filter("o_orderstatus <> 'P'"), REPLAY, LAST)
    names = src.customers(spark, sf_dir)
    fixed = pending.join(settled, ["o_custkey", "season"], "left").join(names, "o_custkey")
    return fixed.withColumn("removed", F.col("gp").isNull()).select(*whole.columns, "removed")


@query
def cumulative_replay(spark, sf_dir):
    """The last three snapshots, after corrections of their years' facts reached them late."""
    fixed = _corrected_facts(spark, sf_dir)
    players = _players(spark, sf_dir)
    return _flat(cumulative.cumulative_replay(players, fixed, REPLAY, FIRST, LAST, SPEC, removed="removed"))


@query
def period_spine(spark, sf_dir):
    return cumulative.period_spine(_facts(spark, sf_dir), KEY, "season", FIRST, LAST)


@query
def static_attributes(spark, sf_dir):
    return cumulative.static_attributes(_facts(spark, sf_dir), KEY, SPEC.attrs)


@query
def unnest_history(spark, sf_dir):
    return cumulative.unnest_history(_snapshot(spark, sf_dir, LAST), LAST, spec=SPEC)


@query
def snapshot_lookup(spark, sf_dir):
    """A point read is the operator: one entity of one snapshot."""
    players = _snapshot(spark, sf_dir, LAST - 1)
    return _flat(cumulative.snapshot_lookup(players, LAST - 1, "Customer#000000007", SPEC))


@query
def snapshot_scan(spark, sf_dir):
    players = _snapshot(spark, sf_dir, LAST - 1)
    return _flat(cumulative.snapshot_lookup(players, LAST - 1, spec=SPEC))


@query
def first_last_season(spark, sf_dir):
    ends = cumulative.first_last(_snapshot(spark, sf_dir, LAST), LAST, SPEC)
    return ends.select(
        KEY,
        *[
            F.col(f"{end}_season.{c}").alias(f"{end}_{c}")
            for end in ("first", "latest")
            for c in SPEC.stats
        ],
    )


@query
def improvement_ratio(spark, sf_dir):
    rows = cumulative.improvement_ratio(_snapshot(spark, sf_dir, LAST), LAST, "star", SPEC)
    return rows.withColumn("avg_stats", F.round("avg_stats", 6))


@query
def scoring_class(spark, sf_dir):
    label = classify(F.col("pts"), SPEC.bands, SPEC.lowest)
    return _facts(spark, sf_dir).select(KEY, "season", "pts", label.alias("scoring_class"))


@query
def recency_activity(spark, sf_dir):
    w = Window.partitionBy(KEY).orderBy("current_season")
    stepped = recency_step(F.col("is_active"), F.lag("year_since_last_season").over(w))
    return _players(spark, sf_dir).select(
        KEY, "current_season", "is_active", "year_since_last_season", stepped.alias("stepped_gap")
    )


# Slowly changing dimensions


@query
def change_preview(spark, sf_dir):
    players = _players(spark, sf_dir).select(KEY, "current_season", *TRACKED)
    return scd.with_previous(players, KEY, "current_season", TRACKED)


@query
def change_streaks(spark, sf_dir):
    players = _players(spark, sf_dir).select(KEY, "current_season", *TRACKED)
    return scd.with_streaks(players, KEY, "current_season", TRACKED)


@query
def scd2_preview(spark, sf_dir):
    return scd.scd2_preview(_players(spark, sf_dir), KEY, "current_season", TRACKED)


@query
def scd2_full(spark, sf_dir):
    return _scd(spark, sf_dir, LAST)


@query
def scd2_full_chunked(spark, sf_dir):
    players = _players(spark, sf_dir)
    return scd.scd2_full(players, KEY, "current_season", TRACKED, LAST, chunk=3)


@query
def scd2_incremental(spark, sf_dir):
    current = _snapshot(spark, sf_dir, LAST)
    return scd.scd2_incremental(_scd(spark, sf_dir, LAST - 1), current, KEY, TRACKED, LAST)


@query
def scd2_historical(spark, sf_dir):
    closed, last = scd.scd2_split(_scd(spark, sf_dir, LAST - 1), LAST - 1)
    return closed.withColumn("part", F.lit("closed")).unionByName(
        last.withColumn("part", F.lit("open"))
    )


def _last_and_current(spark, sf_dir):
    _, last = scd.scd2_split(_scd(spark, sf_dir, LAST - 1), LAST - 1)
    return last, _snapshot(spark, sf_dir, LAST)


@query
def scd2_unchanged(spark, sf_dir):
    return scd.scd2_unchanged(*_last_and_current(spark, sf_dir), KEY, TRACKED)


@query
def scd2_changed(spark, sf_dir):
    return scd.scd2_changed(*_last_and_current(spark, sf_dir), KEY, TRACKED)


@query
def scd2_new(spark, sf_dir):
    return scd.scd2_new(*_last_and_current(spark, sf_dir), KEY, TRACKED)


def _classed_facts(spark, sf_dir):
    label = classify(F.col("pts"), SPEC.bands, SPEC.lowest)
    return _facts(spark, sf_dir).select(KEY, "season", "gp", label.alias("scoring_class"))


@query
def scd2_correct(spark, sf_dir):
    """The type 2 history, with the rows spliced in that the replay builds again or removes."""
    fixed = _corrected_facts(spark, sf_dir)
    _, rewritten, gone = cumulative.replay_parts(
        _players(spark, sf_dir), fixed, REPLAY, FIRST, LAST, SPEC, removed="removed"
    )
    late = rewritten.select(KEY, "current_season", *TRACKED).unionByName(
        gone.select(KEY, "current_season"), allowMissingColumns=True
    )
    late = late.withColumn("removed", F.col("is_active").isNull())
    return scd.scd2_correct(_scd(spark, sf_dir, LAST), late, KEY, TRACKED, LAST, removed="removed")


def _order_years(spark, sf_dir):
    """A record for each customer and year with orders, so with gaps between."""
    years = src.player_seasons(spark, sf_dir)
    return years.select(KEY, F.col("season").alias("start_season"), F.col("season").alias("end_season"), "gp")


@query
def scd2_join(spark, sf_dir):
    """Classes over time, with open ends, beside the orders of each year that has some."""
    classes = scd.scd2_open_end(_scd(spark, sf_dir, LAST))
    return scd.scd2_join(classes, _order_years(spark, sf_dir), KEY, TRACKED, ["gp"], how="full")


@query
def scd2_join_chunked(spark, sf_dir):
    classes = scd.scd2_open_end(_scd(spark, sf_dir, LAST))
    return scd.scd2_join(classes, _order_years(spark, sf_dir), KEY, TRACKED, ["gp"], how="inner", chunk=2)


@query
def scd0(spark, sf_dir):
    return scd.scd0(_classed_facts(spark, sf_dir), KEY, "season", ["scoring_class", "gp"])


@query
def scd1(spark, sf_dir):
    return scd.scd1(_classed_facts(spark, sf_dir), KEY, "season", ["scoring_class", "gp"])


@query
def scd3(spark, sf_dir):
    return scd.scd3(_classed_facts(spark, sf_dir), KEY, "season", ["scoring_class", "gp"])


@query
def scd2_asof(spark, sf_dir):
    records = _scd(spark, sf_dir, LAST)
    return scd.scd2_asof(src.order_facts(spark, sf_dir), records, KEY, "season", TRACKED)


@query
def scd2_asof_open(spark, sf_dir):
    """The same facts over records whose open ends are NULL."""
    records = scd.scd2_open_end(_scd(spark, sf_dir, LAST))
    return scd.scd2_asof(src.order_facts(spark, sf_dir), records, KEY, "season", TRACKED)


@query
def scd2_current(spark, sf_dir):
    records = _scd(spark, sf_dir, LAST)
    far = scd.scd2_open_end(records, "far_future").withColumn("style", F.lit("far_future"))
    null = scd.scd2_open_end(records, "null").withColumn("style", F.lit("null"))
    return far.unionByName(null)


# Hybrid types: surrogate keys, mini-dimensions, current values on old records


def _customer_keys(spark, sf_dir):
    """Keys given to the customers known before the last year, then to those that it brings."""
    older = src.player_seasons(spark, sf_dir, last=LAST - 1).select(KEY)
    known = hybrid.surrogate_keys(older, [KEY])
    return hybrid.surrogate_keys(src.player_seasons(spark, sf_dir).select(KEY), [KEY], known)


@query
def surrogate_keys(spark, sf_dir):
    return _customer_keys(spark, sf_dir)


def _profiles(spark, sf_dir):
    """Yearly facts in bands: the class of the year's value and the number of its orders."""
    orders = classify(F.col("gp"), (("many", 3), ("some", 1)), "one")
    return _classed_facts(spark, sf_dir).withColumn("orders", orders).drop("gp")


@query
def scd4_profiles(spark, sf_dir):
    """The mini-dimension of all profiles that occur."""
    return hybrid.scd4(_profiles(spark, sf_dir), KEY, "season", ["scoring_class", "orders"])[0]


@query
def scd4_history(spark, sf_dir):
    """The profiles that each customer moved through, by their keys."""
    return hybrid.scd4(_profiles(spark, sf_dir), KEY, "season", ["scoring_class", "orders"])[1]


@query
def scd6(spark, sf_dir):
    """The type 2 history with each customer's current values beside the old ones."""
    return hybrid.scd6(_scd(spark, sf_dir, LAST), KEY, TRACKED)


@query
def scd7(spark, sf_dir):
    """Orders with the key of the record that held and the durable key of the customer."""
    records, _ = hybrid.scd7(_scd(spark, sf_dir, LAST), KEY)
    held = scd.scd2_asof(src.order_facts(spark, sf_dir), records, KEY, "season", ["record_key", "durable_key"])
    return held.select("order_id", "season", "record_key", "durable_key")


# Idempotent pipelines


@query
def overwrite_period(spark, sf_dir):
    """All years, then the last one twice more: the table is as after the first write."""
    rows = _facts(spark, sf_dir).select(KEY, "season", "gp", "pts")
    path = shared_folder(spark, "player_seasons")
    idempotent.overwrite_period(rows, path, "season", idempotent.ALL)
    for _ in range(2):
        idempotent.overwrite_period(rows, path, "season", [LAST])
    return spark.read.schema(rows.schema).parquet(path)


@query
def merge_upsert(spark, sf_dir):
    """Each customer's state before the last year, then the last year's rows merged in."""
    columns = ["season", "gp", "pts"]
    older = src.player_seasons(spark, sf_dir, last=LAST - 1).select(KEY, *columns)
    newer = _new_facts(spark, sf_dir).select(KEY, *columns)
    return idempotent.merge_upsert(scd.scd1(older, KEY, "season", columns), newer, [KEY])


@query
def bounded_window(spark, sf_dir):
    events = src.table(spark, sf_dir, "events")
    window = idempotent.bounded_window(events, "ts", datetime(2024, 1, 8), datetime(2024, 1, 22))
    return window.select("event_id", "user_id", "event_type")


@query
def missing_partitions(spark, sf_dir):
    year = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    sources = {
        name: src.table(spark, sf_dir, name).select(F.year(ts).alias("year"))
        for name, ts in year.items()
    }
    return idempotent.missing_partitions(sources, "year", FIRST - 2, 2025, min_rows=2)


@query
def depends_on_past(spark, sf_dir):
    days = src.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    return idempotent.depends_on_past(days, "day", 1).select(F.col("day").cast("string").alias("day"))


@query
def snapshot_asof(spark, sf_dir):
    orders = src.order_facts(spark, sf_dir)
    players = _players(spark, sf_dir)
    return idempotent.snapshot_asof(
        orders, players, KEY, "season", "current_season", "scoring_class"
    )


# Additive dimensions, enums, flexible schema


def _event_members(spark, sf_dir):
    events = src.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return dims.distinct_structures(events, ["event_type", "day"], "user_id")


@query
def distinct_rollup(spark, sf_dir):
    """Users per type, per day and in all, from one set of bitmaps per type and day."""
    members = _event_members(spark, sf_dir)
    name = F.lit(None).cast("string").alias("event_type")
    return (
        dims.distinct_rollup(members, ["event_type"])
        .select(F.lit("type").alias("level"), "event_type", F.lit(None).cast("string").alias("day"), "entities")
        .unionByName(
            dims.distinct_rollup(members, ["day"]).select(
                F.lit("day").alias("level"), name, F.col("day").cast("string").alias("day"), "entities"
            )
        )
        .unionByName(
            dims.distinct_rollup(members, []).select(
                F.lit("all").alias("level"), name, F.lit(None).cast("string").alias("day"), "entities"
            )
        )
    )


@query
def distinct_estimates(spark, sf_dir):
    """Users per type by sketches, and whether both lie within four standard errors."""
    events = src.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    rows = dims.distinct_rollup(_event_members(spark, sf_dir), ["event_type"])
    for kind in ("hll", "theta"):
        sketches = dims.distinct_sketches(events, ["event_type", "day"], "user_id", kind)
        rows = rows.join(dims.sketch_rollup(sketches, ["event_type"], kind, name=kind), "event_type")
        off = F.abs(F.col(kind) - F.col("entities")) / F.col("entities")
        rows = rows.withColumn(f"{kind}_is_near", off <= 4 * 1.04 / 64).drop(kind)
    return rows


def _user_events(spark, sf_dir):
    """Events reduced to one row per user, type and day, with the user's first day.

    A busy user has no more rows here than there are types and days.
    """
    daily = (
        src.table(spark, sf_dir, "events")
        .groupBy("user_id", "event_type", F.to_date("ts").alias("day"))
        .agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("value"))
    )
    return daily.withColumn("cohort", F.min("day").over(Window.partitionBy("user_id")))


@query
def additivity_check(spark, sf_dir):
    return dims.additivity_checks(_user_events(spark, sf_dir), "user_id", ["event_type", "day", "cohort"])


@query
def additivity_by_window(spark, sf_dir):
    checked = dims.additivity_check(_user_events(spark, sf_dir), "user_id", "event_type", "day")
    return checked.withColumn("day", F.col("day").cast("string"))


@query
def additive_rollup(spark, sf_dir):
    events = _user_events(spark, sf_dir)
    finer = dims.entity_counts(events, ["event_type", "cohort"], "user_id", ["value"])
    checked = dims.additivity_checks(events, "user_id", ["cohort"])
    summed = dims.additive_rollup(finer, ["event_type"], ["value"], checked)
    recounted = dims.entity_counts(events, ["cohort"], "user_id", ["value"])
    columns = [F.col("value").cast("double").alias("value"), "entities"]
    by_type = summed.select(
        F.lit("event_type").alias("level"), F.col("event_type").alias("member"), *columns
    )
    by_cohort = recounted.select(
        F.lit("cohort").alias("level"), F.col("cohort").cast("string").alias("member"), *columns
    )
    return by_type.unionByName(by_cohort)


def _user_days(spark, sf_dir):
    return src.table(spark, sf_dir, "events").select("user_id", F.datediff("ts", F.lit(EPOCH)).alias("day"))


def _activity(bits):
    week, month = (bithistory.active_periods(F.col("activity"), n) for n in (7, 28))
    return bits.select(
        "user_id",
        "as_of",
        bithistory.active_periods(F.col("activity")).alias("days_active"),
        week.alias("days_of_7"),
        month.alias("days_of_28"),
        bithistory.active_in(F.col("activity"), 0).alias("is_active"),
        bithistory.periods_since(F.col("activity")).alias("days_since"),
        bithistory.longest_run(F.col("activity")).alias("longest_run"),
        bithistory.is_returning(F.col("activity"), 3).alias("returned_after_3"),
    )


@query
def activity_bits(spark, sf_dir):
    """Each user's days as one integer on the last day, and what masks read from it."""
    return _activity(bithistory.activity_bits(_user_days(spark, sf_dir), "user_id", "day", LAST_DAY))


@query
def activity_bits_step(spark, sf_dir):
    """The same, from the integers of three days before and one step per day."""
    days = _user_days(spark, sf_dir)
    bits = bithistory.activity_bits(days, "user_id", "day", LAST_DAY - 3)
    for day in range(LAST_DAY - 2, LAST_DAY + 1):
        bits = bithistory.activity_step(bits, days, "user_id", "day", day)
    return _activity(bits)


@query
def activity_retention(spark, sf_dir):
    """Of the users first seen on a day, how many came back n days later, for every n."""
    bits = bithistory.activity_bits(_user_days(spark, sf_dir), "user_id", "day", LAST_DAY)
    return bithistory.retention(bits)


@query
def enum_validate(spark, sf_dir):
    domains = {
        "o_orderstatus": ["F", "O"],
        "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"],
    }
    return dims.enum_validate(src.table(spark, sf_dir, "orders"), domains)


@query
def enum_candidates(spark, sf_dir):
    cols = ["o_orderstatus", "o_orderpriority", "o_custkey", "o_orderdate"]
    return dims.enum_candidates(src.table(spark, sf_dir, "orders"), cols)


@query
def enum_subpartition(spark, sf_dir):
    """R has no orders, and P, which has some, is outside the domain."""
    orders = src.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), "o_orderstatus"
    )
    path = shared_folder(spark, "orders")
    return dims.enum_subpartition(orders, path, "year", "o_orderstatus", ["F", "O", "R"])


@query
def shared_schema(spark, sf_dir):
    part, supplier, customer = (
        src.table(spark, sf_dir, t) for t in ("part", "supplier", "customer")
    )
    c = F.col
    unified = dims.shared_schema(
        {
            "part": (
                part,
                "p_partkey",
                {"name": c("p_name"), "brand": c("p_brand"), "size": c("p_size")},
            ),
            "supplier": (
                supplier,
                "s_suppkey",
                {"name": c("s_name"), "nation": c("s_nationkey")},
            ),
            "customer": (
                customer,
                "c_custkey",
                {"name": c("c_name"), "nation": c("c_nationkey"), "segment": c("c_mktsegment")},
            ),
        },
        common=["name", "nation"],
    )
    return unified.select(
        "id",
        "type",
        "name",
        "nation",
        F.size("properties").alias("n_properties"),
        *[dims.property_value("properties", p).alias(p) for p in ("brand", "size", "segment")],
    )


@query
def flexible_schema(spark, sf_dir):
    documents = src.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labelled = documents.join(src.table(spark, sf_dir, "labels"), "doc_id", "left")
    folded = dims.flexible_schema(
        labelled, ["doc_id", "lang", "source"], ["n_chars", "quality", "toxic"]
    )
    return folded.select(
        "doc_id",
        "lang",
        "source",
        F.size("other_properties").alias("n_properties"),
        dims.property_value("other_properties", "n_chars", "bigint").alias("n_chars"),
        dims.property_value("other_properties", "quality", "int").alias("quality"),
        dims.property_value("other_properties", "toxic", "int").alias("toxic"),
    )


def _variants(spark, sf_dir):
    documents = src.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labelled = documents.join(src.table(spark, sf_dir, "labels"), "doc_id", "left")
    return staged(variants.fold_properties(labelled, ["doc_id"], LABELS), "variants")


LABELS = {"lang": "string", "n_chars": "bigint", "quality": "int", "toxic": "int"}


@query
def variant_fill_rates(spark, sf_dir):
    """How often each property is filled, and whether that earns it a column."""
    rates = variants.fill_rates(_variants(spark, sf_dir))
    return rates.select(
        "key", "n_filled", "value_type", (F.col("fill_rate") >= variants.MIN_FILL).alias("is_promoted")
    )


@query
def variant_promotion(spark, sf_dir):
    """Properties by key, once the often filled ones have columns, and the keys left in the bag."""
    folded = _variants(spark, sf_dir)
    rows = variants.promote(folded, variants.promoted_keys(folded))
    left = F.array_sort(F.map_keys(F.col("properties").cast("map<string,variant>")))
    return rows.select(
        "doc_id",
        *[variants.value_of(rows, key, kind).alias(key) for key, kind in LABELS.items()],
        F.array_join(left, ",").alias("left_in_bag"),
    )


@query
def variant_demotion(spark, sf_dir):
    """All columns back in the bag: what each row holds is what it held before."""
    folded = _variants(spark, sf_dir)
    keys = variants.promoted_keys(folded)
    rows = variants.demote(variants.promote(folded, keys), list(keys))
    held = F.array_sort(F.map_keys(F.col("properties").cast("map<string,variant>")))
    return rows.select(
        "doc_id",
        *[variants.property_of("properties", key, kind).alias(key) for key, kind in LABELS.items()],
        F.array_join(held, ",").alias("in_bag"),
    )


# Property graph


def _fields(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """The property bag as typed columns, parsed once."""
    keys = [c for c in df.columns if c != "properties"]
    return df.select(*keys, props("properties", *kinds)).select(
        *keys, *[F.col(name).cast(kind).alias(name) for name, kind in kinds.items()]
    )


def _pair_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = src.player_names(spark, sf_dir)
    return graph.player_pair_edges(src.game_details(spark, sf_dir), src.DETAIL_ORDER, names=names)


def _players_of(spark: SparkSession, sf_dir: str, **more) -> DataFrame:
    details = src.game_details(spark, sf_dir)
    return graph.player_vertices(details, names=src.player_names(spark, sf_dir), **more)


PLAYS_IN = {
    "start_position": "string",
    "pts": "double",
    "team_id": "string",
    "team_abbreviation": "string",
}
PAIR = {"num_games": "bigint", "subject_points": "double", "object_points": "double"}


@query
def game_vertices(spark, sf_dir):
    vertices = graph.game_vertices(src.games(spark, sf_dir))
    return _fields(vertices, {"pts_home": "bigint", "pts_away": "bigint", "winning_team": "int"})


def _player_fields(vertices):
    flat = _fields(
        vertices,
        {
            "player_name": "string",
            "number_of_games": "bigint",
            "total_points": "double",
            "teams": "string",
        },
    )
    return flat.withColumn("teams", F.array_join(F.from_json("teams", "array<string>"), ","))


@query
def player_vertices(spark, sf_dir):
    return _player_fields(_players_of(spark, sf_dir))


@query
def player_vertices_deduped(spark, sf_dir):
    return _player_fields(_players_of(spark, sf_dir, dedup=True, order_by=src.DETAIL_ORDER))


@query
def team_vertices(spark, sf_dir):
    vertices = graph.team_vertices(src.teams(spark, sf_dir), ["city"])
    names = ("abbreviation", "nickname", "city", "arena")
    return _fields(vertices, {**dict.fromkeys(names, "string"), "year_founded": "int"})


@query
def plays_in_edges(spark, sf_dir):
    details = src.game_details(spark, sf_dir)
    return _fields(graph.plays_in_edges(details, order_by=src.DETAIL_ORDER), PLAYS_IN)


@query
def plays_in_edges_one_game(spark, sf_dir):
    """One edge per player, from the player's first game."""
    details = src.game_details(spark, sf_dir)
    edges = graph.plays_in_edges(details, ["player_id"], ["game_id", *src.DETAIL_ORDER])
    return _fields(edges, PLAYS_IN)


@query
def plays_on_edges(spark, sf_dir):
    edges = graph.plays_on_edges(src.game_details(spark, sf_dir), src.DETAIL_ORDER)
    return _fields(edges, {"num_games": "bigint", "points": "double"})


@query
def player_pair_edges(spark, sf_dir):
    return _fields(_pair_edges(spark, sf_dir), PAIR)


@query
def max_points(spark, sf_dir):
    details = src.game_details(spark, sf_dir)
    edges = graph.plays_in_edges(details, order_by=src.DETAIL_ORDER).unionByName(
        graph.plays_on_edges(details, src.DETAIL_ORDER)
    )
    return graph.max_points(_players_of(spark, sf_dir), edges)


@query
def opponent_stats(spark, sf_dir):
    stats = graph.opponent_stats(_players_of(spark, sf_dir), _pair_edges(spark, sf_dir))
    return stats.select(
        "subject_identifier",
        "player_name",
        "object_identifier",
        "edge_type",
        F.round("games_per_point", 6).alias("games_per_point"),
        F.round("points_per_game", 6).alias("points_per_game"),
        F.col("subject_points").cast("double").alias("subject_points"),
        F.col("num_games").cast("bigint").alias("num_games"),
    )


@query
def graph_integrity(spark, sf_dir):
    """Games entered twice, edges from rows that were not deduplicated, teams left out."""
    details = src.game_details(spark, sf_dir)
    games = graph.game_vertices(src.games(spark, sf_dir))
    vertices = games.unionByName(games).unionByName(_players_of(spark, sf_dir))
    plays_in = graph.plays_in_edges(
        details, ["game_id", "player_id", "line_no"], ["part_id", "pts"]
    )
    edges = plays_in.unionByName(graph.plays_on_edges(details, src.DETAIL_ORDER))
    return graph.graph_integrity(vertices, edges)


def _played(spark, sf_dir):
    details = src.game_details(spark, sf_dir)
    return graph.plays_in_edges(details, order_by=src.DETAIL_ORDER).unionByName(
        graph.plays_on_edges(details, src.DETAIL_ORDER)
    )


@query
def team_reach(spark, sf_dir):
    """From every team to players, their games and other teams, whichever way the edges point."""
    teams = graph.plays_on_edges(src.game_details(spark, sf_dir), src.DETAIL_ORDER).select(
        F.col("object_type").alias("type"), F.col("object_identifier").alias("identifier")
    )
    return reach.neighbourhoods(_played(spark, sf_dir), teams, hops=3)


@query
def game_reach(spark, sf_dir):
    """From every player along the edges' direction: the player's games and teams."""
    players = _players_of(spark, sf_dir).select("type", "identifier")
    return reach.neighbourhoods(_played(spark, sf_dir), players, hops=2, directed=True)


def _rivals(spark, sf_dir):
    """Pairs that met in more than one and a half times as many games as the average pair."""
    pairs = staged(_fields(_pair_edges(spark, sf_dir), {"num_games": "bigint"}), "pairs")
    total = pairs.agg(F.sum("num_games").alias("n")).scalar()
    count = pairs.agg(F.count(F.lit(1)).alias("n")).scalar()
    return pairs.filter(2 * F.col("num_games") * count > 3 * total)


@query
def rival_components(spark, sf_dir):
    """Groups of players bound by frequent meetings; a player without such is alone."""
    players = _players_of(spark, sf_dir).select("type", "identifier")
    return reach.components(_rivals(spark, sf_dir), players)


# Facts


GRAIN = ["l_orderkey", "l_linenumber"]
LINE = [*GRAIN, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


def _lines(spark, sf_dir):
    return src.table(spark, sf_dir, "lineitem").select(*LINE)


@query
def fact_dedup(spark, sf_dir):
    rows = facts.fact_dedup(_lines(spark, sf_dir), GRAIN, LINE[2:])
    return rows.withColumn("l_shipdate", F.to_date("l_shipdate").cast("string"))


@query
def duplicate_report(spark, sf_dir):
    return facts.duplicate_report(_lines(spark, sf_dir), GRAIN)


@query
def feed_dedup(spark, sf_dir):
    """Lines as a feed with a batch per ship year, each merged up the tree as it comes."""
    lines = _lines(spark, sf_dir).withColumn("_year", F.year("l_shipdate"))
    years = sorted((r[0] for r in lines.select("_year").distinct().collect()), key=lambda y: (y is None, y))
    nodes = []
    for year in years:
        batch = lines.filter(F.col("_year").eqNullSafe(year)).drop("_year")
        nodes = facts.dedup_feed(nodes, batch, GRAIN, LINE[2:])
    rows = facts.dedup_rows(nodes, GRAIN, LINE[2:])
    return rows.withColumn("l_shipdate", F.to_date("l_shipdate").cast("string"))


def _denormalized(spark, sf_dir):
    """Nation and region are joined to the suppliers, so that lines are joined twice only."""
    c = F.col
    part = src.table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    supplier = src.table(spark, sf_dir, "supplier").select(
        c("s_suppkey").alias("l_suppkey"), "s_name", c("s_nationkey").alias("nationkey")
    )
    nation = src.table(spark, sf_dir, "nation").select(
        c("n_nationkey").alias("nationkey"), "n_name", c("n_regionkey").alias("regionkey")
    )
    region = src.table(spark, sf_dir, "region").select(c("r_regionkey").alias("regionkey"), "r_name")
    supplier = facts.fact_denormalize(
        supplier,
        [
            (nation, ["nationkey"], ["n_name", "regionkey"]),
            (region, ["regionkey"], ["r_name"]),
        ],
    )
    of_supplier = ["s_name", "nationkey", "n_name", "regionkey", "r_name"]
    return facts.fact_denormalize(
        _lines(spark, sf_dir),
        [(part, ["l_partkey"], ["p_name", "p_brand"]), (supplier, ["l_suppkey"], of_supplier)],
    )


@query
def fact_denormalize(spark, sf_dir):
    return _denormalized(spark, sf_dir).drop("l_shipdate")


@query
def fact_normalize(spark, sf_dir):
    """Dimension rows of suppliers, and whether the key has several. The return flag differs
    from line to line, so it is a conflicting attribute."""
    lines = src.table(spark, sf_dir, "lineitem").select(*LINE, "l_returnflag")
    _, dim, conflicts = facts.fact_normalize(lines, "l_suppkey", ["l_returnflag"])
    return dim.join(conflicts, "l_suppkey", "left").select(
        "l_suppkey", "l_returnflag", F.coalesce("versions", F.lit(1)).alias("versions")
    )


@query
def fact_normalize_narrow(spark, sf_dir):
    """The denormalised lines without the attributes of their supplier."""
    wide = _denormalized(spark, sf_dir).select(*GRAIN, "l_suppkey", "l_quantity", "s_name", "n_name")
    narrow, _, _ = facts.fact_normalize(wide, "l_suppkey", ["s_name", "n_name"])
    return narrow


def _event_facts(spark, sf_dir):
    c = F.col
    return facts.raw_logs_to_facts(
        src.table(spark, sf_dir, "events"),
        {
            "event_id": (c("event_id"), "bigint"),
            "user_id": (c("user_id"), "bigint"),
            "action": (c("event_type"), "string"),
            "place": (c("parsed.k"), "int"),
            "amount": (c("value"), "decimal(18,2)"),
            "happened_on": (c("ts"), "date"),
        },
        grain=["event_id"],
        json_col="props",
        json_schema="k string",
        domains={"action": ["click", "view", "purchase", "signup"]},
    )


@query
def raw_logs_to_facts(spark, sf_dir):
    rows, _ = _event_facts(spark, sf_dir)
    return rows.withColumn("amount", F.col("amount").cast("double")).withColumn(
        "happened_on", F.col("happened_on").cast("string")
    )


@query
def raw_logs_rejects(spark, sf_dir):
    _, rejects = _event_facts(spark, sf_dir)
    return rejects.select("event_id", "event_type", "reason")


def _five_w(spark, sf_dir):
    """Who did what; the place is the label of the same number, which only some have."""
    labels = src.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("event_id"), "quality")
    return facts.fact_five_w(
        src.table(spark, sf_dir, "events").join(labels, "event_id", "left"),
        who=F.col("user_id"),
        what=F.col("event_type"),
        where=F.col("quality"),
        when=F.to_date("ts").cast("string"),
        how=F.lit("log"),
    )


@query
def fact_five_w(spark, sf_dir):
    return _five_w(spark, sf_dir)[0]


@query
def fact_five_w_fill_rates(spark, sf_dir):
    return _five_w(spark, sf_dir)[1].withColumn("fill_rate", F.round("fill_rate", 6))


@query
def retention_filter(spark, sf_dir):
    events = src.table(spark, sf_dir, "events")
    return facts.retention_filter(events, "ts", date(2024, 1, 30), 10).select("event_id", "user_id")
