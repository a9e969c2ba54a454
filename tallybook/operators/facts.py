"""Fact tables: copies, dimensions in and out, and facts from raw logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.sources.shared import staged


def first_per(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order_by``, then by all other columns, so that the
    result never depends on how the rows are spread.

    Select the needed columns beforehand. Each task keeps one row per key before the exchange,
    so a key with very many copies sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    order = [*order_by, *rest]
    if not order:
        return df.distinct()
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def fact_dedup(df: DataFrame, grain: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    return first_per(df, grain, order_by)


def duplicate_report(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of copies."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def dedup_batch(df: DataFrame, grain: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per grain, the one that ``fact_dedup`` keeps, and ``copies``, its number of rows.

    Rows that already have ``copies`` count as so many, so results of several batches go through
    this again, in any order and any grouping. It is an aggregate with a map-side half.
    """
    rest = [c for c in df.columns if c not in grain and c not in order_by and c != "copies"]
    order = [*order_by, *rest]
    copies = F.sum("copies") if "copies" in df.columns else F.count(F.lit(1))
    if not order:
        return df.groupBy(*grain).agg(copies.alias("copies"))
    kept = df.groupBy(*grain).agg(F.min(F.struct(*order)).alias("_first"), copies.alias("copies"))
    columns = [c if c in grain else f"_first.{c}" for c in df.columns if c != "copies"]
    return kept.select(*columns, "copies")


def dedup_feed(
    nodes: Sequence[tuple[int, DataFrame]],
    batch: DataFrame,
    grain: Sequence[str],
    order_by: Sequence[str] = (),
) -> list[tuple[int, DataFrame]]:
    """``nodes`` and one more batch of a feed: a list of (number of batches, their rows by
    ``dedup_batch``), each with more batches than the next.

    The new batch is reduced alone; then the last two nodes merge while they hold as many batches.
    After n batches there are log2(n) nodes at most, and a row was merged as often at most, so a
    batch costs its path and not all that came before. Nodes are written, and stay for those who
    hold earlier lists.
    """
    size, rows = 1, dedup_batch(batch, grain, order_by)
    kept = list(nodes)
    while kept and kept[-1][0] == size:
        rows = dedup_batch(kept.pop()[1].unionByName(rows), grain, order_by)
        size *= 2
    return [*kept, (size, staged(rows, "feed"))]


def dedup_rows(
    nodes: Sequence[tuple[int, DataFrame]], grain: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """The whole feed: ``fact_dedup`` of all its batches, with ``copies``."""
    rows = nodes[0][1]
    for _, node in nodes[1:]:
        rows = rows.unionByName(node)
    return rows if len(nodes) == 1 else dedup_batch(rows, grain, order_by)


def unique_dimension(dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """``dim`` as it is, except that a key held twice fails the query that reads it.

    The check is partitioned by the key as one struct, so that a join on the key shuffles the
    dimension once more: adaptive execution splits hot keys only between two plain shuffles.
    """
    told = F.concat_ws(", ", *[F.col(k).cast("string") for k in on])
    clash = F.raise_error(F.concat(F.lit("dimension key is not unique: "), told))
    copies = F.count(F.lit(1)).over(Window.partitionBy(F.struct(*on)))
    checked = dim.withColumn("_copies", copies)
    return checked.filter(F.when(F.col("_copies") > 1, clash).otherwise(F.lit(True))).drop("_copies")


def fact_denormalize(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str], Sequence[str]]]
) -> DataFrame:
    """Facts with attributes of dimensions, each given as (dimension, on, columns).

    The row count stays: joins are left joins on keys that are checked to be unique. No join
    is hinted: Spark broadcasts a dimension only below its size threshold, and in a shuffled
    left join it can split the fact side where a key is hot.
    """
    for dim, on, cols in dims:
        fact = fact.join(unique_dimension(dim.select(*on, *cols), list(on)), list(on), "left")
    return fact


def fact_normalize(
    df: DataFrame, key: str, dim_cols: Sequence[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(narrow facts, distinct dimension rows, keys with more than one dimension row)."""
    fact = df.drop(*dim_cols)
    dim = df.select(key, *dim_cols).distinct()
    conflicts = dim.groupBy(key).agg(F.count(F.lit(1)).alias("versions")).filter("versions > 1")
    return fact, dim, conflicts


def raw_logs_to_facts(
    raw: DataFrame,
    mapping: Mapping[str, tuple[Column, str]],
    grain: Sequence[str],
    json_col: str | None = None,
    json_schema: str | None = None,
    domains: Mapping[str, Sequence[str]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(facts, rejects) of raw log rows.

    ``mapping`` gives each fact column its source expression and type; expressions may use
    ``parsed.<field>`` of the JSON column. A row is rejected if its JSON is broken, a value
    cannot be cast, a grain column is NULL or a value is outside its domain. Facts are unique
    on ``grain``: of several rows the first by all its fact columns stays, the others are
    rejected as copies.
    """
    rows = raw
    if json_col:
        # Out of a generator, lest each use below parses the text again in the filter.
        broken = {"columnNameOfCorruptRecord": "_broken"}
        parsed = F.explode(F.array(F.from_json(json_col, f"{json_schema}, _broken string", broken)))
        rows = rows.select("*", parsed.alias("parsed"))
    sources = {f"_raw_{name}": source for name, (source, _) in mapping.items()}
    typed = rows.withColumns(sources).withColumns(
        {name: F.col(f"_raw_{name}").try_cast(kind) for name, (_, kind) in mapping.items()}
    )
    reasons = [
        F.when(F.col(f"_raw_{n}").isNotNull() & F.col(n).isNull(), F.lit(f"{n}: not a {kind}"))
        for n, (_, kind) in mapping.items()
    ]
    if json_col:
        reasons.insert(0, F.when(F.col("parsed._broken").isNotNull(), F.lit(f"{json_col}: not JSON")))
    reasons += [
        F.when(F.col(f"_raw_{n}").isNull(), F.lit(f"{n}: missing"))
        for n in grain
    ]
    reasons += [
        F.when(~F.col(n).isin(list(members)), F.lit(f"{n}: not in domain"))
        for n, members in (domains or {}).items()
    ]
    judged = typed.withColumn("reason", F.coalesce(*reasons))
    facts = judged.filter(F.col("reason").isNull()).select(*mapping)
    # good rows are numbered within their grain; others are spread by their own hash
    plain = [f.name for f in raw.schema if f.dataType.typeName() not in ("map", "variant")]
    own = F.xxhash64(*plain)
    order = [c for c in mapping if c not in grain]
    copies = Window.partitionBy(F.when(F.col("reason").isNotNull(), own), *grain).orderBy(*order, own)
    copy = F.col("reason").isNull() & (F.row_number().over(copies) > 1)
    told = F.when(copy, F.lit(f"{', '.join(grain)}: copy")).otherwise(F.col("reason"))
    rejects = judged.withColumn("reason", told).filter(F.col("reason").isNotNull())
    return first_per(facts, list(grain)), rejects.select(*raw.columns, "reason")


def fact_five_w(
    df: DataFrame, who: Column, what: Column, where: Column, when: Column, how: Column
) -> tuple[DataFrame, DataFrame]:
    """(facts as who, what, where, when, how; fill rate of each of the five columns)."""
    five = {"who": who, "what": what, "where": where, "when": when, "how": how}
    shaped = df.select(*[column.alias(name) for name, column in five.items()])
    filled = shaped.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"n_{c}") for c in five]
    )
    rates = filled.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col("n").alias("total_rows"),
                        F.col(f"n_{c}").alias("filled_rows"),
                        (F.col(f"n_{c}") / F.nullif(F.col("n"), F.lit(0))).alias("fill_rate"),
                    )
                    for c in five
                ]
            )
        )
    )
    return shaped, rates


def retention_filter(df: DataFrame, ts: str, as_of: date, days: int) -> DataFrame:
    """Rows no older than ``days`` days before the given date; the bound reaches the scan."""
    oldest = F.lit(as_of - timedelta(days=days)).cast(df.schema[ts].dataType)
    return df.filter(F.col(ts) >= oldest)
