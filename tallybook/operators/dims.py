"""Additive dimensions, enums and flexible schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.operators.checks import check
from tallybook.operators.idempotent import write_partitioned
from tallybook.schemas import ENUM_LIMIT


def additivity_check(
    df: DataFrame, entity: str, dim: str, window: str | None = None
) -> DataFrame:
    """Per window: distinct entities summed over the dimension's members, distinct entities in
    all, and entities with more than one member. Additive if and only if there are none.

    The first aggregate leaves one row per (window, entity, member); all counts follow from
    it, so nothing is counted as distinct a second time and a busy entity shrinks map-side.
    """
    by = [window] if window else []
    members = df.filter(F.col(entity).isNotNull()).select(*by, entity, dim).distinct()
    entities = members.groupBy(*by, entity).agg(F.count(F.lit(1)).alias("_members"))
    return entities.groupBy(*by).agg(
        F.coalesce(F.sum("_members"), F.lit(0)).alias("sum_over_members"),
        F.count(F.lit(1)).alias("total_entities"),
        F.count_if(F.col("_members") > 1).alias("multi_member_entities"),
        (F.count_if(F.col("_members") > 1) == 0).alias("is_additive"),
    )


def additivity_checks(df: DataFrame, entity: str, dims: Sequence[str]) -> DataFrame:
    """``additivity_check`` of several dimensions at once, one row for each, from one pass.

    Members are counted per entity and all dimensions together, so there is one scan and one
    exchange on the entity, whatever the number of dimensions.
    """
    members = df.filter(F.col(entity).isNotNull()).select(entity, *dims).distinct()
    # NULL is a member too, which count_distinct passes over
    entities = members.groupBy(entity).agg(
        *[
            (F.count_distinct(F.col(d)) + F.max(F.col(d).isNull().cast("int"))).alias(f"_n_{d}")
            for d in dims
        ]
    )
    counts = entities.select(
        F.inline(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(f"_n_{d}").alias("_n")) for d in dims]))
    )
    return counts.groupBy("dimension").agg(
        F.sum("_n").alias("sum_over_members"),
        F.count(F.lit(1)).alias("total_entities"),
        F.count_if(F.col("_n") > 1).alias("multi_member_entities"),
        (F.count_if(F.col("_n") > 1) == 0).alias("is_additive"),
    )


def entity_counts(df: DataFrame, by: Sequence[str], entity: str, measures: Sequence[str]) -> DataFrame:
    """One row per ``by`` with the sums of the measures and the number of entities.

    Rows are aggregated per entity first, so no set of distinct values is built anywhere.
    """
    sums = [F.sum(m).alias(m) for m in measures]
    per_entity = df.groupBy(*by, entity).agg(*sums)
    return per_entity.groupBy(*by).agg(*sums, F.count(F.col(entity)).alias("entities"))


def additive_rollup(
    counts: DataFrame, keep: Sequence[str], measures: Sequence[str], checked: DataFrame
) -> DataFrame:
    """Roll rows of ``entity_counts`` up to ``keep``: measures and entities are summed.

    That is right only if the dimensions that go are additive. ``checked`` says so: rows of
    ``additivity_checks``, by the dimensions' names. The query fails if one that goes is not
    additive there, or not checked at all. Over a dimension that is not, use ``distinct_rollup``
    or count again from the entities, by ``entity_counts``.
    """
    if "dimension" not in checked.columns:
        raise ValueError("the outcome of a check must name its dimension, as additivity_checks does")
    gone = [c for c in counts.columns if c not in (*keep, *measures, "entities")]
    own = F.col("dimension").isin(gone)
    fine = checked.select(
        (F.count_distinct(F.when(own & F.col("is_additive"), F.col("dimension"))) == len(gone))
        & (F.count_if(own & ~F.col("is_additive")) == 0)
    ).scalar()
    sums = [F.sum(m).alias(m) for m in (*measures, "entities")]
    safe = counts.filter(check(F.coalesce(fine, F.lit(False)), "a dimension to roll up is not additive"))
    return safe.groupBy(*keep).agg(*sums)


def distinct_structures(df: DataFrame, by: Sequence[str], entity: str) -> DataFrame:
    """Mergeable sets of whole-numbered entities: one row per ``by`` and bucket of 32,768 numbers,
    with a bitmap of the numbers in it. ``distinct_rollup`` merges and counts them.

    A set costs at most 4 KB per bucket that it touches, so number entities densely. Sets are
    built map-side; a member with a third of all rows sends one bitmap per task and bucket. Rows
    without an entity are in no set.
    """
    number = F.col(entity).cast("long")
    bucket, place = F.bitmap_bucket_number(number), F.bitmap_bit_position(number)
    placed = df.filter(number.isNotNull()).select(*by, bucket.alias("bucket"), place.alias("_place"))
    return placed.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_place").alias("members"))


def distinct_rollup(structures: DataFrame, keep: Sequence[str], name: str = "entities") -> DataFrame:
    """Distinct entities per ``keep`` from rows of ``distinct_structures``, over any dimension,
    additive or not: bitmaps of one bucket are merged bit by bit, buckets hold different numbers
    and are summed. The rows counted from are not read again. Without ``keep`` one row for all.

    The merged sets stay mergeable: see ``merged_structures``.
    """
    counted = F.coalesce(F.sum(F.bitmap_count("members")), F.lit(0)).alias(name)
    return merged_structures(structures, keep).groupBy(*keep).agg(counted)


def merged_structures(structures: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Rows of ``distinct_structures`` with fewer dimensions, and so of batches put together."""
    return structures.groupBy(*keep, "bucket").agg(F.bitmap_or_agg("members").alias("members"))


# Logarithm of a sketch's size. The standard error is 1.04 / 2**6 = 1.63 % for HLL, and
# 1 / 2**6 = 1.56 % for theta.
SKETCH_SIZE = 12


def distinct_sketches(
    df: DataFrame, by: Sequence[str], entity: str, kind: str = "hll", size: int = SKETCH_SIZE
) -> DataFrame:
    """Mergeable estimates of distinct entities of any type in bounded space: one row per ``by``.

    'hll' keeps 2**size registers, for counts of unions. 'theta' keeps up to 2**size hashes, for
    counts of unions, intersections and differences. Rows without an entity are in no sketch.
    """
    sketch = {"hll": F.hll_sketch_agg, "theta": F.theta_sketch_agg}[kind]
    told = df.filter(F.col(entity).isNotNull()).select(*by, F.col(entity).cast("string").alias("_entity"))
    return told.groupBy(*by).agg(sketch("_entity", size).alias("sketch"))


def sketch_rollup(
    sketches: DataFrame, keep: Sequence[str], kind: str = "hll", size: int = SKETCH_SIZE, name: str = "entities"
) -> DataFrame:
    """Estimated distinct entities per ``keep`` from rows of ``distinct_sketches``."""
    if kind == "hll":
        merged = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    else:
        merged = F.theta_sketch_estimate(F.theta_union_agg("sketch", size))
    return sketches.groupBy(*keep).agg(merged.alias(name))


def sketch_overlap(sketches: DataFrame, dim: str, size: int = SKETCH_SIZE) -> DataFrame:
    """Estimated entities that two members of ``dim`` share, for every two members, the smaller
    named first. ``sketches`` are 'theta' ones; there is a row for each two members, so ``dim``
    should be an enum."""
    merged = sketches.groupBy(dim).agg(F.theta_union_agg("sketch", size).alias("sketch"))
    a = merged.select(F.col(dim).alias("member"), F.col("sketch").alias("_a"))
    b = merged.select(F.col(dim).alias("other"), F.col("sketch").alias("_b"))
    shared = F.theta_sketch_estimate(F.theta_intersection("_a", "_b"))
    return a.join(b, F.col("member") < F.col("other")).select("member", "other", shared.alias("shared_entities"))


def enum_validate(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values outside their column's domain, with the number of rows. One scan for all
    columns; a domain is a short literal list. NULL is no violation."""
    outside = [
        F.when(
            ~F.col(c).isin(list(members)),
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")),
        )
        for c, members in domains.items()
    ]
    return (
        df.select(F.explode(F.array_compact(F.array(*outside))).alias("_v"))
        .groupBy("_v.column_name", "_v.value")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def enum_candidates(
    df: DataFrame, cols: Sequence[str], limit: int = ENUM_LIMIT, exact: bool = True
) -> DataFrame:
    """Distinct values per column, and whether there are fewer than ``limit``.

    The exact count shuffles every distinct value; ``exact=False`` estimates in fixed memory
    and suits a first look at wide tables.
    """
    count = F.count_distinct if exact else F.approx_count_distinct
    counts = df.agg(*[count(F.col(c)).alias(c) for c in cols])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).alias("distinct_values"),
            (F.col(c) < limit).alias("is_candidate"),
        )
        for c in cols
    ]
    return counts.select(F.inline(F.array(*rows)))


def enum_subpartition(
    df: DataFrame, path: str, period: str, enum_col: str, domain: Sequence[str]
) -> DataFrame:
    """Write by (period, enum) and list every sub-partition, expected or written, with its row
    count. Members without rows have 0; ``in_domain`` is false for written ones outside the
    domain, NULL among them."""
    write_partitioned(df, path, [period, enum_col])
    spark = df.sparkSession
    written = spark.read.schema(df.schema).parquet(path).groupBy(period, enum_col).count()
    rows = [F.col(period), F.col(enum_col).cast("string").alias(enum_col)]
    none, inside = F.lit(0).cast("bigint").alias("count"), F.col(enum_col).isin(list(domain))
    found = written.select(*rows, "count", F.coalesce(inside, F.lit(False)).alias("in_domain"))
    expected = written.select(period).distinct().select(
        period,
        F.explode(F.array(*[F.lit(m) for m in domain])).alias(enum_col),
        none,
        F.lit(True).alias("in_domain"),
    )
    return found.unionByName(expected).groupBy(period, enum_col, "in_domain").agg(
        F.sum("count").alias("n_rows"), (F.sum("count") == 0).alias("is_missing")
    )


def shared_schema(
    sources: Mapping[str, tuple[DataFrame, str, Mapping[str, Column]]],
    common: Sequence[str],
) -> DataFrame:
    """Several sources under one schema: id, type, common columns, other properties.

    Each source is (rows, id column, {target column: expression}). Targets outside ``common``
    go to the ``properties`` map as text; a common column a source lacks is NULL.
    """
    parts = []
    for kind, (df, id_col, mapping) in sources.items():
        extra = {name: col for name, col in mapping.items() if name not in common}
        parts.append(
            df.select(
                F.col(id_col).cast("string").alias("id"),
                F.lit(kind).alias("type"),
                *[mapping.get(c, F.lit(None)).cast("string").alias(c) for c in common],
                _filled_map(extra).alias("properties"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def flexible_schema(
    df: DataFrame, keep: Sequence[str], fold: Sequence[str], name: str = "other_properties"
) -> DataFrame:
    """Rarely filled columns folded into one map of text values, without the empty ones."""
    return df.select(*keep, _filled_map({c: F.col(c) for c in fold}).alias(name))


def property_value(properties: str, key: str, kind: str = "string") -> Column:
    """Read a folded column back; NULL where it was not filled."""
    return F.try_element_at(F.col(properties), F.lit(key)).cast(kind)


def _filled_map(columns: Mapping[str, Column]) -> Column:
    if not columns:
        return F.create_map().cast("map<string,string>")
    names = F.array(*[F.lit(n) for n in columns])
    values = F.array(*[c.cast("string") for c in columns.values()])
    return F.map_filter(F.map_from_arrays(names, values), lambda _, v: v.isNotNull())
