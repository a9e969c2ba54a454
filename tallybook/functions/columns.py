"""Column expressions shared by the operators. All are built-in, none is a UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_list(names: str | Sequence[str]) -> list[str]:
    """One column name or several, as a list."""
    return [names] if isinstance(names, str) else list(names)


def classify(score: Column, bands: Sequence[tuple[str, float]], default: str) -> Column:
    """Label of the first band whose bound lies strictly below ``score``.

    ``bands`` runs from the highest bound to the lowest. A NULL score gets ``default``.
    """
    if not bands:
        return F.lit(default)
    label = F.when(score > F.lit(bands[0][1]), F.lit(bands[0][0]))
    for name, bound in bands[1:]:
        label = label.when(score > F.lit(bound), F.lit(name))
    return label.otherwise(F.lit(default))


def recency(period: Column, last_active: Column) -> Column:
    """Periods since the entity was last active; NULL if it never was."""
    return period - last_active


def is_current(period: Column, last_active: Column) -> Column:
    return last_active == period


def recency_step(present: Column, previous_gap: Column) -> Column:
    """The same counter taken one period on from the previous snapshot."""
    return F.when(present, F.lit(0)).otherwise(F.coalesce(previous_gap, F.lit(0)) + F.lit(1))


def first_entry(history: Column) -> Column:
    """First element of an array, NULL if it is empty."""
    return F.get(history, F.lit(0))


def last_entry(history: Column) -> Column:
    return F.try_element_at(history, F.lit(-1))


def any_differs(pairs: Sequence[tuple[Column, Column]], null_safe: bool) -> Column:
    """True if one pair differs. Unless ``null_safe``, a NULL side makes that pair unknown."""
    return reduce(or_, [~a.eqNullSafe(b) if null_safe else a != b for a, b in pairs])


def all_equal(pairs: Sequence[tuple[Column, Column]], null_safe: bool) -> Column:
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def ordered_sum(df: DataFrame, name: str, column: str | None = None) -> Column:
    """Sum of a column of ``df``, the same in whatever order the rows come.

    Floating values are added as decimals of six places, as their plain sum would vary with
    the partitioning. ``column`` is the name to read, if it differs from the one in ``df``.
    """
    read = F.col(column or name)
    if df.schema[name].dataType.typeName() in ("float", "double"):
        return F.sum(read.cast("decimal(28,6)")).cast("double")
    return F.sum(read)


def json_properties(fields: Mapping[str, Column]) -> Column:
    """A JSON object holding every field, also those that are NULL."""
    return F.to_json(
        F.struct(*[value.alias(name) for name, value in fields.items()]),
        {"ignoreNullFields": "false"},
    )


def prop(properties: Column | str, name: str) -> Column:
    """Text of one field of a JSON property bag."""
    return F.get_json_object(properties, f"$.{name}")


def props(properties: Column | str, *names: str) -> Column:
    """Several fields as text columns, parsed once. For use in a select, one per select."""
    return F.json_tuple(properties, *names).alias(*names)
