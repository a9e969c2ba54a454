"""Checks that fail the query which reads the rows, without a job of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check(holds: Column, message: str, told: Sequence[str] = ()) -> Column:
    """True where ``holds``; anywhere else the query fails, naming the given columns' values."""
    values = F.concat_ws(", ", *[F.col(c).cast("string") for c in told])
    return F.when(holds, F.lit(True)).otherwise(F.raise_error(F.concat_ws(" ", F.lit(message), values)))


def failing_without(needed: DataFrame, rows: DataFrame, message: str) -> DataFrame:
    """``rows`` as they are, except that reading any fails if ``needed`` has no row.

    Whether it has one is a subquery that stops at the first row it finds.
    """
    found = needed.limit(1).select(F.count(F.lit(1)).alias("_n")).scalar()
    return rows.filter(check(found > 0, message))
