"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies. Its whole part is sure, its
fraction is rounded with the others' of its source: two documents trade expected words until one
has a whole number of copies, the other goes on. So a source's words stay at their target, and
at most one document of it is left to chance. The trading is a reduction tree: documents within
cells, then the cells' last documents within groups of cells, until one is left of the source.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import scratch, words, written

MOST_COPIES = 3
# Documents that one task reduces at a time, and cells that one step of the tree joins.
CELL_ROWS = 2048
FAN_IN = 64


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def targets(sizes: DataFrame, source_col: str = "source", most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, n_docs, target) of each source; null is a source of its own, the last.

    Sources in the order of their code points weigh 1, 2, 3 and so on in turn. A target stops at
    ``most`` times its source's size; the excess is shared out again by weight. The level at
    which that ends is found by sorting the sources by size over weight: those up to some place
    stop, the others share the rest. One row per source is sorted, never one per document.
    """
    totals = sizes.groupBy(F.col(source_col).alias("source")).agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = totals.withColumn("weight", (place - 1) % 3 + 1).withColumn(
        "cap", F.col("source_size") * most
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = rest / F.sum("weight").over(onward)  # a weight's share, were all before it stopped
    stopped = F.col("cap") <= level * F.col("weight")
    found = ranked.withColumn("level", level).withColumn("stopped", stopped)
    free_level = F.min(F.when(~F.col("stopped"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(
        Window.partitionBy()
    )["level"]
    target = F.when(F.col("stopped"), F.col("cap")).otherwise(free_level * F.col("weight"))
    return found.select("source", "source_size", "n_docs", target.cast("double").alias("target"))


def _trade(size: np.ndarray, part: np.ndarray, seed: int) -> np.ndarray:
    """Round parts so that the sum of size times part stays; at most one stays a fraction."""
    out = part.copy()
    chance = np.random.default_rng(seed).random(len(part) + 1)
    held = -1
    for i in np.flatnonzero((part > 0) & (part < 1)).tolist():
        if held < 0:
            held = i
            continue
        a, b, sa, sb = out[held], out[i], size[held], size[i]
        up = min(1 - a, b * sb / sa)  # what held may gain, paid for by i
        down = min(a, (1 - b) * sb / sa)  # what it may lose, given to i
        if chance[i] * (up + down) < down:
            whole = up == 1 - a
            a, b = (1.0, b - up * sa / sb) if whole else (a + up, 0.0)
        else:
            whole = down == a
            a, b = (0.0, b + down * sa / sb) if whole else (a - down, 1.0)
        out[held], out[i] = a, min(max(b, 0.0), 1.0)
        held = i if 0 < out[i] < 1 else held if 0 < out[held] < 1 else -1
    return out


_ROW = "doc {kind}, size long, source_size long, target double, sure int, part double, tie long, source string, cell int"


def _reduce(rows: DataFrame, schema: str, level: int, last: bool) -> DataFrame:
    def reduce(table: pa.Table) -> pa.Table:
        table = table.sort_by([("tie", "ascending"), ("doc", "ascending"), ("size", "ascending")])
        size = table["size"].to_numpy().astype(float)
        part = table["part"].to_numpy()
        cell, name = table["cell"][0].as_py(), table["source"][0].as_py() or ""
        seed = [level, cell, *name.encode()]
        part = _trade(size, part, seed)
        if last:
            part = (part > np.random.default_rng([*seed, 1]).random(len(part))).astype(float)
        at = table.schema.get_field_index("part")
        return table.set_column(at, "part", pa.array(part))

    return rows.groupBy("source", "cell").applyInArrow(reduce, schema)


def _decided(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, most: int, drawn_by: Sequence[str] | None
) -> list[DataFrame]:
    """The documents whose copies each level of the tree settles, in written tables."""
    kind = docs.schema[id_col].dataType.simpleString()
    sizes = written(
        docs.select(
            F.col(id_col).alias("doc"),
            word_count(F.col(text_col)).alias("size"),
            F.col(source_col).cast("string").alias("source"),
            F.xxhash64(*(drawn_by or [id_col]), word_count(F.col(text_col))).alias("tie"),
        ),
        "sizes",
    )
    goal = written(targets(sizes, "source", most), "targets")
    widest = goal.agg(F.max("n_docs")).first()[0] or 0
    by_source = goal.withColumnRenamed("source", "of_source")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    sure = F.least(F.floor(expected + 1e-12), F.lit(most))
    part = F.greatest(expected - sure, F.lit(0.0))
    tie = F.col("tie")
    cells = F.greatest(F.ceil(F.col("n_docs") / CELL_ROWS), F.lit(1))
    rows = sizes.join(by_source, F.col("source").eqNullSafe(F.col("of_source"))).select(
        "doc",
        "size",
        "source_size",
        "target",
        sure.cast("int").alias("sure"),
        F.when((F.col("size") > 0) & (part > 1e-9), part).otherwise(0.0).alias("part"),
        "tie",
        "source",
        F.pmod(tie, cells).cast("int").alias("cell"),
    )
    schema = _ROW.format(kind=kind)
    rows_now = -(-widest // CELL_ROWS) or 1
    decided, level = [], 0
    while True:
        last = rows_now <= 1
        # the level's outcome feeds the result and the next level: written once, read twice
        reduced = written(_reduce(rows, schema, level, last), f"mixed-{level}")
        whole = (F.col("part") == 0.0) | (F.col("part") == 1.0)
        decided.append(reduced.filter(whole))
        if last:
            break
        rows = reduced.filter(~whole).withColumn("cell", F.floor(F.col("cell") / FAN_IN).cast("int"))
        rows_now = math.ceil(rows_now / FAN_IN)
        level += 1
    return decided


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    most: int = MOST_COPIES,
    drawn_by: Sequence[str] | None = None,
) -> DataFrame:
    """(id, size, source_size, target, taken, copies) of every document.

    A document's size is its number of words; it is taken in whole copies, ``most`` at most. A
    null text has no words and takes none, in one copy or more; a source without words has
    target 0. Each source's words differ from its target by less than one copy of one document.
    Rows with the same identifier are documents of their own. The draw follows from source and
    identifiers alone, or the columns ``drawn_by`` where identifiers are only numbers of rows:
    reruns agree, however the rows are spread. An empty table gives no rows; columns other than
    those named play no part, whatever they are called; texts of any length are counted whole.
    """
    with scratch(docs.sparkSession, keep=("mixed",)):
        decided = _decided(docs, id_col, text_col, source_col, most, drawn_by)
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    copies = (F.col("sure") + F.col("part").cast("int")).alias("copies")
    return out.select(
        F.col("doc").alias(id_col), "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies
    )


def repeat(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents, each as often as the mix takes it. Identifiers must be distinct: number the
    rows where they may not be."""
    copies = mixed.filter("copies > 0").select(F.col(id_col).alias("_of"), F.col("copies").alias("_n"))
    joined = docs.join(copies, F.col(id_col).eqNullSafe(F.col("_of")))
    repeated = joined.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])




def repeat_numbered(docs: DataFrame, mixed: DataFrame, id_col: str = "row") -> DataFrame:
    """``repeat`` for rows numbered by ``monotonically_increasing_id``, all of which are in the mix.

    The copies of a partition's rows are one array, in their order, written as a few bits for each
    row. So texts are shuffled only if these arrays are too large to broadcast.
    """
    number = F.col(id_col)
    part, place = F.shiftright(number, 33), number.bitwiseAND((1 << 33) - 1)
    listed = mixed.select(
        part.alias("_part"), F.struct(place.alias("at"), F.col("copies").cast("tinyint").alias("n")).alias("_row")
    )
    gap = F.raise_error(F.lit("rows of a partition are missing in the mix or come twice"))
    whole = (F.max("_row.at") == F.count(F.lit(1)) - 1) & (F.min("_row.at") == 0)
    in_order = F.transform(F.array_sort(F.collect_list("_row")), lambda x: x["n"])
    taken = listed.groupBy("_part").agg(F.when(whole, in_order).otherwise(gap).alias("_taken"))
    joined = docs.join(written(taken, "taken"), part == F.col("_part"))
    found = joined.withColumn("_n", F.get("_taken", place.cast("int"))).filter("_n > 0")
    repeated = found.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
