"""Connected components of links between nodes of any comparable type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import written


def labelled(nodes: DataFrame, links: DataFrame, hops: int = 3) -> DataFrame:
    """(node, comp) after some hops in which each node takes its neighbours' least label.

    Nodes with the same label are connected; a component may still have several labels. Least
    labels are found map-side, and links meet them in plain joins.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.filter("a != b").distinct(), "near")
    labels = nodes.select("node", F.col("node").alias("comp"))
    for hop in range(hops):
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("least"))
        joined = labels.join(near, F.col("node") == F.col("a"), "left")
        labels = written(joined.select("node", F.least("comp", "least").alias("comp")), f"labels-{hop}")
    return labels


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of the links (a, b); comp is one of the component's nodes.

    Contraction: each node joins its neighbour that comes first in an order drawn anew each
    round, links are renamed, and those within a node go. Each round takes a constant share of
    the nodes, whatever the graph's shape. Least neighbours are found map-side, and links meet
    the new names in plain joins that adaptive execution may split, so hubs are no hot tasks.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.filter("a != b").distinct(), "links")
    names = written(edges.select(F.col("a").alias("node")).distinct().withColumn("comp", F.col("node")), "names")
    turn = 0
    while not edges.isEmpty():

        def ranked(column: str, turn: int = turn) -> Column:
            return F.struct(F.xxhash64(F.lit(turn), F.col(column)).alias("r"), F.col(column).alias("n"))

        first = edges.groupBy("a").agg(F.min(ranked("b")).alias("best"))
        moved = first.filter(F.col("best") < ranked("a")).select(
            F.col("a").alias("was"), F.col("best.n").alias("now")
        )
        moved = written(moved, f"moved-{turn}")

        def renamed(df: DataFrame, column: str, moved: DataFrame = moved) -> DataFrame:
            joined = df.join(moved, F.col(column) == F.col("was"), "left")
            return joined.withColumn(column, F.coalesce("now", column)).drop("was", "now")

        names = written(renamed(names, "comp"), f"names-{turn}")
        edges = written(
            renamed(renamed(edges, "a"), "b").filter("a != b").distinct(), f"links-{turn}"
        )
        turn += 1
    return names
