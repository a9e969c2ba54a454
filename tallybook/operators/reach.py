"""Reach over many hops of the property graph: neighbourhoods and connected components.

A vertex is known by its type and identifier. Every round is written below the shared folder,
so a plan never grows with the rounds and a lost executor costs no more than its round. A row of
a round is small, and neighbours are reduced map-side; joins carry no hint, and one side of each is
partitioned by a struct, so that adaptive execution may split the side on which a hub is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.sources.shared import staged


def _vertex(side: str) -> Column:
    return F.struct(
        F.col(f"{side}_type").alias("type"), F.col(f"{side}_identifier").cast("string").alias("identifier")
    )


def links(edges: DataFrame, edge_types: Sequence[str] = ()) -> DataFrame:
    """Distinct (a, b) of the edges, of the given types if any. An edge with an end that has no
    type or identifier is no link; one from a vertex to itself is."""
    if edge_types:
        edges = edges.filter(F.col("edge_type").isin(list(edge_types)))
    ends = [f"{side}_{part}" for side in ("subject", "object") for part in ("type", "identifier")]
    return edges.dropna(subset=ends).select(_vertex("subject").alias("a"), _vertex("object").alias("b")).distinct()


def both_ways(linked: DataFrame) -> DataFrame:
    back = linked.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return linked.unionByName(back).distinct()


def neighbourhoods(
    edges: DataFrame,
    seeds: DataFrame,
    hops: int,
    edge_types: Sequence[str] = (),
    directed: bool = False,
) -> DataFrame:
    """The vertices within ``hops`` of each seed, with the fewest hops that lead there.

    ``seeds`` has type and identifier. The result has seed_type, seed_identifier, type,
    identifier, hops; a seed reaches itself in 0 hops, also if no edge has it. The frontier of a
    round is what the last one found new. Without directions a neighbour of round n was found in
    round n - 2, n - 1 or now, so only two rounds are looked through; with them, all are.
    """
    linked = links(edges, edge_types)
    linked = staged(linked if directed else both_ways(linked), "links")
    start = F.struct("type", F.col("identifier").cast("string").alias("identifier"))
    known = seeds.dropna(subset=["type", "identifier"]).select(start.alias("seed")).distinct()
    rounds = [staged(known.select("seed", F.col("seed").alias("vertex")), "reach-0")]
    while len(rounds) <= hops:
        met = rounds[-1].join(linked, F.col("vertex") == F.col("a"))
        met = met.select("seed", F.col("b").alias("vertex")).distinct()
        for before in rounds if directed else rounds[-2:]:
            met = met.join(before, ["seed", "vertex"], "left_anti")
        found = staged(met, f"reach-{len(rounds)}")
        if found.isEmpty():
            break
        rounds.append(found)
    levels = [r.withColumn("hops", F.lit(n)) for n, r in enumerate(rounds)]
    reached = levels[0]
    for level in levels[1:]:
        reached = reached.unionByName(level)
    return reached.select(
        F.col("seed.type").alias("seed_type"),
        F.col("seed.identifier").alias("seed_identifier"),
        F.col("vertex.type").alias("type"),
        F.col("vertex.identifier").alias("identifier"),
        "hops",
    )


def _downwards(pairs: DataFrame) -> DataFrame:
    down = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return down.filter("a != b").distinct()


def _least(linked: DataFrame) -> DataFrame:
    """The least neighbour of each vertex, keyed by the vertex as a struct: the join with the
    links shuffles it once more, and the links of a hub can be split."""
    least = linked.groupBy(F.struct("a").alias("_of")).agg(F.min("b").alias("least"))
    return least.select(F.col("_of.a").alias("a"), F.least("least", "_of.a").alias("least"))


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every vertex links its greater neighbours to its least one."""
    linked = both_ways(pairs)
    greater = linked.join(_least(linked), "a").filter(F.col("b") > F.col("a"))
    return greater.select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(pairs: DataFrame) -> DataFrame:
    """Every vertex links itself and its smaller neighbours to its least one."""
    down = _downwards(pairs)
    joined = down.join(_least(down), "a")
    own = joined.select("a", F.col("least").alias("b"))
    smaller = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return smaller.unionByName(own).filter("a != b").distinct()


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every vertex has one parent at most, and no parent has one itself."""
    roles = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("vertex"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                F.struct(F.col("b").alias("vertex"), F.lit(0).alias("up"), F.lit(1).alias("down")),
            )
        ).alias("r")
    )
    seen = roles.groupBy("r.vertex").agg(F.sum("r.up").alias("up"), F.max("r.down").alias("down"))
    return seen.filter((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1))).isEmpty()


def components(
    edges: DataFrame, vertices: DataFrame | None = None, edge_types: Sequence[str] = ()
) -> DataFrame:
    """The component of each vertex: type, identifier, component_type, component_identifier.

    A component is named by its least vertex, by type and then identifier. ``vertices`` (type,
    identifier) adds those that no edge has, each alone. Rounds alternate large stars and small
    stars, which take a number of rounds that grows with the logarithm of the number of vertices and
    never hold more pairs than there are links, until the pairs are stars.
    """
    linked = staged(links(edges, edge_types), "links")
    pairs = _downwards(linked)
    turn = 0
    while not _are_stars(pairs):
        pairs = staged(_small_star(_large_star(pairs)), f"stars-{turn}")
        turn += 1
    everyone = both_ways(linked).select(F.col("a").alias("vertex"))
    if vertices is not None:
        key = F.struct("type", F.col("identifier").cast("string").alias("identifier"))
        everyone = everyone.unionByName(vertices.dropna(subset=["type", "identifier"]).select(key.alias("vertex")))
    roots = pairs.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    alone = everyone.distinct().join(roots, "vertex", "left")
    root = F.coalesce("root", "vertex")
    return alone.select(
        "vertex.type",
        "vertex.identifier",
        root["type"].alias("component_type"),
        root["identifier"].alias("component_identifier"),
    )
