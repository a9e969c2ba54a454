"""Neighbourhoods and components against plain walks over small graphs."""

import random
from collections import deque

import pytest

from tallybook.operators import reach
from tests.fixtures import rows_of
from tests.test_plans import final_plan, no_broadcast  # noqa: F401

EDGE = """subject_identifier string, subject_type string, object_identifier string, object_type string,
          edge_type string, properties string"""
VERTEX = "identifier string, type string"


def edges(spark, pairs, kind="knows"):
    return spark.createDataFrame([(a, "p", b, "p", kind, "{}") for a, b in pairs], EDGE)


def seeds(spark, names):
    return spark.createDataFrame([(n, "p") for n in names], VERTEX)


def walked(pairs, start, hops, directed=False):
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        if not directed:
            near.setdefault(b, set()).add(a)
    seen, queue = {start: 0}, deque([start])
    while queue:
        v = queue.popleft()
        for w in sorted(near.get(v, ())):
            if w not in seen and seen[v] < hops:
                seen[w] = seen[v] + 1
                queue.append(w)
    return seen


def random_pairs(seed, n, m):
    draw = random.Random(seed)
    return [(f"v{draw.randrange(n):02}", f"v{draw.randrange(n):02}") for _ in range(m)]


@pytest.mark.parametrize("directed", [False, True])
@pytest.mark.parametrize("hops", [0, 2, 9])
def test_neighbourhoods(spark, hops, directed):
    pairs = random_pairs(hops, 40, 45)
    starts = ["v00", "v07", "v13", "nobody"]
    found = reach.neighbourhoods(edges(spark, pairs + pairs[:9]), seeds(spark, [*starts, "v00"]), hops, directed=directed)
    expected = [(s, v, n) for s in starts for v, n in walked(pairs, s, hops, directed).items()]
    assert rows_of(found, "seed_identifier", "identifier", "hops") == sorted(expected, key=repr)


def test_edge_types_and_types_of_vertices(spark):
    """A player and a game of one number are two vertices; other edge types do not count."""
    rows = [
        ("1", "player", "1", "game", "plays_in", "{}"),
        ("2", "player", "1", "game", "plays_in", "{}"),
        ("1", "player", "3", "player", "plays_against", "{}"),
    ]
    start = spark.createDataFrame([("1", "player")], VERTEX)
    found = reach.neighbourhoods(spark.createDataFrame(rows, EDGE), start, 5, ["plays_in"])
    assert rows_of(found, "type", "identifier", "hops") == [
        ("game", "1", 1),
        ("player", "1", 0),
        ("player", "2", 2),
    ]


def grouped(pairs, names):
    return sorted(((v, min(walked(pairs, v, 10**6))) for v in names), key=repr)


@pytest.mark.parametrize("seed, n, m", [(1, 60, 30), (2, 60, 50), (3, 60, 90), (4, 5, 0)])
def test_components(spark, seed, n, m):
    pairs = random_pairs(seed, n, m)
    names = [f"v{i:02}" for i in range(n)]
    found = reach.components(edges(spark, pairs), seeds(spark, names))
    assert rows_of(found, "identifier", "component_identifier") == grouped(pairs, names)


def test_components_of_a_long_path(spark):
    """Names in no order along the path; the rounds stay few."""
    names = [f"v{i:03}" for i in range(120)]
    random.Random(5).shuffle(names)
    pairs = list(zip(names, names[1:]))
    found = reach.components(edges(spark, pairs))
    assert rows_of(found, "identifier", "component_identifier") == sorted((v, "v000") for v in names)


def test_components_of_a_hub(spark):
    """One vertex has a third of all links; it joins two of the chains that the others make."""
    spokes = [("hub", f"s{i:04}") for i in range(1500)]
    chains = [(f"c{i:04}", f"c{i + 1:04}") for i in range(3000) if i % 10 != 9]
    bridges = [("hub", "c0000"), ("c0015", "hub")]
    found = reach.components(edges(spark, spokes + chains + bridges))
    by_group = {r["component_identifier"]: r["count"] for r in found.groupBy("component_identifier").count().collect()}
    assert by_group.pop("c0000") == 1 + 1500 + 20
    assert len(by_group) == 298 and set(by_group.values()) == {10}


def test_degenerate(spark):
    none = edges(spark, [])
    assert reach.components(none).collect() == []
    assert reach.neighbourhoods(none, seeds(spark, []), 3).collect() == []
    odd = edges(spark, [("a", "a"), (None, "b"), ("c", None), ("d", "e"), ("d", "e")])
    assert rows_of(reach.components(odd), "identifier", "component_identifier") == [("a", "a"), ("d", "d"), ("e", "d")]
    with_null = reach.neighbourhoods(odd, seeds(spark, ["d", None]), 2)
    assert rows_of(with_null, "identifier", "hops") == [("d", 0), ("e", 1)]


def test_plans_do_not_grow(spark, no_broadcast):  # noqa: F811
    """Rounds are read from tables: the result of many is a union of scans, the components one join."""
    path = edges(spark, [(f"v{i:02}", f"v{i + 1:02}") for i in range(20)])
    near = final_plan(reach.neighbourhoods(path, seeds(spark, ["v00"]), 8))
    assert "Join" not in near and "Exchange" not in near
    assert final_plan(reach.components(path)).count("Join") == 1
