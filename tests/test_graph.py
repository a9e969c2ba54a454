import json

import pytest
from pyspark.sql import functions as F

from tallybook.operators import graph
from tallybook.schemas import EDGE_KEY, EDGES, VERTICES
from tests.fixtures import DETAILS, details, rows_of

ORDER = ("start_position", "pts")


def properties(df, *key):
    return {tuple(r[k] for k in key): json.loads(r.properties) for r in df.collect()}


def types(df):
    return {f.name: f.dataType for f in df.schema.fields}


def test_game_vertices(spark):
    games = spark.createDataFrame(
        [(1, 100.0, 90.0, 1, 7, 8), (2, 80.0, 90.0, 0, 7, 8), (3, None, 1.0, None, 7, 8)],
        """game_id int, pts_home float, pts_away float, home_team_wins int, home_team_id int,
           visitor_team_id int""",
    )
    vertices = graph.game_vertices(games)
    assert types(vertices) == {f.name: f.dataType for f in VERTICES.fields}
    found = properties(vertices, "identifier", "type")
    assert found[("1", "game")] == {"pts_home": 100.0, "pts_away": 90.0, "winning_team": 7}
    assert found[("2", "game")]["winning_team"] == 8
    assert found[("3", "game")] == {"pts_home": None, "pts_away": 1.0, "winning_team": 8}


def test_player_vertices(spark):
    def career(vertices):
        return {
            k[0]: (p["number_of_games"], p["total_points"], p["teams"])
            for k, p in properties(vertices, "identifier").items()
        }

    assert career(graph.player_vertices(details(spark))) == {
        "10": (4, 23.0, [100, 200]),
        "11": (1, 7.0, [100]),
        "12": (3, 0.0, [200]),
        "13": (1, 3.0, [100]),
    }
    assert career(graph.player_vertices(details(spark), dedup=True))["10"] == (3, 18.0, [100, 200])


def test_player_with_two_names(spark):
    rows = [(1, 1, "old", 5, "A", "G", 1.0), (2, 1, "young", 5, "A", "G", 2.0)]
    vertex = properties(graph.player_vertices(spark.createDataFrame(rows, DETAILS)), "identifier")
    assert vertex[("1",)] == {
        "player_name": "young", "number_of_games": 2, "total_points": 3.0, "teams": [5]
    }


def test_team_vertices(spark):
    teams = spark.createDataFrame(
        [(1, "AAA", "As", "Town", "Old Hall", 1950), (1, "AAA", "As", "Town", "New Hall", 1950)],
        "team_id int, abbreviation string, nickname string, city string, arena string, yearfounded int",
    )
    found = properties(graph.team_vertices(teams, ["arena"]), "identifier", "type")
    assert found == {
        ("1", "team"): {
            "abbreviation": "AAA", "nickname": "As", "city": "Town", "arena": "New Hall",
            "year_founded": 1950,
        }
    }


def test_plays_in_edges(spark):
    edges = graph.plays_in_edges(details(spark), order_by=ORDER)
    assert types(edges) == {f.name: f.dataType for f in EDGES.fields}
    found = properties(edges, "subject_identifier", "object_identifier")
    assert len(found) == 8 == edges.select(*EDGE_KEY).distinct().count()
    assert found[("13", "3")] == {
        "start_position": None, "pts": 3.0, "team_id": 100, "team_abbreviation": "AAA"
    }
    assert graph.plays_in_edges(details(spark), ["player_id"], ["game_id"]).count() == 4


def test_plays_on_edges(spark):
    found = properties(graph.plays_on_edges(details(spark)), "subject_identifier", "object_identifier")
    assert found[("10", "100")] == {"num_games": 2, "points": 14.0}
    assert found[("10", "200")] == {"num_games": 1, "points": 4.0}
    assert found[("12", "200")] == {"num_games": 3, "points": 0.0}


PAIRS = [
    ("11", "10", "shares_team", 1, 7.0, 5.0),
    ("12", "10", "plays_against", 2, 0.0, 14.0),
    ("12", "10", "shares_team", 1, 0.0, 4.0),
    ("12", "11", "plays_against", 1, 0.0, 7.0),
    ("13", "10", "plays_against", 1, 3.0, 4.0),
]


def pair_rows(edges):
    return sorted(
        (
            r.subject_identifier, r.object_identifier, r.edge_type,
            *(json.loads(r.properties)[k] for k in ("num_games", "subject_points", "object_points")),
        )
        for r in edges.collect()
    )


@pytest.mark.parametrize("block_rows", [5000, 2, 1])
def test_player_pair_edges(spark, block_rows):
    edges = graph.player_pair_edges(details(spark), ORDER, block_rows=block_rows)
    assert pair_rows(edges) == PAIRS
    with_namesake = graph.player_pair_edges(
        details(spark), ORDER, exclude_same_name=False, block_rows=block_rows
    )
    assert ("13", "12", "plays_against", 1, 3.0, 0.0) in pair_rows(with_namesake)


def test_missing_team_is_another_team(spark):
    rows = [(1, 1, "a", 5, None, "G", 1.0), (1, 2, "b", 5, None, "G", 2.0)]
    edges = graph.player_pair_edges(spark.createDataFrame(rows, DETAILS))
    assert pair_rows(edges) == [("2", "1", "plays_against", 1, 2.0, 1.0)]


def test_ids_are_compared_as_numbers(spark):
    rows = [(1, 9, "a", 5, "A", "G", 1.0), (1, 10, "b", 5, "A", "G", 2.0)]
    edges = graph.player_pair_edges(spark.createDataFrame(rows, DETAILS))
    assert pair_rows(edges) == [("10", "9", "shares_team", 1, 2.0, 1.0)]


def brute_pairs(rows):
    """Over plain Python rows: (game, player, name, team, points)."""
    met = {}
    for g1, p1, n1, t1, x1 in rows:
        for g2, p2, n2, t2, x2 in rows:
            if g1 == g2 and p1 > p2 and n1 != n2:
                key = (p1, p2, "shares_team" if t1 == t2 else "plays_against")
                n, a, b = met.get(key, (0, 0.0, 0.0))
                met[key] = (n + 1, a + x1, b + x2)
    return sorted((*k, *v) for k, v in met.items())


@pytest.mark.parametrize("block_rows", [5000, 30, 7, 1])
def test_pairs_with_one_game_of_a_third_of_the_rows(spark, block_rows):
    """Games in any number of cells give the same pairs."""
    import random

    rng = random.Random(3)
    rows = [(0, p, f"n{p}", rng.choice("AB"), float(p % 11)) for p in range(120)]
    for game in range(1, 30):
        for p in rng.sample(range(120), rng.randint(2, 14)):
            rows.append((game, p, f"n{p}", rng.choice("AB"), float(p % 7)))
    df = spark.createDataFrame(
        rows, "game_id int, player_id int, player_name string, team_abbreviation string, pts double"
    )
    pairs = graph.player_pairs(df, block_rows=block_rows)
    assert sorted(tuple(r) for r in pairs.collect()) == brute_pairs(rows)


def test_names_may_come_from_a_table_of_their_own(spark):
    d = details(spark)
    names = d.select("player_id", "player_name").distinct()
    bare = d.drop("player_name")
    assert pair_rows(graph.player_pair_edges(bare, ORDER, names=names)) == PAIRS
    for dedup in (False, True):
        one = graph.player_vertices(d, dedup, ORDER)
        assert rows_of(graph.player_vertices(bare, dedup, ORDER, names)) == rows_of(one)


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    rows = [(g, 1, "a", 5, "A", "G", x) for g, x in enumerate([1e8, 0.1, 0.2, -1e8, 0.3] * 40)]
    df = spark.createDataFrame(rows, DETAILS.replace("pts float", "pts double"))
    found = {graph.player_vertices(df.repartition(n, "game_id")).collect()[0].properties for n in (1, 3, 7)}
    assert len(found) == 1 and json.loads(found.pop())["total_points"] == 24.0


def test_points_beyond_the_integers_are_unknown(spark):
    vertices = spark.createDataFrame([("1", "player", '{"player_name":"a"}')], "identifier string, type string, properties string")
    edges = spark.createDataFrame([("1", "player", '{"pts":1e12}')], "subject_identifier string, subject_type string, properties string")
    assert graph.max_points(vertices, edges).collect()[0].max_points is None


def test_pairs_do_not_depend_on_the_order_of_rows(spark):
    rows = details(spark).unionByName(details(spark).withColumn("pts", F.col("pts") + 1))
    once = pair_rows(graph.player_pair_edges(rows, ORDER))
    again = pair_rows(graph.player_pair_edges(rows.orderBy(F.desc("pts")).repartition(5), ORDER))
    assert once == again


def test_max_points(spark):
    d = details(spark)
    vertices = graph.player_vertices(d)
    edges = graph.plays_in_edges(d, order_by=ORDER).unionByName(graph.player_pair_edges(d, ORDER))
    best = graph.max_points(vertices, edges)
    assert [tuple(r) for r in best.collect()] == [("P10", 9), ("P11", 7), ("P12", 3)]
    only_pairs = graph.max_points(vertices, graph.player_pair_edges(d, ORDER))
    assert {r.max_points for r in only_pairs.collect()} == {None}
    mixed = edges.filter("not (subject_identifier = '11' and edge_type = 'plays_in')")
    assert graph.max_points(vertices, mixed).collect()[0].max_points is None


def test_opponent_stats(spark):
    d = details(spark)
    stats = graph.opponent_stats(
        graph.player_vertices(d),
        graph.player_pair_edges(d, ORDER).unionByName(graph.plays_in_edges(d, order_by=ORDER)),
    )
    found = {
        (r.subject_identifier, r.object_identifier, r.edge_type): r for r in stats.collect()
    }
    assert len(found) == 5
    zero = found[("12", "10", "plays_against")]
    assert (zero.player_name, zero.games_per_point, zero.points_per_game) == ("P12", 3.0, 0.0)
    assert (zero.subject_points, zero.num_games) == ("0.0", "2")
    assert found[("11", "10", "shares_team")].games_per_point == pytest.approx(1 / 7)


def test_graph_integrity(spark):
    d = details(spark)
    vertices = graph.player_vertices(d)
    edges = graph.plays_on_edges(d)
    problems = graph.graph_integrity(vertices.unionByName(vertices.filter("identifier = '11'")), edges)
    assert rows_of(problems, "problem", "key", "n") == [
        ("duplicate vertex", "11|player", 2),
        ("missing vertex", "100|team", 3),
        ("missing vertex", "200|team", 2),
    ]
    twice = graph.graph_integrity(vertices, edges.unionByName(edges.filter("object_identifier = '200'")))
    assert ("duplicate edge", "10|player|200|team|plays_on", 2) in rows_of(twice, "problem", "key", "n")
