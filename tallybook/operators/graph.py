"""A property graph of players, teams and games, and the queries on it.

Identifiers become text only after ids have been compared as what they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions import json_properties, ordered_sum, prop, props
from tallybook.operators.facts import first_per
from tallybook.schemas import EDGE_KEY

# Games are paired in blocks of at most about this many players.
BLOCK_ROWS = 1_000


def _vertices(df: DataFrame, identifier: str, kind: str, fields: dict[str, Column]) -> DataFrame:
    return df.select(
        F.col(identifier).cast("string").alias("identifier"),
        F.lit(kind).alias("type"),
        json_properties(fields).alias("properties"),
    )


def _edges(
    df: DataFrame,
    subject: str,
    object_: str,
    object_type: str,
    edge_type: Column,
    fields: dict[str, Column],
) -> DataFrame:
    return df.select(
        F.col(subject).cast("string").alias("subject_identifier"),
        F.lit("player").alias("subject_type"),
        F.col(object_).cast("string").alias("object_identifier"),
        F.lit(object_type).alias("object_type"),
        edge_type.alias("edge_type"),
        json_properties(fields).alias("properties"),
    )


def game_vertices(games: DataFrame) -> DataFrame:
    """The home team won if the flag is 1; otherwise, also without a flag, the visitor."""
    home_won = F.col("home_team_wins") == 1
    winner = F.when(home_won, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    fields = {"pts_home": F.col("pts_home"), "pts_away": F.col("pts_away"), "winning_team": winner}
    return _vertices(games, "game_id", "game", fields)


def player_vertices(
    details: DataFrame,
    dedup: bool = False,
    order_by: Sequence[str] = (),
    names: DataFrame | None = None,
) -> DataFrame:
    """Per player: greatest name, rows, points, and the sorted list of teams.

    Rows are counted as they are, copies included, unless ``dedup``. They are reduced to one
    row per (player, name, team) first, so a list is made from distinct teams only. Where
    ``names`` (player_id, player_name) holds the names, they join the reduced players; players
    without one are left out.
    """
    named = ["player_name"] if names is None else []
    needed = dict.fromkeys(["player_id", "game_id", *named, "team_id", "pts", *order_by])
    rows = details.select(*needed)
    if dedup:
        rows = first_per(rows, ["game_id", "player_id"], order_by)
    by_team = rows.groupBy("player_id", *named, "team_id").agg(
        F.count(F.lit(1)).alias("games"), ordered_sum(rows, "pts").alias("points")
    )
    players = by_team.groupBy("player_id").agg(
        *[F.max(c).alias(c) for c in named],
        F.sum("games").alias("number_of_games"),
        ordered_sum(by_team, "points").alias("total_points"),
        F.array_sort(F.collect_set("team_id")).alias("teams"),
    )
    if names is not None:
        greatest = names.groupBy("player_id").agg(F.max("player_name").alias("player_name"))
        players = players.join(greatest, "player_id")
    fields = ("player_name", "number_of_games", "total_points", "teams")
    return _vertices(players, "player_id", "player", {c: F.col(c) for c in fields})


def team_vertices(teams: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """One vertex per team, from its first row by ``order_by`` and then all other columns."""
    one = first_per(teams, ["team_id"], order_by)
    fields = {c: F.col(c) for c in ("abbreviation", "nickname", "city", "arena")}
    return _vertices(one, "team_id", "team", fields | {"year_founded": F.col("yearfounded")})


def plays_in_edges(
    details: DataFrame,
    keys: Sequence[str] = ("game_id", "player_id"),
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Player to game, one edge per ``keys``; ``keys=['player_id']`` keeps a single game."""
    fields = ("start_position", "pts", "team_id", "team_abbreviation")
    needed = dict.fromkeys(["player_id", "game_id", *keys, *fields, *order_by])
    rows = first_per(details.select(*needed), list(keys), order_by)
    properties = {c: F.col(c) for c in fields}
    return _edges(rows, "player_id", "game_id", "game", F.lit("plays_in"), properties)


def plays_on_edges(details: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Player to team, with the games and points of the player's rows for that team."""
    needed = dict.fromkeys(["player_id", "game_id", "team_id", "pts", *order_by])
    rows = first_per(details.select(*needed), ["game_id", "player_id"], order_by)
    played = rows.groupBy("player_id", "team_id").agg(
        F.count(F.lit(1)).alias("num_games"), ordered_sum(rows, "pts").alias("points")
    )
    properties = {c: F.col(c) for c in ("num_games", "points")}
    return _edges(played, "player_id", "team_id", "team", F.lit("plays_on"), properties)


def _in_cells(rows: DataFrame, block_rows: int) -> DataFrame:
    """Cut each game into blocks of players, with one cell per two blocks.

    A row goes to the cells of its own block, once per block of its game; an ordinary game is
    one block and one cell. Cell (i, i) pairs a block with itself, cell (i, j) two blocks. The
    players are counted map-side. The counts are partitioned by the game as a struct, so that
    the join shuffles them once more: adaptive execution splits a hot game only between two
    plain shuffles.
    """
    counts = rows.groupBy(F.struct("game_id").alias("_game")).agg(F.count(F.lit(1)).alias("_players"))
    sizes = counts.select("_game.game_id", F.ceil(F.col("_players") / block_rows).alias("_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1))
    return (
        rows.join(sizes, "game_id")
        .withColumn("_block", F.pmod(F.xxhash64("player_id"), F.col("_blocks")))
        .withColumn("_other", other)
        .withColumn("_low", F.least("_block", "_other"))
        .withColumn("_high", F.greatest("_block", "_other"))
        .drop("_blocks", "_other")
    )


def player_pairs(
    details: DataFrame,
    order_by: Sequence[str] = (),
    exclude_same_name: bool = True,
    block_rows: int = BLOCK_ROWS,
    names: DataFrame | None = None,
) -> DataFrame:
    """Games and points of every two players who met, by whether they shared a team.

    The result has a row per two players, so pairing within a game is the operator itself;
    what is bounded is the work of one task. Copies are dropped map-side, the players of each
    game are counted, and games are paired in cells of two blocks each, spread over the
    cluster; every pair falls into exactly one cell. Pairs are summed map-side before they are
    shuffled, and never kept as lists. ``block_rows`` tunes the cells and never the result.
    Where ``names`` (player_id, player_name, one row per player) holds the names, they join the
    rows after copies are dropped.
    """
    needed = ["game_id", "player_id", "team_abbreviation", "pts"]
    own = needed if names is not None or not exclude_same_name else [*needed, "player_name"]
    rows = details.select(*dict.fromkeys([*own, *order_by]))
    rows = first_per(rows, ["game_id", "player_id"], order_by).select(*own)
    rows = rows.filter(F.col("game_id").isNotNull())
    if names is not None and exclude_same_name:
        rows = rows.join(names.select("player_id", "player_name"), "player_id")
    rows = _in_cells(rows, block_rows)

    # The two sides are one DataFrame under two names, so its exchange is made once.
    def a(c):
        return F.col(f"a.{c}")

    def b(c):
        return F.col(f"b.{c}")

    met = a("player_id") > b("player_id")
    if exclude_same_name:
        met &= a("player_name") != b("player_name")
    met &= (a("_block") != b("_block")) | (a("_low") == a("_high"))
    for c in ("game_id", "_low", "_high"):
        met &= a(c) == b(c)
    shared = F.coalesce(a("team_abbreviation") == b("team_abbreviation"), F.lit(False))
    pairs = (
        rows.alias("a")
        .join(rows.alias("b"), met)
        .groupBy(
            a("player_id").alias("subject_id"),
            b("player_id").alias("object_id"),
            shared.alias("_shared"),
        )
        .agg(
            F.count(F.lit(1)).alias("num_games"),
            ordered_sum(rows, "pts", "a.pts").alias("subject_points"),
            ordered_sum(rows, "pts", "b.pts").alias("object_points"),
        )
    )
    kind = F.when(F.col("_shared"), "shares_team").otherwise("plays_against")
    return pairs.select(
        "subject_id",
        "object_id",
        kind.alias("edge_type"),
        "num_games",
        "subject_points",
        "object_points",
    )


def player_pair_edges(
    details: DataFrame,
    order_by: Sequence[str] = (),
    exclude_same_name: bool = True,
    block_rows: int = BLOCK_ROWS,
    names: DataFrame | None = None,
) -> DataFrame:
    """``player_pairs`` as edges from the player with the greater id to the other."""
    pairs = player_pairs(details, order_by, exclude_same_name, block_rows, names)
    properties = {c: F.col(c) for c in ("num_games", "subject_points", "object_points")}
    return _edges(pairs, "subject_id", "object_id", "player", F.col("edge_type"), properties)


def max_points(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Most points on one edge per player name, highest first and unknown ones on top.

    Edges are reduced to one row per subject before they meet the vertices, so a player with
    very many edges is one row in the join. Fractions of points are cut off; points beyond the
    integers count as unknown.
    """
    points = prop("properties", "pts").try_cast("double").try_cast("int")
    best = edges.groupBy("subject_identifier", "subject_type").agg(F.max(points).alias("_best"))
    at = (F.col("subject_identifier") == F.col("identifier")) & (
        F.col("subject_type") == F.col("type")
    )
    named = vertices.select("identifier", "type", prop("properties", "player_name").alias("player_name"))
    return (
        best.join(named, at)
        .groupBy("player_name")
        .agg(F.max("_best").alias("max_points"))
        .orderBy(F.col("max_points").desc_nulls_first())
    )


def opponent_stats(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Every player-to-player edge with its subject's name and career ratio.

    The ratio is games over points, 0 points counting as 1; its reciprocal is given as well,
    as points over games. The vertex side has one row per key, so a busy subject fills the
    edge side only, which Spark can split.
    """
    games = F.col("number_of_games").cast("double")
    points = F.col("total_points").cast("double")
    subjects = vertices.select(
        F.col("identifier").alias("subject_identifier"),
        F.col("type").alias("subject_type"),
        props("properties", "player_name", "number_of_games", "total_points"),
    ).select(
        "subject_identifier",
        "subject_type",
        "player_name",
        (games / F.when(points == 0, F.lit(1.0)).otherwise(points)).alias("games_per_point"),
        (points / F.nullif(games, F.lit(0.0))).alias("points_per_game"),
    )
    met = edges.filter(F.col("object_type") == "player").select(
        "subject_identifier",
        "subject_type",
        "object_identifier",
        "edge_type",
        props("properties", "subject_points", "num_games"),
    )
    return met.join(subjects, ["subject_identifier", "subject_type"]).drop("subject_type")


def graph_integrity(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Keys held by several vertices or edges, and edge ends without a vertex.

    Vertices and edge ends are tagged and reduced together, to one row per (identifier, type)
    with the number of each: several vertices are duplicates, ends without a vertex miss one.
    An end without identifier or type matches no vertex.
    """
    key = ("identifier", "type")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    ends = F.array(
        *[F.struct(*[F.col(f"{end}_{c}").alias(c) for c in key]) for end in ("subject", "object")]
    )
    tagged = vertices.select(*key, one.alias("_vertices"), none.alias("_ends")).unionByName(
        edges.select(F.inline(ends)).select(*key, none.alias("_vertices"), one.alias("_ends"))
    )
    counts = tagged.groupBy(*key).agg(
        F.sum("_vertices").alias("_vertices"), F.sum("_ends").alias("_ends")
    )
    known = (F.col("_vertices") > 0) & F.col("identifier").isNotNull() & F.col("type").isNotNull()

    def told(problem: str, n: str) -> Column:
        return F.struct(F.lit(problem).alias("problem"), F.concat_ws("|", *key).alias("key"), F.col(n).alias("n"))

    found = F.array(
        F.when(F.col("_vertices") > 1, told("duplicate vertex", "_vertices")),
        F.when((F.col("_ends") > 0) & ~known, told("missing vertex", "_ends")),
    )
    edge_counts = edges.groupBy(*EDGE_KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return counts.select(F.inline(F.array_compact(found))).unionByName(
        edge_counts.select(F.lit("duplicate edge").alias("problem"), F.concat_ws("|", *EDGE_KEY).alias("key"), "n")
    )
