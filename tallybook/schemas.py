"""Declared types, enum domains and the description of a cumulative table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tallybook.functions import as_list

# The enum members and the score bands that the results depend on.
SCORING_CLASSES = ("star", "good", "average", "bad")
VERTEX_TYPES = ("player", "team", "game")
EDGE_TYPES = ("plays_against", "shares_team", "plays_in", "plays_on")
SCORE_BANDS = (("star", 20), ("good", 15), ("average", 10))
LOWEST_CLASS = "bad"
ENUM_LIMIT = 50

PLAYER_ATTRIBUTES = ("height", "college", "country", "draft_year", "draft_round", "draft_number")

SEASON_STATS = T.StructType(
    [
        T.StructField("season", T.IntegerType()),
        T.StructField("gp", T.IntegerType()),
        T.StructField("pts", T.FloatType()),
        T.StructField("reb", T.FloatType()),
        T.StructField("ast", T.FloatType()),
    ]
)

PLAYER_SEASONS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("player_name", *PLAYER_ATTRIBUTES)]
    + list(SEASON_STATS.fields)
)

PLAYERS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("player_name", *PLAYER_ATTRIBUTES)]
    + [
        T.StructField("season_stats", T.ArrayType(SEASON_STATS)),
        T.StructField("scoring_class", T.StringType()),
        T.StructField("year_since_last_season", T.IntegerType()),
        T.StructField("current_season", T.IntegerType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)

PLAYERS_SCD = T.StructType(
    [
        T.StructField("player_name", T.StringType()),
        T.StructField("scoring_class", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("start_season", T.IntegerType()),
        T.StructField("end_season", T.IntegerType()),
        T.StructField("current_season", T.IntegerType()),
    ]
)

VERTICES = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("identifier", "type", "properties")]
)

EDGE_KEY = (
    "subject_identifier",
    "subject_type",
    "object_identifier",
    "object_type",
    "edge_type",
)

EDGES = T.StructType([T.StructField(c, T.StringType()) for c in (*EDGE_KEY, "properties")])


@dataclass(frozen=True)
class HistorySpec:
    """Names and score bands of a cumulative table and of the facts that feed it.

    ``key`` is one column or several. Facts hold one row per (``key``, ``period``) with the
    ``attrs`` and ``stats`` columns; ``stats`` starts with the period, so that histories sort by
    it. Snapshots hold one row per (``key``, ``snapshot``).
    """

    key: str | tuple[str, ...] = "player_name"
    attrs: tuple[str, ...] = PLAYER_ATTRIBUTES
    period: str = "season"
    stats: tuple[str, ...] = ("season", "gp", "pts", "reb", "ast")
    score: str = "pts"
    bands: tuple[tuple[str, float], ...] = SCORE_BANDS
    lowest: str = LOWEST_CLASS
    history: str = "season_stats"
    label: str = "scoring_class"
    gap: str = "year_since_last_season"
    snapshot: str = "current_season"
    active: str = "is_active"

    def __post_init__(self) -> None:
        if self.stats[:1] != (self.period,) or self.score not in self.stats:
            raise ValueError("stats must start with the period and hold the score column")

    @property
    def keys(self) -> list[str]:
        return as_list(self.key)


PLAYER_HISTORY = HistorySpec()
