"""Declared schemas of every stage (no inference anywhere).

The feed schema mirrors the match objects of the public football data API the
pipeline consumes: a few scalar fields, three nested objects (``group``,
``team1``, ``team2``) and two record lists (``matchResults``, ``goals``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: feed field names and record kinds -------------------------
# The 25 match-level ("meta") columns, in feed order, as dotted paths.
META_COLUMNS: tuple[str, ...] = (
    "matchID",
    "matchDateTime",
    "timeZoneID",
    "leagueId",
    "leagueName",
    "leagueSeason",
    "leagueShortcut",
    "matchDateTimeUTC",
    "group.groupName",
    "group.groupOrderID",
    "group.groupID",
    "team1.teamId",
    "team1.teamName",
    "team1.shortName",
    "team1.teamIconUrl",
    "team1.teamGroupName",
    "team2.teamId",
    "team2.teamName",
    "team2.shortName",
    "team2.teamIconUrl",
    "team2.teamGroupName",
    "lastUpdateDateTime",
    "matchIsFinished",
    "location",
    "numberOfViewers",
)

# Fields of one element of each record list, in output order.
RECORD_FIELDS: dict[str, tuple[tuple[str, T.DataType], ...]] = {
    "matchResults": (
        ("resultID", T.LongType()),
        ("resultName", T.StringType()),
        ("pointsTeam1", T.LongType()),
        ("pointsTeam2", T.LongType()),
        ("resultOrderID", T.LongType()),
        ("resultTypeID", T.LongType()),
        ("resultDescription", T.StringType()),
    ),
    "goals": (
        ("goalID", T.LongType()),
        ("scoreTeam1", T.LongType()),
        ("scoreTeam2", T.LongType()),
        ("matchMinute", T.LongType()),
        ("goalGetterID", T.LongType()),
        ("goalGetterName", T.StringType()),
        ("isPenalty", T.BooleanType()),
        ("isOwnFoal", T.BooleanType()),
        ("isOvertime", T.BooleanType()),
        ("comment", T.StringType()),
    ),
}
RECORD_KINDS: tuple[str, ...] = tuple(RECORD_FIELDS)

# Goal objects spell the own-goal flag two ways; both are read and merged.
GOAL_FLAG_ALIASES: dict[str, tuple[str, ...]] = {"isOwnFoal": ("isOwnFoal", "isOwnGoal")}
# -----------------------------------------------------------------------------


def _team() -> T.StructType:
    return T.StructType(
        [
            T.StructField("teamId", T.LongType()),
            T.StructField("teamName", T.StringType()),
            T.StructField("shortName", T.StringType()),
            T.StructField("teamIconUrl", T.StringType()),
            T.StructField("teamGroupName", T.StringType()),
        ]
    )


def _record_struct(kind: str) -> T.StructType:
    fields = [T.StructField(n, t) for n, t in RECORD_FIELDS[kind]]
    for name, spellings in GOAL_FLAG_ALIASES.items():
        if kind == "goals":
            fields += [T.StructField(s, T.BooleanType()) for s in spellings if s != name]
    return T.StructType(fields)


FEED_SCHEMA = T.StructType(
    [
        T.StructField("matchID", T.LongType()),
        T.StructField("matchDateTime", T.StringType()),
        T.StructField("timeZoneID", T.StringType()),
        T.StructField("leagueId", T.LongType()),
        T.StructField("leagueName", T.StringType()),
        T.StructField("leagueSeason", T.LongType()),
        T.StructField("leagueShortcut", T.StringType()),
        T.StructField("matchDateTimeUTC", T.StringType()),
        T.StructField(
            "group",
            T.StructType(
                [
                    T.StructField("groupName", T.StringType()),
                    T.StructField("groupOrderID", T.LongType()),
                    T.StructField("groupID", T.LongType()),
                ]
            ),
        ),
        T.StructField("team1", _team()),
        T.StructField("team2", _team()),
        T.StructField("lastUpdateDateTime", T.StringType()),
        # boolean in the feed; normalisation casts it to bigint
        T.StructField("matchIsFinished", T.BooleanType()),
        T.StructField("location", T.StringType()),
        T.StructField("numberOfViewers", T.LongType()),
        T.StructField("matchResults", T.ArrayType(_record_struct("matchResults"))),
        T.StructField("goals", T.ArrayType(_record_struct("goals"))),
    ]
)

# Types of the flat (normalised) meta columns.
META_TYPES: dict[str, T.DataType] = {}
for _f in FEED_SCHEMA.fields:
    if isinstance(_f.dataType, T.StructType) and _f.name in ("group", "team1", "team2"):
        for _s in _f.dataType.fields:
            META_TYPES[f"{_f.name}.{_s.name}"] = _s.dataType
    elif not isinstance(_f.dataType, T.ArrayType):
        META_TYPES[_f.name] = _f.dataType
META_TYPES["matchIsFinished"] = T.LongType()


def meta_name(path: str, separator: str = ".") -> str:
    """Output name of a nested meta path for a given separator."""
    return path.replace(".", separator)


def normalized_schema(records: str, meta=META_COLUMNS, separator: str = ".") -> T.StructType:
    """Schema of a normalised record table (meta columns + record fields)."""
    fields = [T.StructField(meta_name(m, separator), META_TYPES[m]) for m in meta]
    fields += [T.StructField(n, t) for n, t in RECORD_FIELDS[records]]
    return T.StructType(fields)


LEAGUE_MAPPER_SCHEMA = T.StructType(
    [
        T.StructField("league_name_raw", T.StringType()),
        T.StructField("league_name_unique", T.StringType()),
    ]
)

TEAM_MAPPER_SCHEMA = T.StructType(
    [
        T.StructField("team_name", T.StringType()),
        T.StructField("team_id_raw", T.LongType()),
        T.StructField("team_id_unique", T.LongType()),
    ]
)

# --- fixed values: table metrics, in output order -----------------------------
# Metrics summed along a team's panel (standings).
PANEL_METRICS: tuple[str, ...] = (
    "games",
    "wins",
    "draws",
    "losses",
    "goals_scored",
    "goals_conceded",
    "goals_diff",
    "points",
)
# Metrics with rolling and average statistics (performance), in output order.
PERFORMANCE_METRICS: tuple[str, ...] = (
    "wins",
    "draws",
    "losses",
    "points",
    "goals_scored",
    "goals_conceded",
    "goals_diff",
)
# -----------------------------------------------------------------------------


def performance_columns() -> list[str]:
    cols = []
    for m in PERFORMANCE_METRICS:
        cols += [f"{m}_last_3_games", f"{m}_last_5_games", f"{m}_avg"]
    return cols
