"""Named feature expressions of the clean match table (a registry of Column factories).

Every factory takes the separator used for the nested feed names (``"."`` keeps
``team1.teamId``; ``"_"`` gives ``team1_teamId``) and returns one aliased
``Column``. All of them are plain Catalyst expressions, so a projection built
from the registry stays inside whole-stage codegen.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(path: str, sep: str) -> Column:
    """Column for a feed path like ``team1.teamId`` under the given separator."""
    return F.col(f"`{path.replace('.', sep)}`")


def goals_team_1(sep: str = ".") -> Column:
    return F.coalesce(F.col("pointsTeam1"), F.lit(0).cast("bigint")).alias("goals_team_1")


def goals_team_2(sep: str = ".") -> Column:
    return F.coalesce(F.col("pointsTeam2"), F.lit(0).cast("bigint")).alias("goals_team_2")


def goals_diff(sep: str = ".") -> Column:
    # null when either side is null, then 0
    return F.coalesce(F.col("pointsTeam1") - F.col("pointsTeam2"), F.lit(0).cast("bigint")).alias(
        "goals_diff"
    )


def league_id(sep: str = ".") -> Column:
    return F.col("leagueId").alias("league_id")


def league_name(sep: str = ".") -> Column:
    return F.col("league_name_unique").alias("league_name")


# --- fixed values: the feed's league name ends in " YYYY/YYYY" -----------------
SEASON_SUFFIX_LEN = 10  # characters dropped for the raw league name
SEASON_NAME_LEN = 9  # characters kept for the season name
# -----------------------------------------------------------------------------


def league_name_raw(sep: str = ".") -> Column:
    # all but the last 10 characters; "" when the name is shorter
    name = F.col("leagueName")
    keep = F.greatest(F.length(name) - F.lit(SEASON_SUFFIX_LEN), F.lit(0))
    return F.substring(name, F.lit(1), keep).alias("league_name_raw")


def match_day(sep: str = ".") -> Column:
    return _c("group.groupOrderID", sep).alias("match_day")


def match_day_name(sep: str = ".") -> Column:
    return _c("group.groupName", sep).alias("match_day_name")


def match_id(sep: str = ".") -> Column:
    return F.col("matchID").alias("match_id")


def _three_way(hi: int, eq: int, lo: int) -> Column:
    p1, p2 = F.col("pointsTeam1"), F.col("pointsTeam2")
    # no otherwise(): a null score gives null
    return F.when(p1 > p2, F.lit(hi)).when(p1 == p2, F.lit(eq)).when(p1 < p2, F.lit(lo))


def points_team_1(sep: str = ".") -> Column:
    return _three_way(3, 1, 0).alias("points_team_1")


def points_team_2(sep: str = ".") -> Column:
    return _three_way(0, 1, 3).alias("points_team_2")


def result_class(sep: str = ".") -> Column:
    return _three_way(1, 0, -1).alias("result_class")


def result_name(sep: str = ".") -> Column:
    return F.col("resultName").alias("result_name")


def season_name(sep: str = ".") -> Column:
    # last 9 characters; the whole name when shorter
    return F.right(F.col("leagueName"), F.lit(SEASON_NAME_LEN)).alias("season_name")


def team_id_1(sep: str = ".") -> Column:
    return F.col("team_id_unique_1").alias("team_id_1")


def team_id_2(sep: str = ".") -> Column:
    return F.col("team_id_unique_2").alias("team_id_2")


def team_name_1(sep: str = ".") -> Column:
    return _c("team1.teamName", sep).alias("team_name_1")


def team_name_2(sep: str = ".") -> Column:
    return _c("team2.teamName", sep).alias("team_name_2")


FEATURES: dict[str, Callable[[str], Column]] = {
    "goals_team_1": goals_team_1,
    "goals_team_2": goals_team_2,
    "goals_diff": goals_diff,
    "league_id": league_id,
    "league_name": league_name,
    "league_name_raw": league_name_raw,
    "match_day": match_day,
    "match_day_name": match_day_name,
    "match_id": match_id,
    "points_team_1": points_team_1,
    "points_team_2": points_team_2,
    "result_class": result_class,
    "result_name": result_name,
    "season_name": season_name,
    "team_id_1": team_id_1,
    "team_id_2": team_id_2,
    "team_name_1": team_name_1,
    "team_name_2": team_name_2,
}

# --- fixed values: columns of the clean match table, in order ----------------
DEFAULT_FEATURES: tuple[str, ...] = (
    "match_id",
    "league_id",
    "league_name",
    "season_name",
    "match_day",
    "match_day_name",
    "team_id_1",
    "team_id_2",
    "team_name_1",
    "team_name_2",
    "goals_team_1",
    "goals_team_2",
    "goals_diff",
    "result_class",
    "result_name",
    "points_team_1",
    "points_team_2",
)
# -----------------------------------------------------------------------------


def register_feature(name: str, factory: Callable[[str], Column]) -> None:
    """Add a user feature to the registry (the extension point of ``clean``)."""
    FEATURES[name] = factory


def build_features(features: Iterable[str], sep: str = ".") -> list[Column]:
    """Columns for the named features; unknown names are reported and skipped."""
    out = []
    for name in features:
        factory = FEATURES.get(name)
        if factory is None:
            warnings.warn(f"There is no feature named {name!r}; it is skipped.", stacklevel=2)
            continue
        out.append(factory(sep))
    return out


def suffix_alias(cols: str | list[str] | tuple[str, ...], suffix: str) -> Column | list[Column]:
    """``col -> col + suffix`` for one name or a list of names."""
    if isinstance(cols, str):
        return F.col(cols).alias(f"{cols}{suffix}")
    if isinstance(cols, (list, tuple)):
        return [F.col(c).alias(f"{c}{suffix}") for c in cols]
    raise ValueError("cols need to be either a str or list[str].")
