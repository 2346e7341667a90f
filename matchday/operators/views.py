"""Reshapes of the clean match table.

A match has two sides. Every "one row per side" view is built as a single
``inline(array(struct(side 1), struct(side 2)))`` Generate over one scan,
instead of a UNION ALL of two projections (which would scan the input twice).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import final_results
from ..sources.tables import row_bound, with_row_bound
from .sampling import half_sample_flag

# --- fixed values: team-view classes -------------------------------------------
TEAM_VIEW_CLASSES = ("overall", "home", "away")
# -----------------------------------------------------------------------------


def _i(v: int) -> Column:
    return F.lit(v).cast("int")


def _side(team: int, active: bool) -> str:
    """One side of a match, seen from that team, as a SQL struct expression.

    Written as one ``named_struct`` text so it is parsed once on the JVM.
    """
    me, other = (1, 2) if team == 1 else (2, 1)
    win, loss = (1, -1) if team == 1 else (-1, 1)
    fields = [
        f"'team_id', team_id_{me}",
        f"'team_name', team_name_{me}",
        f"'home_team', CAST({1 if team == 1 else 0} AS INT)",
    ]
    if active:
        diff = "goals_diff" if team == 1 else "-goals_diff"
        fields += [
            "'games', CAST(1 AS INT)",
            f"'wins', CAST(CASE WHEN result_class = {win} THEN 1 ELSE 0 END AS INT)",
            "'draws', CAST(CASE WHEN result_class = 0 THEN 1 ELSE 0 END AS INT)",
            f"'losses', CAST(CASE WHEN result_class = {loss} THEN 1 ELSE 0 END AS INT)",
            f"'goals_scored', CAST(goals_team_{me} AS BIGINT)",
            f"'goals_conceded', CAST(goals_team_{other} AS BIGINT)",
            f"'goals_diff', CAST({diff} AS BIGINT)",
            f"'points', CAST(points_team_{me} AS INT)",
        ]
    else:
        # the side that does not count still yields a row, with every KPI 0
        fields += [
            "'games', CAST(0 AS INT)",
            "'wins', CAST(0 AS INT)",
            "'draws', CAST(0 AS INT)",
            "'losses', CAST(0 AS INT)",
            "'goals_scored', CAST(0 AS BIGINT)",
            "'goals_conceded', CAST(0 AS BIGINT)",
            "'goals_diff', CAST(0 AS BIGINT)",
            "'points', CAST(0 AS INT)",
        ]
    return f"named_struct({', '.join(fields)})"


def _check_view_args(team: int | None, standings_class: str) -> None:
    if team is not None and team not in (1, 2):
        raise ValueError("team must be in [1, 2]")
    if standings_class not in TEAM_VIEW_CLASSES:
        raise ValueError(f"standings_class must be in {list(TEAM_VIEW_CLASSES)}")


def _active(team: int, standings_class: str) -> bool:
    return standings_class == "overall" or (standings_class == "home") == (team == 1)


_VIEW_KEYS = ("match_id", "league_id", "league_name", "season_name", "match_day")


def team_side_view(matches: DataFrame, team: int, standings_class: str = "overall") -> DataFrame:
    """One side's rows (16 columns). Prefer :func:`team_view`, which does both in one pass."""
    _check_view_args(team, standings_class)
    return matches.selectExpr(*_VIEW_KEYS, f"inline(array({_side(team, _active(team, standings_class))}))")


def team_view(matches: DataFrame, standings_class: str = "overall", carry: Sequence[str] = ()) -> DataFrame:
    """Two rows per match, one per team, with that team's games/wins/.../points.

    ``overall`` counts both sides; ``home`` / ``away`` count only that side and
    give the other side a row of zeros. ``carry``: further columns of ``matches``.
    """
    _check_view_args(None, standings_class)
    s1, s2 = _side(1, _active(1, standings_class)), _side(2, _active(2, standings_class))
    return matches.selectExpr(*_VIEW_KEYS, *carry, f"inline(array({s1}, {s2}))")


def load_match_results(matches: DataFrame, **filter_args) -> DataFrame:
    """Final scores of regular games (the filter every derived table starts from); a known bound on the rows stays known."""
    out, bound = matches.filter(final_results(**filter_args)), row_bound(matches)
    return out if bound is None else with_row_bound(out, bound)


def goals_base_view(matches: DataFrame) -> DataFrame:
    """Two rows per match with the goals of ``team_id_1`` as target: as is, and sides swapped."""

    def side(home: bool) -> str:
        a, b = (1, 2) if home else (2, 1)
        return (
            f"named_struct('team_id_1', team_id_{a}, 'team_name_1', team_name_{a}, "
            f"'team_id_2', team_id_{b}, 'team_name_2', team_name_{b}, "
            f"'home_team', CAST({1 if home else 0} AS INT), 'goals', CAST(goals_team_{a} AS BIGINT))"
        )

    return matches.selectExpr("match_id", "league_id", "match_day", f"inline(array({side(True)}, {side(False)}))")


def result_class_columns(mirrored: Column) -> list[Column]:
    """The columns of the result-class view from those of a match; mirrored where the flag says so."""

    def pick(a: str, b: str) -> Column:
        return F.when(mirrored, F.col(b)).otherwise(F.col(a)).alias(a)

    def negated(name: str) -> Column:
        return F.when(mirrored, -F.col(name)).otherwise(F.col(name)).alias(name)

    sides = [("team_id_1", "team_id_2"), ("team_name_1", "team_name_2")]
    swapped = [x for a, b in sides for x in (pick(a, b), pick(b, a))]
    # order of the view: both columns of team 1, then both of team 2
    return [
        *[F.col(c) for c in ("match_id", "league_id", "match_day")], swapped[0], swapped[2], swapped[1], swapped[3],
        pick("goals_team_1", "goals_team_2"), pick("goals_team_2", "goals_team_1"), negated("goals_diff"), negated("result_class"),
        F.when(mirrored, _i(0)).otherwise(_i(1)).alias("home_team"),
    ]


def result_class_base_view(
    matches: DataFrame, seed: str = "", mirrored: Column | None = None
) -> DataFrame:
    """One row per match; an exact half of the matches (hash-ranked, seeded) is mirrored.

    Mirrored rows swap teams and goals, negate ``goals_diff`` and ``result_class``
    and get ``home_team = 0``. One projection of ``when(mirrored, ...)`` pairs,
    no union and no join: the sample is a predicate on the row's hash key.
    """
    return matches.select(*result_class_columns(mirrored if mirrored is not None else half_sample_flag(matches, "match_id", seed=seed)))
