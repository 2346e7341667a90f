"""Row filters shared by the pipeline stages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
# League ids with incomplete data, dropped by the clean stage.
EXCLUDED_LEAGUE_IDS: tuple[int, ...] = (50, 4570)
# Result label of the final score; the match-day label token of play-off games.
FINAL_RESULT_NAME = "Endergebnis"
RELEGATION_TOKEN = "relegation"
# -----------------------------------------------------------------------------


def not_excluded_league(
    excluded: Iterable[int] = EXCLUDED_LEAGUE_IDS, column: str = "leagueId"
) -> Column:
    """True for rows outside the excluded leagues; a null id is dropped as well."""
    return ~F.col(column).isin(list(excluded))


def final_results(
    final_name: str = FINAL_RESULT_NAME, exclude_token: str = RELEGATION_TOKEN
) -> Column:
    """Final scores of regular games with a known result.

    ``result_name == final_name``, the match-day name does not contain the
    play-off token (case-insensitive) and the result class is known. The first
    conjunct is a plain equality and reaches the Parquet scan as a pushed filter.
    """
    return (
        (F.col("result_name") == F.lit(final_name))
        & ~F.lower(F.col("match_day_name")).contains(exclude_token.lower())
        & F.col("result_class").isNotNull()
    )
