"""League tables and form statistics (standings, performance)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.panels import (
    PERFORMANCE_KEYS,
    RANK_OVER,
    STANDINGS_KEYS,
    panel_classes,
    panel_stats,
    performance_stats,
    running_totals,
    table_rank,
)
from ..operators.skew import DEFAULT_HOT_ROWS, SEGMENT_ROWS, find_hot, surely_cold, task_slots, value_sizes
from ..operators.views import load_match_results, team_view
from ..schemas import PANEL_METRICS, PERFORMANCE_METRICS, performance_columns
from ..session import materialize
from ..sources.buckets import write_bucketed
from ..sources.sinks import write_table
from ..sources.tables import row_bound, with_row_bound


#: Team rows of a task that sorts them for both windows of the standings, about: they take 0.5 kB a row in all.
TASK_ROWS = 250_000


def bounded_view(matches: DataFrame, standings_class: str = "overall", carry: Sequence[str] = ()) -> DataFrame:
    """The team view of the final results; a known bound on the match rows bounds its rows too."""
    matches = load_match_results(matches)
    view, bound = team_view(matches, standings_class, carry), row_bound(matches)
    return view if bound is None else with_row_bound(view, 2 * bound)


def standings(
    matches: DataFrame,
    standings_class: str = "overall",
    hot_threshold: int | None = DEFAULT_HOT_ROWS,
    segment_rows: int = SEGMENT_ROWS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """League table of every team after each of its games, with the table rank of that match day.

    final-result filter -> team view (one Generate) -> running totals per
    (league, team) -> rank per (league, match day): one shuffle per window
    partitioning. Panels and match days with more than ``hot_threshold`` rows
    are split (see :mod:`~matchday.operators.skew`): both are counted in one
    narrow pass, or known not to exist from a bound on the rows of ``matches``
    or of each league. A large table with leagues enough for all tasks, none of
    them with more rows, takes one shuffle by league for both windows.
    ``None`` plans the plain windows without looking. ``carry``: further columns of ``matches`` to keep.
    """
    view = bounded_view(matches, standings_class, carry)
    panels = days = None
    if not surely_cold(view, hot_threshold):
        leagues, slots = value_sizes(view, "league_id"), task_slots(view.sparkSession)
        panels, days = find_hot(view, [panel_classes("overall"), RANK_OVER], hot_threshold, largest=leagues.largest)
        if leagues.largest <= hot_threshold and leagues.values >= 2 * slots:
            # one stage sorts the rows twice: as many tasks as they need, which AQE does not merge
            view = view.repartition(max(slots, math.ceil(leagues.rows / TASK_ROWS)), "league_id")
    totals = running_totals(view, carry=[*STANDINGS_KEYS, *carry], hot_threshold=None, hot=panels, segment_rows=segment_rows)
    if days is not None:
        totals = materialize(totals, "running-totals")
    return table_rank(totals, hot_threshold=None, hot=days, segment_rows=segment_rows)


def performance(
    matches: DataFrame,
    performance_class: str = "overall",
    hot_threshold: int | None = DEFAULT_HOT_ROWS,
    segment_rows: int = SEGMENT_ROWS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Form of every team per game: rolling sums over 3 and 5 games and running averages.

    All 21 statistics share one window partitioning and order. ``carry``: further columns of ``matches`` to keep.
    """
    return performance_stats(
        bounded_view(matches, carry=carry), performance_class, carry=[*PERFORMANCE_KEYS, *carry], hot_threshold=hot_threshold,
        segment_rows=segment_rows,
    )


def team_tables(matches: DataFrame, hot_threshold: int | None = DEFAULT_HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(standings, performance) of class "overall", from one window over the panels.

    The statistics are written once below ``spark.checkpoint.dir``; the ranks and both tables read them there.
    """
    view = bounded_view(matches)
    carry = list(dict.fromkeys([*STANDINGS_KEYS, *PERFORMANCE_KEYS]))
    stats = materialize(
        panel_stats(view, panel_classes("overall"), carry, PANEL_METRICS, PERFORMANCE_METRICS, hot_threshold=hot_threshold),
        "team-stats",
    )
    (days,) = find_hot(stats, [RANK_OVER], hot_threshold)
    table = table_rank(stats.select(*STANDINGS_KEYS, *PANEL_METRICS), hot_threshold=None, hot=days)
    return table, stats.select(*PERFORMANCE_KEYS, *performance_columns())


#: The key by which feature joins look team tables up; tables are bucketed by it on request.
LOOKUP_KEY = ("league_id", "team_id", "match_day")


def _matches_at(spark: SparkSession, path: str) -> DataFrame:
    """A match table with its number of rows (from the files' footers) as bound."""
    matches = spark.read.parquet(path)
    return with_row_bound(matches, matches.count())


def _write(table: DataFrame, path: str, buckets: int | None) -> None:
    if buckets is None:
        write_table(table, path)
    else:
        write_bucketed(table, path, LOOKUP_KEY, buckets)


def create_standings(
    spark: SparkSession, match_results_path: str, standings_path: str, standings_class: str = "overall", buckets: int | None = None
) -> None:
    """Path-level wrapper: clean match table in, standings Parquet out.

    ``buckets``: write that many buckets by (league, team, match day), so that the feature builder joins the table without
    shuffling it; about the shuffle width of the builder's session.
    """
    _write(standings(_matches_at(spark, match_results_path), standings_class), standings_path, buckets)


def create_performance(
    spark: SparkSession, match_results_path: str, performance_path: str, performance_class: str = "overall",
    buckets: int | None = None,
) -> None:
    """Path-level wrapper: clean match table in, performance Parquet out; ``buckets`` as in :func:`create_standings`."""
    _write(performance(_matches_at(spark, match_results_path), performance_class), performance_path, buckets)
