"""Window statistics over team panels (one row per team and game, ordered by match day).

Every statistic of one table shares one window specification, so Catalyst
plans a single Exchange + Sort + Window for all of them (frames may differ
inside one Window operator). Order is (match_day, match_id, home_team): the
match day alone leaves ties undefined; the id parts matches, and the side parts
the two rows that a match between two unmapped teams has in the null panel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..schemas import PANEL_METRICS, PERFORMANCE_METRICS
from ..session import materialize
from .skew import CARRIED, DEFAULT_HOT_ROWS, RUN, SEGMENT_ROWS, Hot, find_hot, in_segments, same_key, split_hot

# --- fixed values: performance classes and their panel keys; rank order --------
PERFORMANCE_CLASSES: dict[str, tuple[str, ...]] = {
    "overall": ("league_id", "team_id"),
    "home_away": ("league_id", "team_id", "home_team"),
}
PANEL_ORDER: tuple[str, ...] = ("match_day", "match_id", "home_team")
RANK_BY: tuple[str, ...] = ("points", "goals_diff", "goals_scored")
RANK_OVER: tuple[str, ...] = ("league_id", "match_day")
# -----------------------------------------------------------------------------
STANDINGS_KEYS: tuple[str, ...] = (
    "league_id",
    "league_name",
    "season_name",
    "match_day",
    "team_id",
    "team_name",
)
PERFORMANCE_KEYS: tuple[str, ...] = (
    "match_id",
    "league_id",
    "match_day",
    "team_id",
    "team_name",
    "home_team",
)


def panel_classes(performance_class: str) -> tuple[str, ...]:
    if performance_class not in PERFORMANCE_CLASSES:
        raise ValueError(f"performance_class must be in {list(PERFORMANCE_CLASSES)}")
    return PERFORMANCE_CLASSES[performance_class]


def panel_window(keys: Sequence[str], order: Sequence[str] = PANEL_ORDER) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_sum(col: str, w: WindowSpec) -> Column:
    """Sum of this and all earlier rows of the panel (BIGINT)."""
    return F.sum(F.col(col)).over(running(w)).cast("bigint")


def rolling_sum(col: str, w: WindowSpec, n: int) -> Column:
    """Sum of this and the n-1 previous rows; null until n non-null values are in the frame."""
    frame = w.rowsBetween(-(n - 1), Window.currentRow)
    return F.when(F.count(F.col(col)).over(frame) >= n, F.sum(F.col(col)).over(frame)).cast("bigint")


def running_avg(col: str, w: WindowSpec, games: str = "games") -> Column:
    """Running total of ``col`` divided by the running number of games (double; null on 0)."""
    return F.try_divide(
        F.sum(F.col(col)).over(running(w)).cast("double"), F.sum(F.col(games)).over(running(w)).cast("double")
    )


def _statistics(
    w: WindowSpec, totals: Sequence[str], forms: Sequence[str], windows: Sequence[int], games: str, run: str = ""
) -> list[Column]:
    """All statistics of one window; running sums read the columns behind the prefix ``run``."""
    cols = [running_sum(f"{run}{m}", w).alias(m) for m in totals]
    for m in forms:
        cols += [rolling_sum(m, w, n).alias(f"{m}_last_{n}_games") for n in windows]
        cols.append(running_avg(f"{run}{m}", w, f"{run}{games}").alias(f"{m}_avg"))
    return cols


def panel_stats(
    view: DataFrame,
    keys: Sequence[str],
    carry: Sequence[str],
    totals: Sequence[str] = (),
    forms: Sequence[str] = (),
    windows: Sequence[int] = (3, 5),
    order: Sequence[str] = PANEL_ORDER,
    hot_threshold: int | None = DEFAULT_HOT_ROWS,
    games: str = "games",
    hot: Hot | None = None,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """``carry``, the running totals (named as the metric) and the form statistics of one panel, from one window.

    ``view`` has the key, order, ``carry`` and metric columns; the default order needs ``match_day``, ``match_id`` and
    ``home_team``. Any of them may be null (nulls sort first) and of any sortable type: ids may be sparse hashes or text.

    Panels with more than ``hot_threshold`` rows take the segments of :mod:`~matchday.operators.skew` instead of one window
    task; ``None`` skips the check, ``hot`` gives the hot keys where the caller has found them.
    """
    if hot is None:
        (hot,) = find_hot(view, [keys], hot_threshold)
    cold, rows = (view, None) if hot is None else split_hot(view, keys, hot)
    w = panel_window(keys, order)
    out = cold.select(*carry, *_statistics(w, totals, forms, windows, games))
    if rows is None:
        return out
    needed = list(dict.fromkeys([*totals, *forms, *([games] if forms else [])]))
    back = max(windows, default=1) - 1 if forms else 0
    seg, w = in_segments(rows, keys, [F.col(c).asc_nulls_first() for c in order], needed, back, hot.rows, segment_rows)
    stats = seg.select(*carry, CARRIED, *_statistics(w, totals, forms, windows, games, RUN))
    return out.unionByName(stats.filter(~F.col(CARRIED)).drop(CARRIED))


def running_totals(
    view: DataFrame,
    keys: Sequence[str] = ("league_id", "team_id"),
    metrics: Sequence[str] = PANEL_METRICS,
    carry: Sequence[str] = STANDINGS_KEYS,
    order: Sequence[str] = PANEL_ORDER,
    hot_threshold: int | None = DEFAULT_HOT_ROWS,
    hot: Hot | None = None,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Running totals of each metric per panel (the league table after each game)."""
    return panel_stats(
        view, keys, carry, totals=metrics, order=order, hot_threshold=hot_threshold, hot=hot, segment_rows=segment_rows
    )


def table_rank(
    totals: DataFrame,
    by: Sequence[str] = RANK_BY,
    over: Sequence[str] = RANK_OVER,
    name: str = "rank",
    hot_threshold: int | None = DEFAULT_HOT_ROWS,
    hot: Hot | None = None,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Rank (method "min", i.e. SQL RANK) of the descending tuple ``by`` within ``over``.

    For hot groups the rank is 1 + the number of rows with a greater tuple:
    rows are pre-aggregated to one count per distinct tuple (partial
    aggregate), summed over segments of these counts, and joined back.
    """
    if hot is None:
        (hot,) = find_hot(totals, [over], hot_threshold)
    w = Window.partitionBy(*over).orderBy(*[F.col(c).desc() for c in by])
    cold, rows = (totals, None) if hot is None else split_hot(totals, over, hot)
    out = cold.withColumn(name, F.rank().over(w).cast("bigint"))
    if rows is None:
        return out
    counts = rows.groupBy(*over, *by).agg(F.count(F.lit(1)).alias("_n"))
    counts = materialize(counts, "hot-tuples")
    seg, sw = in_segments(counts, over, [F.col(c).desc() for c in by], ["_n"], segment_rows=segment_rows)
    upto = F.sum(f"{RUN}_n").over(running(sw))
    ranks = seg.select(
        CARRIED, *[F.col(c).alias(f"_k_{c}") for c in (*over, *by)], (upto - F.col("_n") + F.lit(1)).cast("bigint").alias(name)
    ).filter(~F.col(CARRIED))
    ranked = rows.join(ranks, same_key([*over, *by], "_k_"), "inner").select(*totals.columns, name)
    return out.unionByName(ranked)


def performance_stats(
    view: DataFrame,
    performance_class: str = "overall",
    metrics: Sequence[str] = PERFORMANCE_METRICS,
    windows: Sequence[int] = (3, 5),
    carry: Sequence[str] = PERFORMANCE_KEYS,
    order: Sequence[str] = PANEL_ORDER,
    hot_threshold: int | None = DEFAULT_HOT_ROWS,
    games: str = "games",
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Rolling sums over the last 3 and 5 games and running averages per panel."""
    return panel_stats(
        view, panel_classes(performance_class), carry, forms=metrics, windows=windows, order=order, hot_threshold=hot_threshold,
        games=games, segment_rows=segment_rows,
    )
