"""Model features: a base view per target plus table rows of the previous match day."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lookups import previous_day_features, previous_day_rows
from ..operators.panels import panel_classes, panel_stats, table_rank
from ..operators.skew import DEFAULT_HOT_ROWS, find_hot, task_slots
from ..operators.sampling import half_sample_flag
from ..operators.views import goals_base_view, load_match_results, result_class_base_view, result_class_columns, team_view
from ..schemas import PANEL_METRICS, PERFORMANCE_METRICS, performance_columns
from ..sources.buckets import scan_table
from ..sources.sinks import write_table
from ..sources.tables import distinct_values, row_bound
from .tables import team_tables

# --- fixed values: columns taken from standings, and of the goals base view ----
STANDINGS_FEATURES = ("games", "rank")
GOALS_BASE_COLUMNS = (
    "match_id", "league_id", "match_day", "team_id_1", "team_name_1", "team_id_2", "team_name_2", "home_team", "goals",
)
TARGETS = ("goals", "result_class")
# -----------------------------------------------------------------------------
#: Columns of a match that the goals view needs, and those that identify a panel row.
_GOALS_MATCH_COLUMNS = (
    "match_id", "league_id", "match_day", "team_id_1", "team_name_1", "team_id_2", "team_name_2", "goals_team_1", "goals_team_2",
)
_PANEL_KEYS = ("match_id", "league_id", "match_day", "team_id", "home_team")
#: Panel rows of a task of :meth:`FeatureBuilder.match_features`, about: its sorts hold 4 kB a row in all.
PANEL_TASK_ROWS = 50_000


def _each_table(rows: Column, tables: Sequence[Sequence[str]]) -> Column:
    """Rows of a team's previous day as a join with each of the tables gives them: all combinations, one from each table."""

    def of(x: Column, cols: Sequence[str]) -> list[Column]:
        return [x[c].alias(c) for c in cols]

    def with_next(out: Column, seen: Sequence[str], cols: Sequence[str]) -> Column:
        return F.flatten(F.transform(out, lambda a: F.transform(rows, lambda x: F.struct(*of(a, seen), *of(x, cols)))))

    out, seen = F.transform(rows, lambda x: F.struct(*of(x, tables[0]))), list(tables[0])
    for cols in tables[1:]:
        out, seen = with_next(out, seen, cols), [*seen, *cols]
    return out


class FeatureBuilder:
    """Builds the feature table for one target.

    ``features`` maps a step name to its input table (a DataFrame or a Parquet
    path); each step ``name`` is the method ``add_<name>``. Steps run in the
    given order; unknown names are reported and skipped. Extend by subclassing
    and adding ``add_<name>(base, table) -> DataFrame`` methods.

    ``get_features(matches, features, target, output_path)`` also accepts the
    positional order ``(matches, output_path, features, target)``.
    """

    def __init__(self, spark: SparkSession | None = None, seed: str = ""):
        self.spark = spark or SparkSession.getActiveSession()
        self.seed = seed

    def _table(self, t: DataFrame | str) -> DataFrame:
        return t if isinstance(t, DataFrame) else scan_table(self.spark, t)

    # --- base views ---------------------------------------------------------
    def load_match_results(self, matches: DataFrame | str) -> DataFrame:
        return load_match_results(self._table(matches))

    def goals_base_view(self, match_results: DataFrame) -> DataFrame:
        return goals_base_view(match_results)

    def result_class_base_view(self, match_results: DataFrame) -> DataFrame:
        return result_class_base_view(match_results, seed=self.seed)

    # --- feature steps ------------------------------------------------------
    # Steps that attach previous-match-day rows of a team table: name -> columns taken.
    PREVIOUS_DAY_STEPS: dict[str, tuple[str, ...]] = {
        "overall_standings": STANDINGS_FEATURES,
        "overall_performance": tuple(performance_columns()),
    }

    def _overridden(self, name: str) -> bool:
        """Has a subclass replaced the built-in ``add_<name>`` step."""
        return getattr(type(self), f"add_{name}", None) is not getattr(FeatureBuilder, f"add_{name}", None)

    def _finish_step(self, name: str, df: DataFrame) -> DataFrame:
        """Columns derived after a step's joins."""
        if name == "overall_standings":
            return df.withColumn("rank_diff", F.col("rank_1") - F.col("rank_2"))
        return df

    def _add_previous_day_steps(self, base: DataFrame, steps: list[tuple[str, DataFrame | str]]) -> DataFrame:
        """Join a run of previous-day steps together (team 1 for all, then team 2)."""
        tables = [(self._table(t), self.PREVIOUS_DAY_STEPS[n]) for n, t in steps]
        out = previous_day_features(base, tables)
        for name, _ in steps:
            out = self._finish_step(name, out)
        # reference order: per step its side-1 and side-2 columns, then derived columns
        ordered = list(base.columns)
        for name, _ in steps:
            cols = self.PREVIOUS_DAY_STEPS[name]
            ordered += [f"{c}_1" for c in cols] + [f"{c}_2" for c in cols]
            if name == "overall_standings":
                ordered.append("rank_diff")
        return out.select(*ordered)

    def add_overall_standings(self, base: DataFrame, standings: DataFrame | str) -> DataFrame:
        """Games and rank of both teams after the previous match day, and the rank difference."""
        return self._add_previous_day_steps(base, [("overall_standings", standings)])

    def add_overall_performance(self, base: DataFrame, performance: DataFrame | str) -> DataFrame:
        """The 21 form statistics of both teams after the previous match day."""
        return self._add_previous_day_steps(base, [("overall_performance", performance)])

    def _goals_features_by_match(self, matches: DataFrame, steps: list[tuple[str, DataFrame | str]]) -> DataFrame:
        """Goals base view with previous-day steps, joined once per match instead of once per row.

        Both rows of a match need the same two lookups (home and away team), only
        swapped: the joins run on the N match rows, then one Generate emits the two
        oriented rows. Duplicate lookup keys fan out to the same rows as joining
        each oriented row.
        """
        m = matches.select(*_GOALS_MATCH_COLUMNS)
        tables = [(self._table(t), self.PREVIOUS_DAY_STEPS[n]) for n, t in steps]
        joined = previous_day_features(m, tables)

        names = [n for n, _ in steps]
        return self._finished(self._oriented(joined, names), GOALS_BASE_COLUMNS, names)

    def _oriented(self, joined: DataFrame, steps: Sequence[str]) -> DataFrame:
        """The two rows of each match, as is and with sides swapped, from match rows with both teams' lookups."""

        def orient(home: bool) -> str:
            # one SQL struct expression (parsed once on the JVM) instead of ~100 Column calls
            a, b = (1, 2) if home else (2, 1)
            fields = [
                f"'team_id_1', team_id_{a}",
                f"'team_name_1', team_name_{a}",
                f"'team_id_2', team_id_{b}",
                f"'team_name_2', team_name_{b}",
                f"'home_team', CAST({1 if home else 0} AS INT)",
                f"'goals', CAST(goals_team_{a} AS BIGINT)",
            ]
            for name in steps:
                cols = self.PREVIOUS_DAY_STEPS[name]
                fields += [f"'{c}_1', `{c}_{a}`" for c in cols]
                fields += [f"'{c}_2', `{c}_{b}`" for c in cols]
            return f"named_struct({', '.join(fields)})"

        return joined.selectExpr("match_id", "league_id", "match_day", f"inline(array({orient(True)}, {orient(False)}))")

    # --- features from the matches alone ---------------------------------------
    def match_features(
        self, matches: DataFrame | str, steps: Sequence[str] = tuple(PREVIOUS_DAY_STEPS), target: str = "goals",
        hot_threshold: int | None = DEFAULT_HOT_ROWS,
    ) -> DataFrame:
        """The features of :meth:`get_features` with the "overall" tables of the same matches, without joins.

        All windows (panel statistics, table rank, previous day) and the regrouping of a match's two sides run on one
        partitioning by league: one Exchange of the team view in all, and no table in between. Its tasks grow in number with
        the rows, not in size. A league season is a few hundred rows, so that takes leagues enough for all tasks. Where there are too few, or a league has more than
        ``hot_threshold`` rows, the team tables are written and joined as usual.
        """
        if target not in TARGETS:
            raise NotImplementedError(f"target must be one of {list(TARGETS)}")
        if unknown := [s for s in steps if s not in self.PREVIOUS_DAY_STEPS]:
            raise ValueError(f"{unknown} are not in {list(self.PREVIOUS_DAY_STEPS)}")
        table = self._table(matches)
        if not steps or self._overridden_view(f"{target}_base_view") or not self._leagues_suffice(table, hot_threshold):
            tables = dict(zip(self.PREVIOUS_DAY_STEPS, team_tables(table, hot_threshold))) if steps else {}
            return self.get_features(table, {s: tables[s] for s in steps}, target)
        finals = self.load_match_results(table)
        if target == "result_class":
            own = result_class_columns(half_sample_flag(finals, "match_id", seed=self.seed))
        else:
            own = [F.col(c) for c in _GOALS_MATCH_COLUMNS]
        # one stage sorts the panel rows several times over: as many tasks as the rows need, which AQE does not merge
        rows = row_bound(table)
        rows = 2 * (finals.count() if rows is None else rows)
        width = max(task_slots(table.sparkSession), math.ceil(rows / PANEL_TASK_ROWS))
        view = team_view(finals.withColumn("_match", F.struct(*own)), "overall", carry=["_match"]).repartition(width, "league_id")
        columns = [c for s in steps for c in self.PREVIOUS_DAY_STEPS[s]]
        panel = panel_stats(
            view, panel_classes("overall"), [*_PANEL_KEYS, "_match"], PANEL_METRICS, PERFORMANCE_METRICS, hot_threshold=None)
        if "rank" in columns:
            panel = table_rank(panel, hot_threshold=None)
        panel = previous_day_rows(panel, columns)
        # a mirrored match has its away team first
        first = F.col("home_team") == (F.col("_match.home_team") if target == "result_class" else F.lit(1))
        both = panel.groupBy("league_id", "_match").agg(
            F.count_if(first).alias("copies"),
            *[F.first(F.when(side, F.col("previous")), ignorenulls=True).alias(p) for p, side in (("p1", first), ("p2", ~first))])
        none = F.array(F.lit(None).cast(panel.schema["previous"].dataType.elementType))
        some = [_each_table(F.when(F.size(p) > 0, F.col(p)).otherwise(none), [self.PREVIOUS_DAY_STEPS[s] for s in steps]) for p in ("p1", "p2")]
        pairs = F.flatten(F.transform(some[0], lambda a: F.transform(some[1], lambda b: F.struct(a.alias("a"), b.alias("b")))))
        # alike match rows are one group: as many rows as there were
        rows = both.select("_match", F.inline(F.flatten(F.array_repeat(pairs, F.col("copies").cast("int")))))
        wide = rows.select(
            "_match.*", *[F.col(f"{p}.{c}").alias(f"{c}_{side}") for side, p in ((1, "a"), (2, "b")) for c in columns])
        if target == "goals":
            return self._finished(self._oriented(wide, steps), GOALS_BASE_COLUMNS, steps)
        return self._finished(wide, wide.columns[: len(own)], steps)

    def _leagues_suffice(self, matches: DataFrame, hot_threshold: int | None) -> bool:
        """Are there at least two leagues for each task slot, and none of them hot."""
        finals = load_match_results(matches)
        leagues = distinct_values(matches, "league_id")
        if leagues is None:
            leagues = finals.agg(F.approx_count_distinct("league_id")).first()[0]
        if leagues < 2 * task_slots(matches.sparkSession):
            return False
        return hot_threshold is None or find_hot(finals, [["league_id"]], max(hot_threshold // 2, 1)) == [None]

    def _finished(self, df: DataFrame, own: Sequence[str], steps: Sequence[str]) -> DataFrame:
        """Derived columns, and the order of the joined form."""
        ordered = list(own)
        for name in steps:
            df = self._finish_step(name, df)
            cols = self.PREVIOUS_DAY_STEPS[name]
            ordered += [f"{c}_1" for c in cols] + [f"{c}_2" for c in cols]
            if name == "overall_standings":
                ordered.append("rank_diff")
        return df.select(*ordered)

    # --- entry point --------------------------------------------------------
    def get_features(
        self,
        match_results: DataFrame | str,
        features: Mapping[str, DataFrame | str],
        target: str = "goals",
        output_path: str | None = None,
    ) -> DataFrame:
        if isinstance(features, str) and isinstance(target, Mapping):
            # positional order (match results, result path, features, target): the path is
            # where the feature table is written
            features, target, output_path = target, (output_path or "goals"), features
        if target not in TARGETS:
            raise NotImplementedError(f"target must be one of {list(TARGETS)}")
        matches = self.load_match_results(match_results)
        steps = list(features.items())
        lead = 0
        while lead < len(steps) and steps[lead][0] in self.PREVIOUS_DAY_STEPS and not self._overridden(steps[lead][0]):
            lead += 1
        if target == "goals" and lead and not self._overridden_view("goals_base_view"):
            base = self._goals_features_by_match(matches, steps[:lead])
            steps = steps[lead:]
        elif target == "goals":
            base = self.goals_base_view(matches)
        else:
            base = self.result_class_base_view(matches)
        i = 0
        while i < len(steps):
            name = steps[i][0]
            if name in self.PREVIOUS_DAY_STEPS and not self._overridden(name):
                # consecutive previous-day steps share their joins
                j = i
                while j < len(steps) and steps[j][0] in self.PREVIOUS_DAY_STEPS and not self._overridden(steps[j][0]):
                    j += 1
                base = self._add_previous_day_steps(base, steps[i:j])
                i = j
                continue
            step = getattr(self, f"add_{name}", None)
            if step is None:
                warnings.warn(f"There is no feature step named {name!r}; it is skipped.", stacklevel=2)
            else:
                base = step(base, steps[i][1])
            i += 1
        if output_path:
            write_table(base, output_path)
            return base.sparkSession.read.parquet(output_path)
        return base

    def _overridden_view(self, name: str) -> bool:
        return getattr(type(self), name, None) is not getattr(FeatureBuilder, name, None)
