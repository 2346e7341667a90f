"""DuckDB oracle SQL for the registered queries, written from the operators' semantics.

Only the *input* derivation (the feed from ``orders`` / ``lineitem``) is shared
text with the Spark side; every operator is re-stated here independently: the
outer explode as a UNION ALL with a no-record branch, team views as UNION ALL,
running and rolling statistics as SQL windows, previous-day features as plain
LEFT JOINs on ``match_day + 1``, the half sample as a global ROW_NUMBER.
"""

from __future__ import annotations

from ..functions.features import DEFAULT_FEATURES
from ..schemas import META_COLUMNS, PERFORMANCE_METRICS, meta_name
from ..sources.mappers import LEAGUE_MAPPER_CSV, TEAM_MAPPER_CSV
from ..sources.testdata import (
    DEVIANCE_COLUMNS,
    FINAL_RESULT,
    GOAL_COLUMNS,
    HALF_TIME_RESULT,
    matches_sql,
    PREDICTION_COLUMNS,
)
from .queries import ABSENT_SEASONS, FEATURE_SUBSET, META_SUBSET, METRIC_DIGITS, REQUEST_LEAGUES, REQUEST_SEASONS

META = [meta_name(m, "_") for m in META_COLUMNS]


def _q(name: str) -> str:
    return f'"{name}"'


def _meta_select(prefix: str = "") -> str:
    cols = []
    for m in META:
        if m == "matchIsFinished":
            cols.append(f"CAST({prefix}matchIsFinished AS BIGINT) AS matchIsFinished")
        else:
            cols.append(f"{prefix}{_q(m)}")
    return ", ".join(cols)


def _matches_sql() -> str:
    return matches_sql("orders")


def _lm_sql() -> str:
    rows = [line.split(",") for line in LEAGUE_MAPPER_CSV.strip().splitlines()[1:]]
    values = ", ".join(f"('{a}', '{b}')" for a, b in rows)
    return f"SELECT * FROM (VALUES {values}) t(league_name_raw, league_name_unique)"


TM_SQL = (
    "SELECT CAST(100 + i AS BIGINT) AS team_id_raw, CAST(i + 1 AS BIGINT) AS team_id_unique FROM range(18) r(i) "
    "UNION ALL SELECT CAST(200 + i AS BIGINT), CAST(i + 1 AS BIGINT) FROM range(4) r(i)"
)


def _result_branch(spec: dict | None, halve: bool, offset: int) -> str:
    if spec is None:
        rec = (
            "CAST(NULL AS BIGINT) AS resultID, CAST(NULL AS VARCHAR) AS resultName, "
            "CAST(NULL AS BIGINT) AS pointsTeam1, CAST(NULL AS BIGINT) AS pointsTeam2, "
            "CAST(NULL AS BIGINT) AS resultOrderID, CAST(NULL AS BIGINT) AS resultTypeID, "
            "CAST(NULL AS VARCHAR) AS resultDescription"
        )
        return f"SELECT {_meta_select()}, {rec} FROM m WHERE NOT has_result"
    pts = (lambda c: f"CAST(FLOOR({c} / 2.0) AS BIGINT)") if halve else (lambda c: f"CAST({c} AS BIGINT)")
    rec = (
        f"CAST(matchID * 2 + {offset} AS BIGINT) AS resultID, '{spec['name']}' AS resultName, "
        f"{pts('p1')} AS pointsTeam1, {pts('p2')} AS pointsTeam2, "
        f"CAST({spec['order']} AS BIGINT) AS resultOrderID, CAST({spec['order']} AS BIGINT) AS resultTypeID, "
        f"'{spec['desc']}' AS resultDescription"
    )
    return f"SELECT {_meta_select()}, {rec} FROM m WHERE has_result"


RES_SQL = " UNION ALL ".join(
    [_result_branch(FINAL_RESULT, False, 2), _result_branch(HALF_TIME_RESULT, True, 1), _result_branch(None, False, 0)]
)

_CLEAN_EXPR = {
    "match_id": "r.matchID",
    "league_id": "r.leagueId",
    "league_name": "lm.league_name_unique",
    "league_name_raw": "substr(r.leagueName, 1, greatest(length(r.leagueName) - 10, 0))",
    "season_name": "right(r.leagueName, 9)",
    "match_day": "r.group_groupOrderID",
    "match_day_name": "r.group_groupName",
    "team_id_1": "t1.team_id_unique",
    "team_id_2": "t2.team_id_unique",
    "team_name_1": "r.team1_teamName",
    "team_name_2": "r.team2_teamName",
    "goals_team_1": "COALESCE(r.pointsTeam1, 0)",
    "goals_team_2": "COALESCE(r.pointsTeam2, 0)",
    "goals_diff": "COALESCE(r.pointsTeam1 - r.pointsTeam2, 0)",
    "result_class": "CAST(CASE WHEN r.pointsTeam1 > r.pointsTeam2 THEN 1 WHEN r.pointsTeam1 = r.pointsTeam2 THEN 0 "
    "WHEN r.pointsTeam1 < r.pointsTeam2 THEN -1 END AS INTEGER)",
    "result_name": "r.resultName",
    "points_team_1": "CAST(CASE WHEN r.pointsTeam1 > r.pointsTeam2 THEN 3 WHEN r.pointsTeam1 = r.pointsTeam2 THEN 1 "
    "WHEN r.pointsTeam1 < r.pointsTeam2 THEN 0 END AS INTEGER)",
    "points_team_2": "CAST(CASE WHEN r.pointsTeam1 > r.pointsTeam2 THEN 0 WHEN r.pointsTeam1 = r.pointsTeam2 THEN 1 "
    "WHEN r.pointsTeam1 < r.pointsTeam2 THEN 3 END AS INTEGER)",
}

CONFORMED_FROM = (
    "res r LEFT JOIN lm ON substr(r.leagueName, 1, greatest(length(r.leagueName) - 10, 0)) = lm.league_name_raw "
    "LEFT JOIN tm t1 ON r.team1_teamId = t1.team_id_raw "
    "LEFT JOIN tm t2 ON r.team2_teamId = t2.team_id_raw "
    "WHERE r.leagueId NOT IN (50, 4570)"
)


def _clean_sql(features=DEFAULT_FEATURES) -> str:
    cols = ", ".join(f"{_CLEAN_EXPR[f]} AS {f}" for f in features if f in _CLEAN_EXPR)
    return f"SELECT {cols} FROM {CONFORMED_FROM}"


FINAL_SQL = (
    "SELECT * FROM cm WHERE result_name = 'Endergebnis' "
    "AND NOT (lower(match_day_name) LIKE '%relegation%') AND result_class IS NOT NULL"
)


def _side_sql(team: int, active: bool) -> str:
    me, other = (1, 2) if team == 1 else (2, 1)
    win, loss = (1, -1) if team == 1 else (-1, 1)
    head = (
        f"SELECT match_id, league_id, league_name, season_name, match_day, team_id_{me} AS team_id, "
        f"team_name_{me} AS team_name, CAST({1 if team == 1 else 0} AS INTEGER) AS home_team"
    )
    if active:
        diff = "goals_diff" if team == 1 else "-1 * goals_diff"
        kpis = (
            "CAST(1 AS INTEGER) AS games, "
            f"CAST(CASE WHEN result_class = {win} THEN 1 ELSE 0 END AS INTEGER) AS wins, "
            "CAST(CASE WHEN result_class = 0 THEN 1 ELSE 0 END AS INTEGER) AS draws, "
            f"CAST(CASE WHEN result_class = {loss} THEN 1 ELSE 0 END AS INTEGER) AS losses, "
            f"CAST(goals_team_{me} AS BIGINT) AS goals_scored, CAST(goals_team_{other} AS BIGINT) AS goals_conceded, "
            f"CAST({diff} AS BIGINT) AS goals_diff, CAST(points_team_{me} AS INTEGER) AS points"
        )
    else:
        kpis = (
            "CAST(0 AS INTEGER) AS games, CAST(0 AS INTEGER) AS wins, CAST(0 AS INTEGER) AS draws, "
            "CAST(0 AS INTEGER) AS losses, CAST(0 AS BIGINT) AS goals_scored, CAST(0 AS BIGINT) AS goals_conceded, "
            "CAST(0 AS BIGINT) AS goals_diff, CAST(0 AS INTEGER) AS points"
        )
    return f"{head}, {kpis} FROM fr"


def _team_view_sql(cls: str) -> str:
    a1 = cls in ("overall", "home")
    a2 = cls in ("overall", "away")
    return f"{_side_sql(1, a1)} UNION ALL {_side_sql(2, a2)}"


PANEL = "ORDER BY match_day, match_id, home_team"
RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
TOTALS = ("games", "wins", "draws", "losses", "goals_scored", "goals_conceded", "goals_diff", "points")


def _standings_sql(view: str = "tv") -> str:
    sums = ", ".join(
        f"CAST(SUM({m}) OVER (PARTITION BY league_id, team_id {PANEL} {RUN}) AS BIGINT) AS {m}" for m in TOTALS
    )
    return (
        "SELECT *, CAST(RANK() OVER (PARTITION BY league_id, match_day "
        "ORDER BY points DESC, goals_diff DESC, goals_scored DESC) AS BIGINT) AS rank FROM ("
        f"SELECT league_id, league_name, season_name, match_day, team_id, team_name, {sums} FROM {view}) st0"
    )


def _performance_sql(keys: str = "league_id, team_id", view: str = "tvo") -> str:
    cols = []
    for m in PERFORMANCE_METRICS:
        for n in (3, 5):
            frame = f"(PARTITION BY {keys} {PANEL} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
            cols.append(
                f"CAST(CASE WHEN COUNT({m}) OVER {frame} >= {n} THEN SUM({m}) OVER {frame} END AS BIGINT) "
                f"AS {m}_last_{n}_games"
            )
        run = f"(PARTITION BY {keys} {PANEL} {RUN})"
        cols.append(
            f"CAST(SUM({m}) OVER {run} AS DOUBLE) / NULLIF(CAST(SUM(games) OVER {run} AS DOUBLE), 0) AS {m}_avg"
        )
    return (
        "SELECT match_id, league_id, match_day, team_id, team_name, home_team, "
        f"{', '.join(cols)} FROM {view}"
    )


def _perf_cols() -> list[str]:
    out = []
    for m in PERFORMANCE_METRICS:
        out += [f"{m}_last_3_games", f"{m}_last_5_games", f"{m}_avg"]
    return out


GOALS_BASE_SQL = (
    "SELECT match_id, league_id, match_day, team_id_1, team_name_1, team_id_2, team_name_2, "
    "CAST(1 AS INTEGER) AS home_team, CAST(goals_team_1 AS BIGINT) AS goals FROM fr "
    "UNION ALL SELECT match_id, league_id, match_day, team_id_2 AS team_id_1, team_name_2 AS team_name_1, "
    "team_id_1 AS team_id_2, team_name_1 AS team_name_2, CAST(0 AS INTEGER) AS home_team, "
    "CAST(goals_team_2 AS BIGINT) AS goals FROM fr"
)

SAMPLED_SQL = (
    "SELECT DISTINCT match_id FROM (SELECT match_id, "
    "ROW_NUMBER() OVER (ORDER BY md5(CAST(match_id AS VARCHAR)), match_id) AS rn, COUNT(*) OVER () AS n FROM fr) x "
    "WHERE rn <= CAST(FLOOR(n / 2.0) AS BIGINT)"
)

RESULT_CLASS_BASE_SQL = (
    "SELECT f.match_id, f.league_id, f.match_day, "
    "CASE WHEN s.match_id IS NULL THEN f.team_id_1 ELSE f.team_id_2 END AS team_id_1, "
    "CASE WHEN s.match_id IS NULL THEN f.team_name_1 ELSE f.team_name_2 END AS team_name_1, "
    "CASE WHEN s.match_id IS NULL THEN f.team_id_2 ELSE f.team_id_1 END AS team_id_2, "
    "CASE WHEN s.match_id IS NULL THEN f.team_name_2 ELSE f.team_name_1 END AS team_name_2, "
    "CASE WHEN s.match_id IS NULL THEN f.goals_team_1 ELSE f.goals_team_2 END AS goals_team_1, "
    "CASE WHEN s.match_id IS NULL THEN f.goals_team_2 ELSE f.goals_team_1 END AS goals_team_2, "
    "CASE WHEN s.match_id IS NULL THEN f.goals_diff ELSE -1 * f.goals_diff END AS goals_diff, "
    "CASE WHEN s.match_id IS NULL THEN f.result_class ELSE -1 * f.result_class END AS result_class, "
    "CAST(CASE WHEN s.match_id IS NULL THEN 1 ELSE 0 END AS INTEGER) AS home_team "
    "FROM fr f LEFT JOIN sampled s ON f.match_id = s.match_id"
)


def _prev_day_sql(base: str, table: str, cols: list[str]) -> tuple[str, list[str]]:
    """LEFT JOIN both teams' rows of the previous match day; returns FROM text and select list."""
    sel = []
    for side in (1, 2):
        sel += [f"p{side}.{c} AS {c}_{side}" for c in cols]
    frm = (
        f"{base} b "
        f"LEFT JOIN {table} p1 ON b.league_id = p1.league_id AND b.team_id_1 = p1.team_id AND b.match_day = p1.match_day + 1 "
        f"LEFT JOIN {table} p2 ON b.league_id = p2.league_id AND b.team_id_2 = p2.team_id AND b.match_day = p2.match_day + 1"
    )
    return frm, sel


def _features_sql(base: str, steps: tuple[str, ...]) -> str:
    """Chain of previous-day joins on top of ``base`` (a CTE name)."""
    sql_prev = base
    parts = []
    for i, step in enumerate(steps):
        table, cols = ("st", ["games", "rank"]) if step == "overall_standings" else ("pf", _perf_cols())
        frm, sel = _prev_day_sql(sql_prev, table, cols)
        extra = ", p1.rank - p2.rank AS rank_diff" if step == "overall_standings" else ""
        # reorder: games_1, rank_1, games_2, rank_2 then the diff
        parts.append(f"f{i} AS (SELECT b.*, {', '.join(sel)}{extra} FROM {frm})")
        sql_prev = f"f{i}"
    return ", ".join(parts), sql_prev


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes)


M = f"m AS ({_matches_sql()})"
RES = f"res AS ({RES_SQL})"
LM = f"lm AS ({_lm_sql()})"
TM = f"tm AS ({TM_SQL})"
CM = f"cm AS ({_clean_sql()})"
FR = f"fr AS ({FINAL_SQL})"
TVO = f"tvo AS ({_team_view_sql('overall')})"
ST = f"st AS ({_standings_sql('tvo')})"
PF = f"pf AS ({_performance_sql('league_id, team_id', 'tvo')})"
PRED = f"pred AS (SELECT {', '.join(PREDICTION_COLUMNS)} FROM orders)"
SCORED = (
    "sc AS (SELECT f.match_id, f.goals_team_1 AS t1, f.goals_team_2 AS t2, p.pred_goals_1, p.pred_goals_2, "
    "p.mu_1, p.mu_2 FROM fr f JOIN pred p ON f.match_id = p.match_id)"
)
BASE_CLEAN = (M, RES, LM, TM, CM, FR)

GOALS_SQL = f"SELECT {', '.join(GOAL_COLUMNS)}, l_orderkey FROM lineitem"
GOAL_KEYS = [c.rsplit(" AS ", 1)[1] for c in GOAL_COLUMNS]


def _raw_goals() -> str:
    """All values of the goal objects as the feed holds them, both spellings of the own-goal flag included."""
    whole = ("goalID", "scoreTeam1", "scoreTeam2", "matchMinute", "goalGetterID")
    cols = ", ".join(f"CAST(g.{k} AS BIGINT) AS {k}" if k in whole else f"g.{k}" for k in GOAL_KEYS)
    return f"{_with(M)}, g AS ({GOALS_SQL}) SELECT {_meta_select('m.')}, {cols} FROM m LEFT JOIN g ON m.matchID = g.l_orderkey"


def _default_teams_sql() -> str:
    rows = [line.rsplit(",", 2) for line in TEAM_MAPPER_CSV.strip().splitlines()[1:]]
    values = ", ".join(f"({a}, {b})" for _, a, b in rows)
    return f"SELECT CAST(a AS BIGINT) AS team_id_raw, CAST(b AS BIGINT) AS team_id_unique FROM (VALUES {values}) t(a, b)"


def _goal_rows() -> str:
    meta = _meta_select("m.")
    goal_cols = []
    for k in ("goalID", "scoreTeam1", "scoreTeam2", "matchMinute", "goalGetterID", "goalGetterName",
              "isPenalty", "isOwnFoal", "isOvertime", "comment"):
        if k == "isOwnFoal":
            goal_cols.append("COALESCE(g.isOwnFoal, g.isOwnGoal) AS isOwnFoal")
        elif k in ("goalID", "scoreTeam1", "scoreTeam2", "matchMinute", "goalGetterID"):
            goal_cols.append(f"CAST(g.{k} AS BIGINT) AS {k}")
        else:
            goal_cols.append(f"g.{k}")
    return (
        f"{_with(M)}, g AS ({GOALS_SQL}) SELECT {meta}, {', '.join(goal_cols)} "
        "FROM m LEFT JOIN g ON m.matchID = g.l_orderkey"
    )


def _grid_sql() -> str:
    lg = ", ".join(f"('{x}')" for x in REQUEST_LEAGUES)
    ss = ", ".join(f"({s})" for s in REQUEST_SEASONS)
    return (
        f"grid AS (SELECT l.league, CAST(s.season AS BIGINT) AS season FROM (VALUES {lg}) l(league), "
        f"(VALUES {ss}) s(season)), "
        "cat AS (SELECT DISTINCT leagueShortcut AS league, leagueSeason AS season FROM m)"
    )


def _features_query(steps: tuple[str, ...], target: str) -> str:
    ctes = list(BASE_CLEAN) + [TVO, ST, PF]
    if target == "goals":
        ctes.append(f"base AS ({GOALS_BASE_SQL})")
    else:
        ctes += [f"sampled AS ({SAMPLED_SQL})", f"base AS ({RESULT_CLASS_BASE_SQL})"]
    chain, last = _features_sql("base", steps)
    return f"{_with(*ctes, chain)} SELECT * FROM {last}"


def oracle_sql() -> dict[str, str]:
    meta_subset = [meta_name(m, "_") for m in META_SUBSET]
    sub_sel = ", ".join(
        "CAST(matchIsFinished AS BIGINT) AS matchIsFinished" if c == "matchIsFinished" else _q(c) for c in meta_subset
    )
    rec_cols = "resultID, resultName, pointsTeam1, pointsTeam2, resultOrderID, resultTypeID, resultDescription"
    q = {}
    q["scan_match_feed"] = _raw_goals()
    q["scan_records_glob"] = f"{_with(M, RES)} SELECT * FROM res"
    q["normalize_match_results"] = q["scan_records_glob"]
    for same in ("stream_match_results", "flatten_feed", "scan_feed_arrays", "scan_season_files"):
        q[same] = q["scan_records_glob"]
    q["normalize_seasons"] = (
        f"{_with(M, RES)} SELECT matchID, leagueShortcut, leagueSeason, "
        f"CASE WHEN CAST(substr(leagueShortcut, 2) AS INTEGER) < {len(REQUEST_LEAGUES) // 2} "
        f"AND NOT {'team1.teamId' in META_SUBSET} THEN NULL ELSE team1_teamId END AS team1_teamId, "
        "resultID, resultName, pointsTeam1, pointsTeam2 FROM res"
    )
    q["normalize_season_files"] = (
        f"{_with(M, RES)} SELECT matchID, leagueShortcut, leagueSeason, team1_teamId, "
        "resultID, resultName, pointsTeam1, pointsTeam2 FROM res"
    )
    span = f"range((SELECT MIN(leagueSeason) FROM m), (SELECT MAX(leagueSeason) FROM m) + {1 + ABSENT_SEASONS})"
    q["season_files_report"] = (
        f"{_with(M)} SELECT league, CAST(season AS BIGINT) AS season, "
        "EXISTS (SELECT 1 FROM m WHERE leagueShortcut = league AND leagueSeason = season) AS available "
        f"FROM (SELECT 'l' || i AS league FROM range({len(REQUEST_LEAGUES)}) l(i)), (SELECT unnest({span}) AS season)"
    )
    q["season_report"] = (
        f"{_with(M)} SELECT leagueShortcut, leagueSeason, NOT bool_or(has_result) AS no_records FROM m "
        "GROUP BY leagueShortcut, leagueSeason"
    )
    # seasons rewritten last hold the rewrite alone, the others what the batch and the stream hold together
    q["merged_seasons"] = f"{_with(M, RES)} SELECT * FROM res WHERE leagueSeason % 4 <> 1 OR matchID % 5 <> 0"
    q["normalize_goals"] = _goal_rows()
    q["normalize_meta_subset"] = f"{_with(M, RES)} SELECT {sub_sel}, {rec_cols} FROM res"
    q["request_grid"] = (
        f"{_with(M)}, {_grid_sql()} SELECT g.league, g.season, "
        "EXISTS (SELECT 1 FROM cat c WHERE c.league = g.league AND c.season = g.season) AS available FROM grid g"
    )
    q["available_seasons"] = (
        f"{_with(M)}, {_grid_sql()} SELECT g.league, g.season FROM grid g "
        "WHERE EXISTS (SELECT 1 FROM cat c WHERE c.league = g.league AND c.season = g.season)"
    )
    q["skipped_seasons"] = (
        f"{_with(M)}, {_grid_sql()} SELECT g.league, g.season FROM grid g "
        "WHERE NOT EXISTS (SELECT 1 FROM cat c WHERE c.league = g.league AND c.season = g.season)"
    )
    q["seasons_without_records"] = (
        f"{_with(M)} SELECT leagueShortcut, leagueSeason, COUNT(*) AS n_matches, "
        "CAST(SUM(CASE WHEN has_result THEN 2 ELSE 0 END) AS BIGINT) AS n_records, "
        "MAX(CASE WHEN has_result THEN 2 ELSE 0 END) = 0 AS no_records FROM m GROUP BY leagueShortcut, leagueSeason"
    )
    q["filter_excluded_leagues"] = f"{_with(M, RES)} SELECT * FROM res WHERE leagueId NOT IN (50, 4570)"
    q["conform_leagues"] = (
        f"{_with(M, RES, LM)} SELECT r.matchID, r.resultID, r.leagueName, "
        "substr(r.leagueName, 1, greatest(length(r.leagueName) - 10, 0)) AS league_name_raw, lm.league_name_unique "
        "FROM res r LEFT JOIN lm ON substr(r.leagueName, 1, greatest(length(r.leagueName) - 10, 0)) = lm.league_name_raw"
    )
    q["conform_teams"] = (
        f"{_with(M, RES, TM)} SELECT r.matchID, r.resultID, r.team1_teamId, r.team2_teamId, "
        "t1.team_id_unique AS team_id_unique_1, t2.team_id_unique AS team_id_unique_2 FROM res r "
        "LEFT JOIN tm t1 ON r.team1_teamId = t1.team_id_raw LEFT JOIN tm t2 ON r.team2_teamId = t2.team_id_raw"
    )
    default_teams = f"tm AS ({_default_teams_sql()})"
    q["conform_teams_csv"] = (
        f"{_with(M, RES, default_teams)} SELECT r.matchID, r.resultID, r.team1_teamId, r.team2_teamId, "
        "t1.team_id_unique AS team_id_unique_1, t2.team_id_unique AS team_id_unique_2 FROM res r "
        "LEFT JOIN tm t1 ON r.team1_teamId = t1.team_id_raw LEFT JOIN tm t2 ON r.team2_teamId = t2.team_id_raw"
    )
    q["unmapped_teams"] = (
        f"{_with(M, RES, TM)} SELECT s.team_id_raw, MIN(s.team_name) AS team_name, COUNT(*) AS n_rows FROM ("
        "SELECT team1_teamId AS team_id_raw, team1_teamName AS team_name FROM res "
        "UNION ALL SELECT team2_teamId, team2_teamName FROM res) s "
        "WHERE s.team_id_raw IS NOT NULL AND s.team_id_raw NOT IN (SELECT team_id_raw FROM tm) "
        "GROUP BY s.team_id_raw"
    )
    q["clean_matches"] = f"{_with(M, RES, LM, TM)} {_clean_sql()}"
    q["clean_sink"] = q["clean_matches"]
    q["suffix_rename"] = (
        f"{_with(M, RES, LM, TM, CM)} SELECT match_id, result_name, match_day AS match_day_1, "
        "goals_team_1 AS goals_team_1_1, goals_team_2 AS goals_team_2_1, league_id AS league_id_1 FROM cm"
    )
    q["clean_feature_subset"] = f"{_with(M, RES, LM, TM)} {_clean_sql(FEATURE_SUBSET)}"
    q["goals_features"] = (
        f"{_with(M, RES, LM, TM)} "
        f"{_clean_sql(['match_id', 'result_name', 'goals_team_1', 'goals_team_2', 'goals_diff'])}"
    )
    q["points_features"] = (
        f"{_with(M, RES, LM, TM)} {_clean_sql(['match_id', 'result_name', 'points_team_1', 'points_team_2'])}"
    )
    q["result_class"] = f"{_with(M, RES, LM, TM)} {_clean_sql(['match_id', 'result_name', 'result_class'])}"
    q["league_name_split"] = (
        f"{_with(M, RES, LM, TM)} "
        f"{_clean_sql(['match_id', 'result_name', 'league_name_raw', 'season_name', 'league_name'])}"
    )
    q["final_results"] = f"{_with(*BASE_CLEAN)} SELECT * FROM fr"
    for cls in ("overall", "home", "away"):
        q[f"team_view_{cls}"] = f"{_with(*BASE_CLEAN)} {_team_view_sql(cls)}"
    q["goals_base_view"] = f"{_with(*BASE_CLEAN)} {GOALS_BASE_SQL}"
    q["result_class_base_view"] = f"{_with(*BASE_CLEAN, f'sampled AS ({SAMPLED_SQL})')} {RESULT_CLASS_BASE_SQL}"
    q["half_sample"] = f"{_with(*BASE_CLEAN)} {SAMPLED_SQL}"
    q["running_totals"] = (
        f"{_with(*BASE_CLEAN, TVO, ST)} SELECT league_id, league_name, season_name, match_day, team_id, team_name, "
        f"{', '.join(TOTALS)} FROM st"
    )
    q["table_rank"] = f"{_with(*BASE_CLEAN, TVO, ST)} SELECT league_id, match_day, team_id, rank FROM st"
    for name, suffix in (("rolling_3", "_last_3_games"), ("rolling_5", "_last_5_games"), ("running_avg", "_avg")):
        cols = ", ".join(f"{m}{suffix}" for m in PERFORMANCE_METRICS)
        q[name] = f"{_with(*BASE_CLEAN, TVO, PF)} SELECT match_id, league_id, match_day, team_id, {cols} FROM pf"
    for cls in ("overall", "home", "away"):
        tv = f"tv AS ({_team_view_sql(cls)})"
        q[f"standings_{cls}"] = f"{_with(*BASE_CLEAN, tv)} {_standings_sql('tv')}"
    q["performance_overall"] = f"{_with(*BASE_CLEAN, TVO, PF)} SELECT * FROM pf"
    for same in ("hot", "sink", "refreshed"):
        q[f"standings_{same}"], q[f"performance_{same}"] = q["standings_overall"], q["performance_overall"]
    q["performance_home_away"] = (
        f"{_with(*BASE_CLEAN, TVO)} {_performance_sql('league_id, team_id, home_team', 'tvo')}"
    )
    q["add_overall_standings"] = _features_query(("overall_standings",), "goals")
    q["add_overall_performance"] = _features_query(("overall_performance",), "goals")
    q["features_goals"] = _features_query(("overall_standings", "overall_performance"), "goals")
    q["features_bucketed"] = q["features_goals"]
    q["features_result_class"] = _features_query(("overall_standings", "overall_performance"), "result_class")
    q["tip_score"] = (
        f"{_with(*BASE_CLEAN, PRED, SCORED)} SELECT match_id, t1, t2, pred_goals_1 AS p1, pred_goals_2 AS p2, "
        "CAST(CASE WHEN t1 = pred_goals_1 AND t2 = pred_goals_2 THEN 3 "
        "WHEN sign(t1 - t2) = sign(pred_goals_1 - pred_goals_2) THEN 2 ELSE 0 END AS INTEGER) AS tip_score FROM sc"
    )
    q["mean_tip_score"] = (
        f"{_with(*BASE_CLEAN, PRED, SCORED)} SELECT AVG(CASE WHEN t1 = pred_goals_1 AND t2 = pred_goals_2 THEN 3 "
        "WHEN sign(t1 - t2) = sign(pred_goals_1 - pred_goals_2) THEN 2 ELSE 0 END) AS mean_tip_score, "
        "COUNT(*) AS n FROM sc"
    )

    def dev(y: str, mu: str) -> str:
        return f"AVG(2 * (CASE WHEN {y} > 0 THEN {y} * ln({y} / {mu}) ELSE 0 END - {y} + {mu}))"

    d = METRIC_DIGITS
    q["poisson_deviance"] = (
        f"SELECT ROUND(d1, {d}) AS poisson_deviance_1, ROUND(d1, {d}) AS mean_poisson_deviance FROM "
        f"(SELECT {dev('y', 'mu')} AS d1 FROM (SELECT {', '.join(DEVIANCE_COLUMNS)} FROM orders) o) x"
    )
    q["multi_poisson_deviance"] = (
        f"{_with(*BASE_CLEAN, PRED, SCORED)} SELECT ROUND(d1, {d}) AS poisson_deviance_1, "
        f"ROUND(d2, {d}) AS poisson_deviance_2, ROUND((d1 + d2) / 2, {d}) AS mean_poisson_deviance "
        f"FROM (SELECT {dev('t1', 'mu_1')} AS d1, {dev('t2', 'mu_2')} AS d2 FROM sc) x"
    )
    return q
