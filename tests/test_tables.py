"""Standings (running totals + rank) and performance (rolling sums + averages)."""

import pytest
from pyspark.sql import functions as F

from helpers import clean_rows
from matchday.plans.tables import performance, standings

# one league, 4 teams, 6 match days; team 4 skips day 3
GAMES = [
    (1, 10, 1, 1, 2, 2, 0), (2, 10, 1, 3, 4, 1, 1),
    (3, 10, 2, 2, 3, 0, 3), (4, 10, 2, 4, 1, 1, 0),
    (5, 10, 3, 1, 3, 2, 2),
    (6, 10, 4, 2, 4, 1, 2), (7, 10, 4, 3, 1, 0, 1),
    (8, 10, 5, 1, 2, 3, 3), (9, 10, 5, 4, 3, 0, 2),
    (10, 10, 6, 1, 4, 1, 0), (11, 10, 6, 2, 3, 2, 1),
]


def _team1(rows):
    return sorted((r for r in rows if r.team_id == 1), key=lambda r: r.match_day)


def test_running_totals_and_rank(spark):
    st = standings(clean_rows(spark, GAMES))
    assert st.columns == ["league_id", "league_name", "season_name", "match_day", "team_id", "team_name", "games",
                          "wins", "draws", "losses", "goals_scored", "goals_conceded", "goals_diff", "points", "rank"]
    rows = st.collect()
    t1 = _team1(rows)
    assert [r.points for r in t1] == [3, 3, 4, 7, 8, 11]
    assert [r.games for r in t1] == [1, 2, 3, 4, 5, 6]
    assert [r.goals_scored for r in t1] == [2, 2, 4, 5, 8, 9]
    assert [r.goals_diff for r in t1] == [2, 1, 1, 2, 2, 3]
    day1 = sorted((r.team_id, r.rank) for r in rows if r.match_day == 1)
    # team 1 won 2-0; teams 3 and 4 drew 1-1 and tie (rank "min"); team 2 lost
    assert day1 == [(1, 1), (2, 4), (3, 2), (4, 2)]
    assert all(r.games == r.wins + r.draws + r.losses for r in rows)


def test_home_plus_away_equals_overall(spark):
    m = clean_rows(spark, GAMES)
    key = ["league_id", "match_day", "team_id"]
    cols = ["games", "wins", "draws", "losses", "goals_scored", "goals_conceded", "goals_diff", "points"]
    o = {tuple(r[k] for k in key): r for r in standings(m, "overall").collect()}
    h = {tuple(r[k] for k in key): r for r in standings(m, "home").collect()}
    a = {tuple(r[k] for k in key): r for r in standings(m, "away").collect()}
    assert o.keys() == h.keys() == a.keys()
    for k in o:
        assert all(o[k][c] == h[k][c] + a[k][c] for c in cols)


def test_rolling_and_average(spark):
    pf = performance(clean_rows(spark, GAMES))
    assert pf.columns[:6] == ["match_id", "league_id", "match_day", "team_id", "team_name", "home_team"]
    assert len(pf.columns) == 27
    t1 = _team1(pf.collect())
    # team 1 points per game: 3, 0, 1, 3, 1, 3
    assert [r.points_last_3_games for r in t1] == [None, None, 4, 4, 5, 7]
    assert [r.points_last_5_games for r in t1] == [None, None, None, None, 8, 8]
    assert [r.points_avg for r in t1] == pytest.approx([3.0, 1.5, 4 / 3, 7 / 4, 8 / 5, 11 / 6])


def test_home_away_partitions(spark):
    pf = performance(clean_rows(spark, GAMES), "home_away")
    t1_home = sorted((r for r in pf.collect() if r.team_id == 1 and r.home_team == 1), key=lambda r: r.match_day)
    # team 1 at home on days 1, 3, 5, 6: points 3, 1, 1, 3
    assert [r.points_last_3_games for r in t1_home] == [None, None, 5, 5]
    assert [r.points_avg for r in t1_home] == pytest.approx([3.0, 2.0, 5 / 3, 2.0])
    with pytest.raises(ValueError):
        performance(clean_rows(spark, GAMES), "weekly")


def test_null_team_is_one_panel(spark):
    # two unmapped teams share the null team id: their games form one panel per league
    g = [(1, 10, 1, None, 2, 1, 0), (2, 10, 1, None, 3, 0, 0), (3, 10, 2, 2, None, 2, 2)]
    st = standings(clean_rows(spark, g))
    nulls = sorted((r.match_day, r.games, r.points) for r in st.collect() if r.team_id is None)
    assert nulls == [(1, 1, 3), (1, 2, 4), (2, 3, 5)]
