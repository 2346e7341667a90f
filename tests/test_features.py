"""Previous-match-day features and the feature builder."""

import warnings

import pytest
from pyspark.sql import functions as F

from helpers import clean_rows
from matchday.plans.features import FeatureBuilder
from matchday.plans.tables import performance, standings
from matchday.schemas import performance_columns
from test_tables import GAMES


def test_goals_features(spark):
    m = clean_rows(spark, GAMES)
    fb = FeatureBuilder(spark)
    out = fb.get_features(m, {"overall_standings": standings(m), "overall_performance": performance(m)})
    base_cols = ["match_id", "league_id", "match_day", "team_id_1", "team_name_1", "team_id_2", "team_name_2",
                 "home_team", "goals"]
    perf = performance_columns()
    assert out.columns == base_cols + ["games_1", "rank_1", "games_2", "rank_2", "rank_diff"] + \
        [f"{c}_1" for c in perf] + [f"{c}_2" for c in perf]
    assert out.count() == 2 * len(GAMES)
    rows = {(r.match_id, r.team_id_1): r for r in out.collect()}
    st = {(r.match_day, r.team_id): r for r in standings(m).collect()}
    # match 3 on day 2: team 2 vs team 3 -> their standings after day 1
    r = rows[(3, 2)]
    assert (r.games_1, r.rank_1, r.games_2, r.rank_2) == (1, st[(1, 2)].rank, 1, st[(1, 3)].rank)
    assert r.rank_diff == st[(1, 2)].rank - st[(1, 3)].rank
    # day 1 has no previous day
    assert rows[(1, 1)].games_1 is None and rows[(1, 1)].points_avg_1 is None
    # team 4 skipped day 3: on day 4 it has no day-3 row, so its features are null
    r = rows[(6, 4)]
    assert r.games_1 is None and r.points_last_3_games_1 is None
    assert rows[(6, 2)].games_2 is None  # seen from team 2: opponent 4 is side 2


def test_steps_alone_equal_steps_together(spark):
    m = clean_rows(spark, GAMES)
    st, pf = standings(m), performance(m)
    fb = FeatureBuilder(spark)
    together = fb.get_features(m, {"overall_standings": st, "overall_performance": pf})
    base = fb.goals_base_view(fb.load_match_results(m))
    apart = fb.add_overall_performance(fb.add_overall_standings(base, st), pf)
    assert together.columns == apart.columns
    assert sorted(map(tuple, together.collect()), key=str) == sorted(map(tuple, apart.collect()), key=str)


def test_null_team_never_matches_and_duplicates_fan_out(spark):
    m = clean_rows(spark, [(1, 10, 1, 1, 2, 1, 0), (2, 10, 2, None, 1, 0, 0), (3, 10, 2, 2, 1, 1, 1)])
    # a lookup with a duplicated key fans out like the left join it stands for
    st = standings(m)
    dup = st.union(st.filter("team_id = 1"))
    out = FeatureBuilder(spark).get_features(m, {"overall_standings": dup})
    assert out.filter("match_id = 2 AND team_id_1 IS NULL").select("games_1").collect()[0][0] is None
    assert out.filter("match_id = 3 AND team_id_1 = 2").count() == 2  # opponent 1 has two day-1 rows


def test_registry_behaviour(spark):
    m = clean_rows(spark, GAMES)

    class Custom(FeatureBuilder):
        def add_constant(self, base, value):
            return base.withColumn("const", F.lit(value))

    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        out = Custom(spark).get_features(m, {"constant": 5, "nope": None})
    assert "const" in out.columns and any("nope" in str(x.message) for x in w)
    with pytest.raises(NotImplementedError):
        FeatureBuilder(spark).get_features(m, {}, target="scores")
    rc = FeatureBuilder(spark, seed="x").get_features(m, {"overall_standings": standings(m)}, target="result_class")
    assert rc.count() == len(GAMES) and "rank_diff" in rc.columns
