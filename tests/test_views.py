"""Team views, goal/result-class base views and the exact half sample."""

import pytest
from pyspark.sql import functions as F

from helpers import clean_rows
from matchday.operators.sampling import half_sample, half_sample_flag
from matchday.operators.views import (
    goals_base_view,
    load_match_results,
    result_class_base_view,
    team_side_view,
    team_view,
)

GAMES = [
    (1, 10, 1, 1, 2, 2, 0),
    (2, 10, 1, 3, 4, 1, 1),
    (3, 10, 2, 2, 3, 0, 3),
    (4, 10, 2, 4, 1, 1, 0),
    (5, 10, 3, 1, 3, 2, 2),
]


def test_final_result_filter(spark):
    df = clean_rows(spark, GAMES + [(6, 10, 34, 1, 2, 1, 0, "Relegation Rückspiel"), (7, 10, 3, 2, 4, None, 1)])
    df = df.union(clean_rows(spark, [(8, 10, 3, 2, 4, 1, 1)], result_name="Halbzeitergebnis"))
    assert sorted(r[0] for r in load_match_results(df).select("match_id").collect()) == [1, 2, 3, 4, 5]


def test_team_view_overall(spark):
    v = team_view(clean_rows(spark, GAMES))
    assert v.columns == ["match_id", "league_id", "league_name", "season_name", "match_day", "team_id", "team_name",
                         "home_team", "games", "wins", "draws", "losses", "goals_scored", "goals_conceded",
                         "goals_diff", "points"]
    rows = {(r.match_id, r.team_id): r for r in v.collect()}
    r = rows[(3, 3)]
    assert (r.home_team, r.games, r.wins, r.draws, r.losses, r.goals_scored, r.goals_conceded, r.goals_diff, r.points) == (
        0, 1, 1, 0, 0, 3, 0, 3, 3)
    # invariants per (league, match day): wins = losses, goal differences cancel
    agg = v.groupBy("league_id", "match_day").agg(
        F.sum("wins").alias("w"), F.sum("losses").alias("l"), F.sum("goals_diff").alias("d")).collect()
    assert all(a.w == a.l and a.d == 0 for a in agg)
    assert v.filter(F.col("games") != F.col("wins") + F.col("draws") + F.col("losses")).count() == 0


def test_home_away_views_keep_zero_rows(spark):
    home = team_view(clean_rows(spark, GAMES), "home")
    assert home.count() == 10
    away_side = home.filter("home_team = 0")
    assert away_side.agg(F.sum("games"), F.sum("points"), F.sum("goals_scored")).collect()[0] == (0, 0, 0)
    away = team_view(clean_rows(spark, GAMES), "away")
    assert away.filter("home_team = 1").agg(F.sum("games")).collect()[0][0] == 0
    one = team_side_view(clean_rows(spark, GAMES), 2, "home")
    assert one.count() == 5 and one.agg(F.sum("games")).collect()[0][0] == 0
    with pytest.raises(ValueError):
        team_view(clean_rows(spark, GAMES), "neutral")
    with pytest.raises(ValueError):
        team_side_view(clean_rows(spark, GAMES), 3)


def test_goals_base_view(spark):
    v = goals_base_view(clean_rows(spark, GAMES))
    assert v.columns == ["match_id", "league_id", "match_day", "team_id_1", "team_name_1", "team_id_2",
                         "team_name_2", "home_team", "goals"]
    got = sorted((r.match_id, r.team_id_1, r.team_id_2, r.home_team, r.goals) for r in v.filter("match_id = 3").collect())
    assert got == [(3, 2, 3, 1, 0), (3, 3, 2, 0, 3)]


def test_half_sample_exact_and_reproducible(spark):
    ids = spark.range(0, 1001).withColumnRenamed("id", "match_id")
    s1 = half_sample(ids, seed="a")
    assert s1.count() == 500
    assert sorted(r[0] for r in s1.collect()) == sorted(r[0] for r in half_sample(ids, seed="a").collect())
    assert set(r[0] for r in s1.collect()) != set(r[0] for r in half_sample(ids, seed="b").collect())
    # equals the global ranking by (md5(seed || id), id)
    ranked = sorted(((__import__("hashlib").md5(f"a{i}".encode()).hexdigest(), i) for i in range(1001)))
    assert sorted(r[0] for r in s1.collect()) == sorted(i for _, i in ranked[:500])


def test_half_sample_on_every_path(spark, monkeypatch):
    """Few and many groups, a cut outside the kept keys, a wrong bound, null ids and other fractions: always the global ranking."""
    import hashlib

    from matchday.operators import sampling

    rows = [(i,) for i in range(3000)] + [(None,)] * 5 + [(11,)] * 900
    df = spark.createDataFrame(rows, "match_id long").repartition(4)
    keyed = sorted(((hashlib.md5(("" if i is None else str(i)).encode()).hexdigest(), i) for (i,) in rows), key=lambda k: k[0])
    for most in (50_000, 0):
        monkeypatch.setattr(sampling, "DRIVER_KEYS", most)
        for bound in (None, len(rows), 10**9, 10**15, 1):
            for fraction in (0.5, 0.0, 1.0, 0.03):
                need = int(len(rows) * fraction)
                cut = keyed[need - 1][0] if need else ""
                got = half_sample(df, fraction=fraction, rows=bound).collect()
                assert len(got) == sum(h <= cut for h, _ in keyed), (most, bound, fraction)


def test_half_sample_with_copies(spark):
    # one id holding a third of the rows: all its copies are in or out together
    rows = [(7,)] * 300 + [(i,) for i in range(100, 700)]
    df = spark.createDataFrame(rows, "match_id long")
    flag = half_sample_flag(df, "match_id")
    marked = df.withColumn("m", flag)
    per_id = marked.groupBy("match_id").agg(F.countDistinct("m").alias("k"))
    assert per_id.filter("k > 1").count() == 0
    assert half_sample_flag(df.limit(0), "match_id") is not None


def test_result_class_base_view_mirrors_half(spark):
    m = clean_rows(spark, GAMES + [(6, 10, 3, 2, 4, 0, 1)])
    v = result_class_base_view(m, seed="s")
    assert v.columns == ["match_id", "league_id", "match_day", "team_id_1", "team_name_1", "team_id_2",
                         "team_name_2", "goals_team_1", "goals_team_2", "goals_diff", "result_class", "home_team"]
    assert v.filter("home_team = 0").count() == 3
    orig = {r.match_id: r for r in m.collect()}
    for r in v.collect():
        o = orig[r.match_id]
        if r.home_team == 0:
            assert (r.team_id_1, r.team_id_2, r.goals_team_1, r.goals_diff, r.result_class) == (
                o.team_id_2, o.team_id_1, o.goals_team_2, -o.goals_diff, -o.result_class)
        else:
            assert (r.team_id_1, r.goals_diff, r.result_class) == (o.team_id_1, o.goals_diff, o.result_class)
    # mirroring the mirrored rows again restores the input
    twice = result_class_base_view(v.withColumn("league_name", F.lit(None)), mirrored=F.col("home_team") == 0)
    back = {r.match_id: (r.team_id_1, r.goals_diff, r.result_class) for r in twice.collect()}
    assert back == {k: (o.team_id_1, o.goals_diff, o.result_class) for k, o in orig.items()}
