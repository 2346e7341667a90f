"""Clean stage: excluded leagues, name splitting, conforming joins, feature registry."""

import warnings

import pytest
from pyspark.sql import functions as F

from matchday.functions.features import build_features, league_name_raw, season_name
from matchday.operators.conform import clean, conform_teams
from matchday.sources import mappers
from matchday.sources.tables import local_table
from matchday.schemas import TEAM_MAPPER_SCHEMA, normalized_schema
from matchday.testing.planinfo import plan_text


def _records(spark, rows):
    """rows: (matchID, leagueId, leagueName, team1, team2, p1, p2, resultName)"""
    schema = normalized_schema("matchResults")
    full = []
    for mid, lid, name, t1, t2, p1, p2, rn in rows:
        d = {f.name: None for f in schema.fields}
        d.update({"matchID": mid, "leagueId": lid, "leagueName": name, "team1.teamId": t1, "team2.teamId": t2,
                  "pointsTeam1": p1, "pointsTeam2": p2, "resultName": rn, "group.groupOrderID": 3,
                  "group.groupName": "3. Spieltag", "team1.teamName": f"T{t1}", "team2.teamName": f"T{t2}"})
        full.append(tuple(d[f.name] for f in schema.fields))
    return spark.createDataFrame(full, schema)


def test_name_split(spark):
    df = spark.createDataFrame(
        [("3. Fußball-Liga 2008/2009",), ("short",), ("",)], "leagueName string"
    )
    got = df.select(league_name_raw(), season_name()).collect()
    assert [tuple(r) for r in got] == [("3. Fußball-Liga", "2008/2009"), ("", "short"), ("", "")]


def test_clean_conforms_and_filters(spark):
    recs = _records(spark, [
        (1, 4608, "1. Fußball-Bundesliga 2023/2024", 1714, 7, 2, 1, "Endergebnis"),
        (2, 50, "1. Fußball-Bundesliga 2023/2024", 40, 7, 0, 0, "Endergebnis"),  # excluded league
        (3, None, "1. Fußball-Bundesliga 2023/2024", 40, 7, 0, 0, "Endergebnis"),  # null league dropped
        (4, 4608, "Unknown League 2023/2024", 99999, None, None, 1, "Endergebnis"),
    ])
    out = clean(recs, mappers.league_mapper(spark), mappers.team_mapper(spark))
    rows = {r["match_id"]: r for r in out.collect()}
    assert set(rows) == {1, 4}
    r = rows[1]
    assert (r.league_name, r.season_name, r.team_id_1, r.team_id_2) == ("1. Fussball-Bundesliga", "2023/2024", 187, 7)
    assert (r.goals_team_1, r.goals_team_2, r.goals_diff, r.result_class, r.points_team_1, r.points_team_2) == (2, 1, 1, 1, 3, 0)
    r = rows[4]
    assert (r.league_name, r.team_id_1, r.team_id_2) == (None, None, None)
    # a null score counts as 0 goals but has no points or class
    assert (r.goals_team_1, r.goals_team_2, r.goals_diff, r.result_class, r.points_team_1) == (0, 1, 0, None, None)
    assert out.columns[0] == "match_id" and len(out.columns) == 17


def test_unknown_feature_is_skipped(spark):
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        cols = build_features(["match_id", "nope"])
    assert len(cols) == 1 and any("nope" in str(x.message) for x in w)


def test_goal_records_with_result_features_fail_clearly(spark):
    schema = normalized_schema("goals", meta=["matchID", "leagueId", "leagueName", "team1.teamId", "team2.teamId"])
    df = spark.createDataFrame([], schema)
    with pytest.raises(ValueError):
        clean(df, mappers.league_mapper(spark), mappers.team_mapper(spark))
    ok = clean(df, mappers.league_mapper(spark), mappers.team_mapper(spark), features=["match_id", "league_id"])
    assert ok.columns == ["match_id", "league_id"]


def test_team_mapper_never_fans_out(spark):
    tm = mappers.team_mapper(spark)
    assert tm.count() == tm.select("team_id_raw").distinct().count() == 95


def test_conform_teams_is_broadcast(spark):
    recs = _records(spark, [(1, 4608, "3. Liga 2008/2009", 66, 1067, 1, 1, "Endergebnis")])
    tm = local_table(spark, [("x", 66, 66), ("x", 1067, 66)], TEAM_MAPPER_SCHEMA)
    out = conform_teams(recs, tm)
    plan = plan_text(out)
    assert "BroadcastHashJoin" in plan
    r = out.select("team_id_unique_1", "team_id_unique_2").collect()[0]
    assert tuple(r) == (66, 66)


def test_suffix_alias_and_registry(spark):
    from matchday.functions.features import FEATURES, register_feature, suffix_alias

    df = spark.createDataFrame([(1, 2)], "a long, b long")
    assert df.select(suffix_alias("a", "_1")).columns == ["a_1"]
    assert df.select(*suffix_alias(["a", "b"], "_2")).columns == ["a_2", "b_2"]
    with pytest.raises(ValueError):
        suffix_alias(3, "_x")
    register_feature("double_a", lambda sep=".": (F.col("a") * 2).alias("double_a"))
    try:
        assert df.select(*build_features(["double_a"])).collect()[0][0] == 2
    finally:
        FEATURES.pop("double_a")
