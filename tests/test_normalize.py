"""Feed scan and normalisation (explode_outer semantics, validation, catalogue)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from matchday.operators.normalize import flatten, normalize, seasons_without_records
from matchday.schemas import META_COLUMNS
from matchday.sources.feed import (
    available_seasons,
    catalogue_from_files,
    feed_catalogue,
    read_feed,
    request_grid,
    scan_records,
    skipped_seasons,
)
from matchday.sources.sinks import write_feed_lines, write_normalized


def _match(mid, results, goals=None, **kw):
    m = {
        "matchID": mid,
        "leagueId": 4608,
        "leagueName": "1. Fußball-Bundesliga 2023/2024",
        "leagueSeason": 2023,
        "leagueShortcut": "bl1",
        "group": {"groupName": "1. Spieltag", "groupOrderID": 1, "groupID": 1},
        "team1": {"teamId": 40, "teamName": "A"},
        "team2": {"teamId": 7, "teamName": "B"},
        "matchIsFinished": True,
    }
    if results is not None:
        m["matchResults"] = results
    if goals is not None:
        m["goals"] = goals
    m.update(kw)
    return m


def _write(tmp_dir, name, matches):
    p = os.path.join(tmp_dir, name)
    with open(p, "w", encoding="utf-8") as f:
        json.dump(matches, f)
    return p


FINAL = {"resultID": 1, "resultName": "Endergebnis", "pointsTeam1": 2, "pointsTeam2": 1, "resultOrderID": 2}
HALF = {"resultID": 2, "resultName": "Halbzeitergebnis", "pointsTeam1": 1, "pointsTeam2": 0, "resultOrderID": 1}


def test_array_file_scan_and_outer_explode(spark, tmp_dir):
    matches = [
        _match(1, [FINAL, HALF]),
        _match(2, []),  # empty list keeps the match
        _match(3, None),  # missing list keeps the match
        _match(4, None, matchResults=None),  # null list keeps the match
    ]
    feed = read_feed(spark, _write(tmp_dir, "bl1_2023.json", matches), layout="array")
    out = normalize(feed, "matchResults")
    assert out.columns == [*META_COLUMNS, "resultID", "resultName", "pointsTeam1", "pointsTeam2",
                           "resultOrderID", "resultTypeID", "resultDescription"]
    rows = sorted(out.select("matchID", "resultName", "matchIsFinished", "`team1.teamId`").collect())
    assert [(r[0], r[1]) for r in rows] == [(1, "Endergebnis"), (1, "Halbzeitergebnis"), (2, None), (3, None), (4, None)]
    assert all(r[2] == 1 for r in rows)  # boolean feed flag cast to bigint
    assert all(r[3] == 40 for r in rows)
    # missing keys read as null
    assert out.filter("matchID = 1").select("resultTypeID").distinct().collect()[0][0] is None


def test_goal_flag_spellings_are_merged(spark, tmp_dir):
    goals = [
        {"goalID": 10, "scoreTeam1": 1, "scoreTeam2": 0, "isOwnFoal": True},
        {"goalID": 11, "scoreTeam1": 2, "scoreTeam2": 0, "isOwnGoal": False},
        {"goalID": 12, "scoreTeam1": 2, "scoreTeam2": 1},
    ]
    feed = read_feed(spark, _write(tmp_dir, "bl1_2023.json", [_match(1, [FINAL], goals), _match(2, [FINAL])]))
    out = normalize(feed, "goals", meta=["matchID"])
    assert out.columns == ["matchID", "goalID", "scoreTeam1", "scoreTeam2", "matchMinute", "goalGetterID",
                           "goalGetterName", "isPenalty", "isOwnFoal", "isOvertime", "comment"]
    got = {r["goalID"]: r["isOwnFoal"] for r in out.collect()}
    assert got == {10: True, 11: False, 12: None, None: None}


def test_separator_and_flatten(spark, tmp_dir):
    feed = read_feed(spark, _write(tmp_dir, "bl1_2023.json", [_match(1, [FINAL])]))
    flat = flatten(feed, meta=["matchID", "team1.teamId"], separator="_")
    assert flat.columns == ["matchID", "team1_teamId", "matchResults", "goals"]
    out = normalize(feed, meta=["group.groupOrderID"], separator="_")
    assert out.columns[0] == "group_groupOrderID"


def test_validation(spark, tmp_dir):
    feed = read_feed(spark, _write(tmp_dir, "bl1_2023.json", [_match(1, [FINAL])]))
    with pytest.raises(ValueError):
        normalize(feed, "cards")
    with pytest.raises(ValueError):
        normalize(feed, meta=["matchID", "nope"])
    with pytest.raises(ValueError):
        normalize(feed, meta="some")
    with pytest.raises(ValueError):
        normalize(feed, meta=42)


def test_seasons_without_records(spark, tmp_dir):
    p1 = _write(tmp_dir, "bl1_2023.json", [_match(1, [FINAL]), _match(2, [])])
    p2 = _write(tmp_dir, "bl2_2023.json", [_match(3, [], leagueShortcut="bl2"), _match(4, None, leagueShortcut="bl2")])
    feed = read_feed(spark, [p1, p2])
    got = {r["leagueShortcut"]: (r["n_matches"], r["n_records"], r["no_records"])
           for r in seasons_without_records(feed).collect()}
    assert got == {"bl1": (2, 1, False), "bl2": (2, 0, True)}


def test_catalogue_grid_semi_anti(spark, tmp_dir):
    _write(tmp_dir, "bl1_2023.json", [_match(1, [FINAL])])
    _write(tmp_dir, "bl2_2022.json", [_match(2, [FINAL], leagueShortcut="bl2", leagueSeason=2022)])
    files = catalogue_from_files(spark, tmp_dir)
    assert sorted(tuple(r) for r in files.collect()) == [("bl1", 2023), ("bl2", 2022)]
    feed = read_feed(spark, tmp_dir)
    assert sorted(tuple(r) for r in feed_catalogue(feed).collect()) == [("bl1", 2023), ("bl2", 2022)]
    grid = request_grid(spark, ["bl1", "bl2"], [2022, 2023])
    assert grid.count() == 4
    assert sorted(tuple(r) for r in available_seasons(grid, files).collect()) == [("bl1", 2023), ("bl2", 2022)]
    assert sorted(tuple(r) for r in skipped_seasons(grid, files).collect()) == [("bl1", 2022), ("bl2", 2023)]


def test_partitioned_write_and_scan(spark, tmp_dir):
    feed = read_feed(spark, _write(tmp_dir, "bl1_2023.json", [_match(1, [FINAL, HALF]), _match(2, [])]))
    root = os.path.join(tmp_dir, "normalized")
    write_normalized(normalize(feed), root, "matchResults")
    assert os.path.isdir(os.path.join(root, "matchResults", "leagueShortcut=bl1", "leagueSeason=2023"))
    back = scan_records(spark, root, "matchResults")
    assert back.columns == normalize(feed).columns
    assert back.count() == 3
    assert back.schema["leagueSeason"].dataType.simpleString() == "bigint"


def test_rewriting_a_season_keeps_the_others(spark, tmp_dir):
    root = os.path.join(tmp_dir, "normalized")
    a = read_feed(spark, _write(tmp_dir, "bl1_2022.json", [_match(1, [FINAL], leagueSeason=2022)]))
    write_normalized(normalize(a), root, "matchResults")
    b = read_feed(spark, _write(tmp_dir, "bl1_2023.json", [_match(2, [FINAL, HALF])]))
    write_normalized(normalize(b), root, "matchResults")
    b2 = read_feed(spark, _write(tmp_dir, "bl1_2023.json", [_match(3, [FINAL])]))
    write_normalized(normalize(b2), root, "matchResults")  # 2023 again: replaced, 2022 kept
    back = scan_records(spark, root, "matchResults")
    assert sorted((r.leagueSeason, r.matchID) for r in back.select("leagueSeason", "matchID").collect()) == [
        (2022, 1), (2023, 3)]


def test_feed_lines_are_small_files(spark, tmp_dir):
    feed = read_feed(spark, _write(tmp_dir, "bl1_2023.json", [_match(i, [FINAL, HALF]) for i in range(1, 201)])).coalesce(1)
    out = os.path.join(tmp_dir, "lines")
    write_feed_lines(feed, out, rows_per_file=50)
    files = [os.path.join(out, f) for f in os.listdir(out) if f.startswith("part-")]
    assert len(files) == 4 and all(f.endswith(".json.gz") for f in files)
    plain = sum(len(r[0]) + 1 for r in feed.select(F.to_json(F.struct("*"))).collect())
    assert 4 * sum(map(os.path.getsize, files)) < plain
    back = read_feed(spark, out, layout="lines")
    assert back.count() == 200 and back.exceptAll(feed).count() == 0 and feed.exceptAll(back).count() == 0
