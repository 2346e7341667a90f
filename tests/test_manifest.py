"""Season manifest: batch and stream commits of one table, damaged files, reports of the write, incremental tables."""

import json
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from matchday.plans import create_standings, normalize_seasons, refresh_tables, scan_refreshed
from matchday.plans.cleaning import clean_records
from matchday.sources import manifest, read_feed, scan_records, season_report, split_rejects, vacuum, write_normalized
from matchday.operators.normalize import normalize
from matchday.streaming import normalize_stream
from test_normalize import FINAL, HALF, _match, _write


def _ids(spark, root):
    return sorted(r[0] for r in scan_records(spark, root).select("matchID").collect())


def _folders(tmp_dir, *names):
    out = [os.path.join(tmp_dir, n) for n in names]
    for p in out[:-1]:
        os.makedirs(p)
    return out


def _stream(spark, landing, root, **kw):
    q = normalize_stream(spark, landing, root, **kw)
    q.awaitTermination(120)
    assert q.exception() is None


def test_stream_after_batch_keeps_both_and_later_batch_replaces(spark, tmp_dir):
    feed, landing, root = _folders(tmp_dir, "feed", "landing", "out")
    _write(feed, "bl1_2023.json", [_match(1, [FINAL])])
    normalize_seasons(spark, feed, root)
    _write(landing, "bl1_2023.json", [_match(2, [FINAL])])
    _stream(spark, landing, root)
    assert _ids(spark, root) == [1, 2]
    # the season lands again with one match changed and one more: the later rows of a match count
    _write(landing, "bl1_2023b.json", [_match(2, [dict(FINAL, pointsTeam1=9)]), _match(3, [])])
    _stream(spark, landing, root)
    rows = {(r.matchID, r.pointsTeam1) for r in scan_records(spark, root).collect()}
    assert rows == {(1, 2), (2, 9), (3, None)}
    # a batch write replaces the season as a whole
    normalize_seasons(spark, feed, root)
    assert _ids(spark, root) == [1]


def test_batch_run_again_after_a_failure_commits_once(spark, tmp_dir):
    feed, root = _folders(tmp_dir, "feed", "out")
    rows = normalize(read_feed(spark, _write(feed, "bl1_2023.json", [_match(1, [FINAL])])))
    manifest.write_version(rows, root, "matchResults", replaces=False, writer="stream-x-0")
    assert manifest.committed(spark, root, "matchResults", "stream-x-0")
    assert not manifest.committed(spark, root, "matchResults", "stream-x-1")


def test_uncommitted_versions_are_not_read(spark, tmp_dir):
    feed, root = _folders(tmp_dir, "feed", "out")
    rows = normalize(read_feed(spark, _write(feed, "bl1_2023.json", [_match(1, [FINAL])])))
    write_normalized(rows, root)
    # a writer that died before its commit
    lost = rows.withColumn("version", F.lit(99))
    lost.write.mode("append").partitionBy(*manifest.SEASON_PARTITIONS, "version").parquet(os.path.join(root, "matchResults"))
    assert _ids(spark, root) == [1]
    assert manifest.entries(spark, root, "matchResults").count() == 1
    # versions that hold nothing live go only on request
    write_normalized(rows, root)
    assert manifest.entries(spark, root, "matchResults").count() == 2
    assert vacuum(spark, root, "matchResults") == [1, 99]
    assert manifest.entries(spark, root, "matchResults").count() == 1
    assert _ids(spark, root) == [1]


def test_versions_are_reserved_once(spark, tmp_dir):
    (root,) = _folders(tmp_dir, "out")
    got = [manifest._reserve(spark, root, "t") for _ in range(3)]
    assert got == [1, 2, 3]


def test_null_seasons_and_null_match_ids(spark, tmp_dir):
    feed, root = _folders(tmp_dir, "feed", "out")
    a = _match(None, [FINAL], leagueShortcut=None, leagueSeason=None)
    rows = normalize(read_feed(spark, _write(feed, "x.json", [a, a, _match(5, [FINAL], leagueShortcut="a/b=c")])))
    write_normalized(rows, root, mode="append")
    write_normalized(rows, root, mode="append")
    assert sorted(map(str, (r[0] for r in scan_records(spark, root).select("matchID").collect()))) == ["5", "None", "None", "None", "None"]
    write_normalized(rows, root)
    assert scan_records(spark, root).count() == 3
    assert scan_records(spark, root, seasons=[(None, None)]).count() == 2
    assert scan_records(spark, root, seasons=[("a/b=c", 2023)]).count() == 1
    assert scan_records(spark, root, seasons=[]).count() == 0


# --- damaged files ----------------------------------------------------------------
def _damaged(feed):
    good = json.dumps([_match(1, [FINAL]), _match(2, [FINAL])])
    with open(os.path.join(feed, "bl1_2023.json"), "w", encoding="utf-8") as f:
        f.write(good[: len(good) - 40])
    _write(feed, "bl1_2022.json", [_match(3, [FINAL], leagueSeason=2022)])


def test_a_truncated_array_file_fails_and_commits_nothing(spark, tmp_dir):
    feed, root = _folders(tmp_dir, "feed", "out")
    _damaged(feed)
    with pytest.raises((PySparkException, Py4JJavaError)):
        normalize_seasons(spark, feed, root)
    assert not manifest.has_log(spark, root, "matchResults")


def test_a_truncated_file_is_rejected_on_request(spark, tmp_dir):
    feed, root = _folders(tmp_dir, "feed", "out")
    _damaged(feed)
    normalize_seasons(spark, feed, root, errors="reject")
    assert _ids(spark, root) == [3]
    bad = spark.read.parquet(os.path.join(root, "matchResults_rejects")).collect()
    assert len(bad) == 1 and bad[0].file.endswith("bl1_2023.json") and bad[0].record.startswith("[{")


def test_damaged_lines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "feed.json")
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(_match(1, [FINAL])) + "\n{\"matchID\": 2, \n" + json.dumps(_match(3, [HALF])) + "\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_feed(spark, path, layout="lines").collect()
    good, bad = split_rejects(read_feed(spark, path, layout="lines", errors="keep"))
    assert sorted(r.matchID for r in good.collect()) == [1, 3] and good.columns == read_feed(spark, path).columns
    assert [r.record.strip() for r in bad.collect()] == ['{"matchID": 2,']
    with pytest.raises(ValueError):
        read_feed(spark, path, errors="ignore")


def test_a_damaged_file_stops_a_stream(spark, tmp_dir):
    landing, root = _folders(tmp_dir, "landing", "out")
    _damaged(landing)
    q = normalize_stream(spark, landing, root)
    with pytest.raises((PySparkException, Py4JJavaError)):
        q.awaitTermination(120)
    assert not manifest.has_log(spark, root, "matchResults")


# --- reports that come out of the write ---------------------------------------------
def test_reports_of_the_write(spark, tmp_dir):
    feed, root = _folders(tmp_dir, "feed", "out")
    path = os.path.join(feed, "all.json")
    with open(path, "w", encoding="utf-8") as f:
        for m in (_match(1, [FINAL]), _match(2, []), _match(3, [], leagueShortcut="bl2")):
            f.write(json.dumps(m) + "\n")
    skipped = normalize_seasons(spark, feed, root, ["bl1", "bl2", "x"], [2023, 2024], layout="lines")
    assert sorted(map(tuple, skipped.collect())) == [("bl1", 2024), ("bl2", 2024), ("x", 2023), ("x", 2024)]
    report = {tuple(r)[:2]: r.has_records for r in season_report(spark, root).collect()}
    assert report == {("bl1", 2023): True, ("bl2", 2023): False}
    counts = clean_records(spark, root, os.path.join(root, "clean"))
    assert counts["rows"] == 3 and set(counts) == {"rows", "no_league_name", "no_team_id_1", "no_team_id_2"}


def test_normalize_scans_its_feed_once(spark, tmp_dir):
    """The rows that the scans of the call read are those of the feed."""
    feed, root = _folders(tmp_dir, "feed", "out")
    with open(os.path.join(feed, "all.json"), "w", encoding="utf-8") as f:
        for i in range(50):
            f.write(json.dumps(_match(i, [FINAL], leagueShortcut=f"l{i % 4}")) + "\n")
    reads = []
    original = manifest.write_version

    def counted(df, *args, **kw):
        reads.append(df)
        return original(df, *args, **kw)

    from matchday.sources import sinks

    sinks.write_version = counted
    try:
        skipped = normalize_seasons(spark, feed, root, ["l0", "l9"], [2023], layout="lines")
    finally:
        sinks.write_version = original
    assert len(reads) == 1
    # the report holds no plan over the feed or the written table
    assert [tuple(r) for r in skipped.collect()] == [("l9", 2023)]
    assert skipped.inputFiles() == []


# --- incremental tables ---------------------------------------------------------------
def _day(d, t1, t2, g1, g2, season, league="bl1"):
    final = dict(FINAL, pointsTeam1=g1, pointsTeam2=g2)
    return _match(1000 * season + 100 * d + t1, [final, HALF], group={"groupName": f"{d}. Spieltag", "groupOrderID": d}, leagueShortcut=league,
                  team1={"teamId": t1, "teamName": f"T{t1}"}, team2={"teamId": t2, "teamName": f"T{t2}"}, leagueSeason=season,
                  leagueId=season, leagueName=f"1. Fußball-Bundesliga {season}/{season + 1}")


def test_only_changed_seasons_are_computed_again(spark, tmp_dir):
    feed, root = _folders(tmp_dir, "feed", "out")
    for season in (2021, 2022, 2023):
        _write(feed, f"bl1_{season}.json", [_day(1, 40, 7, 2, 0, season), _day(1, 9, 16, 1, 1, season), _day(2, 7, 9, 0, 3, season)])
    normalize_seasons(spark, feed, root)
    tables = os.path.join(root, "tables")
    first = refresh_tables(spark, root, tables)
    assert first == {n: [("bl1", s) for s in (2021, 2022, 2023)] for n in ("standings", "performance")}
    assert refresh_tables(spark, root, tables) == {"standings": [], "performance": []}

    _write(feed, "bl1_2022.json", [_day(1, 40, 7, 0, 4, 2022), _day(2, 7, 40, 1, 1, 2022)])
    normalize_seasons(spark, feed, root, leagues=["bl1"], seasons=[2022])
    old = {f for f in spark.read.parquet(os.path.join(tables, "standings")).inputFiles()}
    assert refresh_tables(spark, root, tables)["standings"] == [("bl1", 2022)]
    new = {f for f in spark.read.parquet(os.path.join(tables, "standings")).inputFiles()} - old
    assert new and all("leagueSeason=2022" in f for f in new)
    # nothing but the changed season's files is read for it
    read = scan_records(spark, root, seasons=[("bl1", 2022)])
    assert sorted({r[0] for r in read.select("leagueSeason").distinct().collect()}) == [2022]
    plan = read._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "2022" in plan

    clean = os.path.join(root, "clean")
    clean_records(spark, root, clean)
    from matchday.plans import create_performance

    for name, make in (("standings", create_standings), ("performance", create_performance)):
        make(spark, clean, os.path.join(root, f"full-{name}"))
        full = spark.read.parquet(os.path.join(root, f"full-{name}"))
        got = scan_refreshed(spark, tables, name)
        assert got.columns == full.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, full.collect()), key=repr)


def test_a_season_without_final_results_is_committed_empty(spark, tmp_dir):
    feed, root = _folders(tmp_dir, "feed", "out")
    tables = os.path.join(root, "tables")
    _write(feed, "bl1_2022.json", [_day(1, 40, 7, 2, 0, 2022)])
    normalize_seasons(spark, feed, root)
    refresh_tables(spark, root, tables, ["standings"])
    assert scan_refreshed(spark, tables, "standings").count() == 2
    _write(feed, "bl1_2022.json", [_match(5, [], leagueSeason=2022)])
    normalize_seasons(spark, feed, root)
    refresh_tables(spark, root, tables, ["standings"])
    assert scan_refreshed(spark, tables, "standings").count() == 0
    assert refresh_tables(spark, root, tables, ["standings"]) == {"standings": []}
