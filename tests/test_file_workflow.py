"""The file-based workflow end to end: season JSON files -> normalised -> clean -> tables -> features."""

import os

from matchday.plans import FeatureBuilder, clean_records, create_performance, create_standings, normalize_seasons
from matchday.plans.tables import performance, standings
from matchday.sources import mappers, read_mapper_csv
from matchday.sources.mappers import LEAGUE_MAPPER_CSV, TEAM_MAPPER_CSV
from test_normalize import FINAL, HALF, _match, _write


def _csv(tmp_dir, name, text):
    p = os.path.join(tmp_dir, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_csv_mappers_equal_defaults(spark, tmp_dir):
    lm = read_mapper_csv(spark, _csv(tmp_dir, "league.csv", LEAGUE_MAPPER_CSV), "league")
    tm = read_mapper_csv(spark, _csv(tmp_dir, "team.csv", TEAM_MAPPER_CSV), "team")
    assert sorted(map(tuple, lm.collect())) == sorted(map(tuple, mappers.league_mapper(spark).collect()))
    assert sorted(map(tuple, tm.collect())) == sorted(map(tuple, mappers.team_mapper(spark).collect()))


def test_file_workflow(spark, tmp_dir):
    feed_dir = os.path.join(tmp_dir, "feed")
    os.makedirs(feed_dir)

    def day(d, t1, t2, g1, g2, season=2023):
        final = dict(FINAL, pointsTeam1=g1, pointsTeam2=g2)
        return _match(100 * d + t1, [final, HALF], group={"groupName": f"{d}. Spieltag", "groupOrderID": d},
                      team1={"teamId": t1, "teamName": f"T{t1}"}, team2={"teamId": t2, "teamName": f"T{t2}"},
                      leagueSeason=season, leagueName=f"1. Fußball-Bundesliga {season}/{season + 1}")

    _write(feed_dir, "bl1_2023.json", [day(1, 40, 7, 2, 0), day(1, 9, 16, 1, 1), day(2, 7, 9, 0, 3), day(2, 16, 40, 1, 2)])
    _write(feed_dir, "bl1_2022.json", [day(1, 40, 7, 0, 0, season=2022)])
    out = os.path.join(tmp_dir, "data")

    skipped = normalize_seasons(spark, feed_dir, out, leagues=["bl1", "bl2"], seasons=[2023, 2024])
    assert sorted(map(tuple, skipped.collect())) == [("bl1", 2024), ("bl2", 2023), ("bl2", 2024)]

    clean_path = os.path.join(out, "matchResults_clean")
    lm = read_mapper_csv(spark, _csv(tmp_dir, "league.csv", LEAGUE_MAPPER_CSV), "league")
    clean_records(spark, out, clean_path, league_mapper=lm)
    cm = spark.read.parquet(clean_path)
    assert cm.count() == 8  # 4 games x (final + half time) of the requested season only
    assert set(r[0] for r in cm.select("league_name").distinct().collect()) == {"1. Fussball-Bundesliga"}

    st_path, pf_path = os.path.join(out, "standings"), os.path.join(out, "performance")
    create_standings(spark, clean_path, st_path)
    create_performance(spark, clean_path, pf_path)
    assert sorted(map(tuple, spark.read.parquet(st_path).collect()), key=repr) == sorted(
        map(tuple, standings(cm).collect()), key=repr)
    assert spark.read.parquet(pf_path).count() == performance(cm).count() == 8

    feat_path = os.path.join(out, "features")
    fb = FeatureBuilder(spark)
    got = fb.get_features(clean_path, {"overall_standings": st_path, "overall_performance": pf_path},
                          output_path=feat_path)
    written = spark.read.parquet(feat_path)
    assert written.columns == got.columns and written.count() == got.count() == 8
    r = written.filter("match_day = 2 AND team_id_1 = 9").collect()[0]
    # team 9 drew on day 1 (rank 2 behind team 40's win), team 7 lost (rank 4)
    assert (r.games_1, r.rank_1, r.games_2, r.rank_2, r.rank_diff) == (1, 2, 1, 4, -2)


def test_only_requested_season_files_are_read(spark, tmp_dir):
    feed_dir = os.path.join(tmp_dir, "feed")
    os.makedirs(feed_dir)
    _write(feed_dir, "bl1_2023.json", [_match(1, [FINAL])])
    # an unrequested season file that is not even valid JSON: it must never be parsed
    with open(os.path.join(feed_dir, "bl1_2021.json"), "w", encoding="utf-8") as f:
        f.write("{ not json")
    out = os.path.join(tmp_dir, "data")
    skipped = normalize_seasons(spark, feed_dir, out, leagues=["bl1"], seasons=[2023, 2024])
    assert sorted(map(tuple, skipped.collect())) == [("bl1", 2024)]
    back = spark.read.parquet(os.path.join(out, "matchResults"))
    assert back.count() == 1


def test_positional_result_path_order(spark, tmp_dir):
    from helpers import clean_rows
    from matchday.plans.tables import standings
    from test_tables import GAMES

    m = clean_rows(spark, GAMES)
    out = os.path.join(tmp_dir, "feat")
    got = FeatureBuilder(spark).get_features(m, out, {"overall_standings": standings(m)}, "result_class")
    assert got.count() == len(GAMES) and "rank_diff" in got.columns
    assert spark.read.parquet(out).count() == len(GAMES)


def _three_leagues(tmp_dir):
    feed_dir = os.path.join(tmp_dir, "feed")
    os.makedirs(feed_dir)
    for i, league in enumerate(("a", "b", "c")):
        _write(feed_dir, f"{league}_2023.json", [_match(i, [FINAL], leagueShortcut=league)])
    return feed_dir, os.path.join(tmp_dir, "data")


def test_a_meta_subset_keeps_other_seasons(spark, tmp_dir):
    from matchday.sources import scan_records

    feed_dir, out = _three_leagues(tmp_dir)
    for league in ("a", "b"):
        normalize_seasons(spark, feed_dir, out, leagues=[league], seasons=[2023], meta=["matchID"])
    assert sorted(r[0] for r in scan_records(spark, out).select("matchID").collect()) == [0, 1]


def test_one_list_alone_filters(spark, tmp_dir):
    from matchday.sources import scan_records

    feed_dir, out = _three_leagues(tmp_dir)
    assert normalize_seasons(spark, feed_dir, out, leagues=["a"]).count() == 0
    assert [r[0] for r in scan_records(spark, out).select("matchID").collect()] == [0]
    normalize_seasons(spark, feed_dir, out, seasons=[1999])
    assert scan_records(spark, out).count() == 1


def test_files_per_season_are_bounded(spark, tmp_dir):
    from matchday.operators.normalize import normalize
    from matchday.sources import read_feed, write_normalized

    feed_dir, out = _three_leagues(tmp_dir)
    many = normalize(read_feed(spark, feed_dir)).crossJoin(spark.range(400).select()).repartition(40)
    write_normalized(many, out)
    files = [f for f in spark.read.parquet(os.path.join(out, "matchResults")).inputFiles()]
    assert len(files) == 3


def test_season_files_of_one_folder(spark, tmp_dir):
    from matchday.operators.normalize import normalize
    from matchday.sources import read_feed, scan_season_files

    feed_dir, out = _three_leagues(tmp_dir)
    rows = normalize(read_feed(spark, feed_dir))
    rows.write.parquet(os.path.join(out, "x_2023_matchResults.parquet"))
    rows.write.parquet(os.path.join(out, "matchResults_clean.parquet"))
    assert scan_season_files(spark, out).count() == rows.count() == 3
