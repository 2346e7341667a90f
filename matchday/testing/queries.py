"""Registered queries: each runs one operator (and what it depends on) over the
feed derived from the driver's tables at ``sf_dir``.

Every query reads the whole ``orders`` (and ``lineitem`` for goals) table;
nothing is subset or capped. Nested feed paths use ``_`` in output names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.conform import clean, conform_leagues, conform_teams, unmapped_teams
from ..operators.metrics import mean_poisson_deviance, mean_tip_score
from ..operators.normalize import flatten, normalize
from ..operators.normalize import seasons_without_records as _seasons_without_records
from ..operators.panels import STANDINGS_KEYS, running_totals
from ..operators.sampling import half_sample
from ..operators.skew import shuffle_width
from ..operators.views import goals_base_view, load_match_results, result_class_base_view, team_view
from ..functions.features import suffix_alias
from ..functions.predicates import not_excluded_league
from ..functions.scoring import tip_score
from ..plans.features import FeatureBuilder
from ..plans.cleaning import clean_records
from ..plans.ingest import normalize_seasons
from ..plans.refresh import refresh_tables, scan_refreshed
from ..plans.tables import create_performance, create_standings, performance, standings
from ..schemas import META_COLUMNS, PERFORMANCE_METRICS, meta_name
from ..session import materialize, scratch_path
from ..sources import mappers, testdata
from ..sources.feed import (
    annotate_requests,
    available_seasons as _available,
    catalogue_from_files,
    feed_catalogue,
    read_feed,
    request_grid,
    scan_records,
    scan_season_files,
    season_report,
    skipped_seasons as _skipped,
)
from ..sources.sinks import write_feed_lines, write_normalized
from ..sources.tables import row_bound

SEP = "_"
META = [meta_name(m, SEP) for m in META_COLUMNS]
META_SUBSET = ["matchID", "leagueId", "group.groupOrderID", "team1.teamId", "team2.teamId"]
FEATURE_SUBSET = ["match_id", "league_name_raw", "season_name", "team_id_1", "no_such_feature"]
REQUEST_LEAGUES = [f"l{i}" for i in range(10)]
REQUEST_SEASONS = list(range(2000, 2010))
# Seasons that a request over the feed's own span asks for beyond it.
ABSENT_SEASONS = 2
METRIC_DIGITS = 9


# --- shared stages ------------------------------------------------------------
def _feed(spark: SparkSession, sf: str, goals: bool = False) -> DataFrame:
    return testdata.match_feed(spark, sf, with_goals=goals)


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return normalize(_feed(spark, sf), "matchResults", separator=SEP)


def _clean(spark: SparkSession, sf: str, features=None) -> DataFrame:
    kw = {} if features is None else {"features": features}
    return clean(
        _records(spark, sf), mappers.league_mapper(spark), testdata.team_mapper(spark), separator=SEP, **kw
    )


def _final(spark: SparkSession, sf: str) -> DataFrame:
    return load_match_results(_clean(spark, sf))


def _clean_table(spark: SparkSession, sf: str) -> DataFrame:
    """The clean match table written once and scanned by every branch that needs it."""
    return materialize(_clean(spark, sf), "clean-matches", distinct="league_id")


def _with_elements(df: DataFrame, records: str) -> DataFrame:
    """The kept record list of flattened matches, one row per element with all its values."""
    return df.select(*[F.col(f"`{c}`") for c in META], F.inline_outer(records))


# --- sources ------------------------------------------------------------------
def scan_match_feed(spark, sf):
    """Write the feed as JSON Lines, scan it back with the declared schema."""
    path = scratch_path(spark, "feed-json")
    write_feed_lines(_feed(spark, sf, goals=True), path)
    return _with_elements(flatten(read_feed(spark, path, layout="lines"), separator=SEP), "goals")


def _write_arrays(feed: DataFrame, path: str) -> None:
    """One JSON array per league season (a few hundred matches each), in a folder of its own."""
    seasons = feed.groupBy("leagueShortcut", "leagueSeason").agg(F.collect_list(F.struct(*feed.columns)).alias("m"))
    seasons.select(
        F.concat_ws("_", "leagueShortcut", "leagueSeason").alias("season"), F.to_json("m").alias("value")
    ).write.partitionBy("season").text(path)


def scan_feed_arrays(spark, sf):
    """One JSON array per league season, scanned as the feed serves it."""
    path = scratch_path(spark, "feed-arrays")
    _write_arrays(_feed(spark, sf), path)
    return _with_elements(flatten(read_feed(spark, path, layout="array"), separator=SEP), "matchResults")


def scan_season_files_q(spark, sf):
    """Season files named by league, season and record kind in one folder."""
    root = scratch_path(spark, "season-files")
    records = _records(spark, sf)
    for odd in (0, 1):
        records.filter(F.col("leagueSeason") % 2 == odd).write.parquet(f"{root}/all_{odd}_matchResults.parquet")
    records.limit(0).write.parquet(f"{root}/matchResults_clean.parquet")
    return scan_season_files(spark, root, "matchResults", separator=SEP)


def scan_records_glob(spark, sf):
    """Normalised results written per league season, scanned back in one read."""
    root = scratch_path(spark, "records")
    write_normalized(_records(spark, sf), root, "matchResults")
    return scan_records(spark, root, "matchResults", separator=SEP)


def request_grid_q(spark, sf):
    """The requested leagues x seasons, each flagged available (processed) or not (skipped)."""
    grid = request_grid(spark, REQUEST_LEAGUES, REQUEST_SEASONS)
    return annotate_requests(grid, feed_catalogue(_feed(spark, sf)))


def stream_match_results(spark, sf):
    """Streaming ingest: feed files landed as JSON Lines, normalised by an availableNow query."""
    from ..streaming import normalize_stream

    landing = scratch_path(spark, "landing")
    out_root = scratch_path(spark, "streamed")
    write_feed_lines(_feed(spark, sf), landing)
    q = normalize_stream(spark, landing, out_root, separator=SEP, layout="lines")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"streaming ingest failed: {q.exception()}")
    return scan_records(spark, out_root, "matchResults", separator=SEP)


def available_seasons(spark, sf):
    grid = request_grid(spark, REQUEST_LEAGUES, REQUEST_SEASONS)
    return _available(grid, feed_catalogue(_feed(spark, sf)))


def skipped_seasons(spark, sf):
    grid = request_grid(spark, REQUEST_LEAGUES, REQUEST_SEASONS)
    return _skipped(grid, feed_catalogue(_feed(spark, sf)))


# --- normalisation ------------------------------------------------------------
def flatten_feed(spark, sf):
    return _with_elements(flatten(_feed(spark, sf), separator=SEP), "matchResults")


def _span(feed: DataFrame) -> list[int]:
    """The seasons from the feed's first to its last, and some that it lacks: one row reaches the driver."""
    first, last = feed.agg(F.min("leagueSeason"), F.max("leagueSeason")).first()
    return list(range(first, last + 1 + ABSENT_SEASONS))


_NORMALIZED = ("matchID", "leagueShortcut", "leagueSeason", "team1_teamId", "resultID", "resultName", "pointsTeam1", "pointsTeam2")


def normalize_seasons_q(spark, sf):
    """The many-season driver on a feed folder, by two calls with another meta list each, over the feed's span."""
    feed, out = scratch_path(spark, "feed-json"), scratch_path(spark, "seasons")
    matches = _feed(spark, sf)
    write_feed_lines(matches, feed)
    half, seasons = len(REQUEST_LEAGUES) // 2, _span(matches)
    for leagues, meta in ((REQUEST_LEAGUES[:half], META_SUBSET), (REQUEST_LEAGUES[half:], "all")):
        normalize_seasons(spark, feed, out, leagues, seasons, meta=meta, layout="lines", separator=SEP)
    return scan_records(spark, out, "matchResults", separator=SEP).select(*_NORMALIZED)


def _season_files(spark, sf) -> str:
    """The feed in its native layout: one file ``{league}_{season}.json`` for each league season, an array of matches."""
    path, out = scratch_path(spark, "feed-folders"), scratch_path(spark, "feed-files")
    _write_arrays(_feed(spark, sf), path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop(out))
    # as many renames as there are league seasons
    for f in fs.globStatus(hadoop(f"{path}/season=*/part-*")):
        season = f.getPath().getParent().getName().split("=", 1)[1]
        fs.rename(f.getPath(), hadoop(f"{out}/{season}.json"))
    return out


def season_files_report(spark, sf):
    """S8, file variant: the requested grid against the season files of a folder."""
    grid = request_grid(spark, REQUEST_LEAGUES, _span(_feed(spark, sf)))
    return annotate_requests(grid, catalogue_from_files(spark, _season_files(spark, sf)))


def normalize_season_files(spark, sf):
    """The many-season driver on season files, each one JSON array."""
    out = scratch_path(spark, "seasons")
    normalize_seasons(spark, _season_files(spark, sf), out, REQUEST_LEAGUES, _span(_feed(spark, sf)), separator=SEP)
    return scan_records(spark, out, "matchResults", separator=SEP).select(*_NORMALIZED)


def season_report_q(spark, sf):
    """P4 from the log of the write: each season and whether it has records."""
    out = scratch_path(spark, "records")
    write_normalized(_records(spark, sf), out, "matchResults")
    return season_report(spark, out).select("leagueShortcut", "leagueSeason", (~F.col("has_records")).alias("no_records"))


def merged_seasons(spark, sf):
    """A season's batch write, then a stream that adds to it, then a batch rewrite of some seasons."""
    from ..streaming import normalize_stream

    out, landing = scratch_path(spark, "records"), scratch_path(spark, "landing")
    records, feed = _records(spark, sf), _feed(spark, sf)
    write_normalized(records.filter("matchID % 3 <> 0"), out, "matchResults")
    # matches that the batch lacks, and some that it has
    write_feed_lines(feed.filter("matchID % 3 = 0 OR matchID % 7 = 0"), landing)
    q = normalize_stream(spark, landing, out, separator=SEP, layout="lines")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"streaming ingest failed: {q.exception()}")
    write_normalized(records.filter("leagueSeason % 4 = 1 AND matchID % 5 <> 0"), out, "matchResults")
    return scan_records(spark, out, "matchResults", separator=SEP)


def _refreshed(spark, sf, name: str) -> DataFrame:
    """X3/X4 season by season: tables of a part of the matches, then brought up to a later commit of some seasons."""
    records, root, out = _records(spark, sf), scratch_path(spark, "records"), scratch_path(spark, "tables")
    write_normalized(records.filter("leagueSeason % 3 <> 0 OR matchID % 2 = 0"), root, "matchResults")
    mapper = testdata.team_mapper(spark)
    refresh_tables(spark, root, out, [name], team_mapper=mapper, separator=SEP)
    write_normalized(records.filter("leagueSeason % 3 = 0"), root, "matchResults")
    refresh_tables(spark, root, out, [name], team_mapper=mapper, separator=SEP)
    return scan_refreshed(spark, out, name)


def standings_refreshed(spark, sf):
    return _refreshed(spark, sf, "standings")


def performance_refreshed(spark, sf):
    return _refreshed(spark, sf, "performance")


def normalize_match_results(spark, sf):
    return _records(spark, sf)


def normalize_goals(spark, sf):
    return normalize(_feed(spark, sf, goals=True), "goals", separator=SEP)


def normalize_meta_subset(spark, sf):
    return normalize(_feed(spark, sf), "matchResults", meta=META_SUBSET, separator=SEP)


def seasons_without_records(spark, sf):
    return _seasons_without_records(_feed(spark, sf), "matchResults")


def filter_excluded_leagues(spark, sf):
    return _records(spark, sf).filter(not_excluded_league())


# --- clean / conform ----------------------------------------------------------
def conform_leagues_q(spark, sf):
    out = conform_leagues(_records(spark, sf), mappers.league_mapper(spark))
    return out.select("matchID", "resultID", "leagueName", "league_name_raw", "league_name_unique")


def conform_teams_q(spark, sf):
    out = conform_teams(_records(spark, sf), testdata.team_mapper(spark), separator=SEP)
    return out.select("matchID", "resultID", "team1_teamId", "team2_teamId", "team_id_unique_1", "team_id_unique_2")


def conform_teams_csv(spark, sf):
    """The default 95-row team mapper, read from its CSV file."""
    path = scratch_path(spark, "team-mapper")
    lines = mappers.TEAM_MAPPER_CSV.strip().splitlines()
    spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string").orderBy("i").coalesce(1).select("value").write.text(path)
    out = conform_teams(_records(spark, sf), mappers.read_mapper_csv(spark, path, "team"), separator=SEP)
    return out.select("matchID", "resultID", "team1_teamId", "team2_teamId", "team_id_unique_1", "team_id_unique_2")


def unmapped_teams_q(spark, sf):
    return unmapped_teams(_records(spark, sf), testdata.team_mapper(spark), separator=SEP)


def clean_matches(spark, sf):
    return _clean(spark, sf)


def clean_sink(spark, sf):
    """Season folders in, the written clean table out."""
    root, path = scratch_path(spark, "records"), scratch_path(spark, "clean")
    write_normalized(_records(spark, sf), root, "matchResults")
    clean_records(spark, root, path, team_mapper=testdata.team_mapper(spark), separator=SEP)
    return spark.read.parquet(path)


def suffix_rename(spark, sf):
    """The suffix that the feature joins give to a team's columns."""
    names = ["match_day", "goals_team_1", "goals_team_2"]
    return _clean(spark, sf).select("match_id", "result_name", *suffix_alias(names, "_1"), suffix_alias("league_id", "_1"))


def clean_feature_subset(spark, sf):
    return _clean(spark, sf, features=FEATURE_SUBSET)


def goals_features(spark, sf):
    return _clean(spark, sf, features=["match_id", "result_name", "goals_team_1", "goals_team_2", "goals_diff"])


def points_features(spark, sf):
    return _clean(spark, sf, features=["match_id", "result_name", "points_team_1", "points_team_2"])


def result_class_q(spark, sf):
    return _clean(spark, sf, features=["match_id", "result_name", "result_class"])


def league_name_split(spark, sf):
    return _clean(spark, sf, features=["match_id", "result_name", "league_name_raw", "season_name", "league_name"])


def final_results(spark, sf):
    return _final(spark, sf)


# --- views --------------------------------------------------------------------
def team_view_overall(spark, sf):
    return team_view(_final(spark, sf), "overall")


def team_view_home(spark, sf):
    return team_view(_final(spark, sf), "home")


def team_view_away(spark, sf):
    return team_view(_final(spark, sf), "away")


def goals_base_view_q(spark, sf):
    return goals_base_view(_final(spark, sf))


def result_class_base_view_q(spark, sf):
    # the sample's cut is found by two light passes over the ids: read them from a written table
    return result_class_base_view(load_match_results(_clean_table(spark, sf)))


def half_sample_q(spark, sf):
    finals = load_match_results(_clean_table(spark, sf))
    return half_sample(finals.select("match_id"), "match_id", rows=row_bound(finals))


# --- windows ------------------------------------------------------------------
def running_totals_q(spark, sf):
    return running_totals(team_view(load_match_results(_clean_table(spark, sf)), "overall"), carry=STANDINGS_KEYS)


def table_rank_q(spark, sf):
    return standings(_clean_table(spark, sf)).select("league_id", "match_day", "team_id", "rank")


def _perf_subset(spark, sf, suffix: str):
    p = performance(_clean_table(spark, sf))
    return p.select("match_id", "league_id", "match_day", "team_id", *[f"{m}{suffix}" for m in PERFORMANCE_METRICS])


def rolling_3(spark, sf):
    return _perf_subset(spark, sf, "_last_3_games")


def rolling_5(spark, sf):
    return _perf_subset(spark, sf, "_last_5_games")


def running_avg(spark, sf):
    return _perf_subset(spark, sf, "_avg")


def standings_overall(spark, sf):
    return standings(_clean_table(spark, sf), "overall")


def standings_home(spark, sf):
    return standings(_clean_table(spark, sf), "home")


def standings_away(spark, sf):
    return standings(_clean_table(spark, sf), "away")


def performance_overall(spark, sf):
    return performance(_clean_table(spark, sf), "overall")


def performance_home_away(spark, sf):
    return performance(_clean_table(spark, sf), "home_away")


def _written(spark, sf, create) -> DataFrame:
    matches, out = scratch_path(spark, "clean-matches"), scratch_path(spark, "table")
    _clean(spark, sf).write.parquet(matches)
    create(spark, matches, out)
    return spark.read.parquet(out)


def standings_sink(spark, sf):
    """The path-level wrapper, from a written clean table to written standings."""
    return _written(spark, sf, create_standings)


def performance_sink(spark, sf):
    return _written(spark, sf, create_performance)


# A threshold that the null panels and most match days of the test feed exceed: the split path, checked like the plain one.
# Segments are so small that many panels are cut.
LOW_HOT_ROWS, SHORT_SEGMENT = 12, 5_000


def standings_hot(spark, sf):
    return standings(_clean_table(spark, sf), "overall", hot_threshold=LOW_HOT_ROWS, segment_rows=SHORT_SEGMENT)


def performance_hot(spark, sf):
    return performance(_clean_table(spark, sf), "overall", hot_threshold=LOW_HOT_ROWS, segment_rows=SHORT_SEGMENT)


# --- features -----------------------------------------------------------------
def _features(spark, sf, step: str, target: str) -> DataFrame:
    """One step, from its table, joined on the previous match day."""
    cm = _clean_table(spark, sf)
    tables = {"overall_standings": standings, "overall_performance": performance}
    return FeatureBuilder(spark).get_features(cm, {step: tables[step](cm)}, target=target)


def features_bucketed(spark, sf):
    """X5 at path level, on team tables that were written in buckets."""
    paths = [scratch_path(spark, name) for name in ("clean-matches", "standings", "performance")]
    _clean(spark, sf).write.parquet(paths[0])
    create_standings(spark, paths[0], paths[1], buckets=shuffle_width(spark))
    create_performance(spark, paths[0], paths[2], buckets=shuffle_width(spark))
    return FeatureBuilder(spark).get_features(paths[0], {"overall_standings": paths[1], "overall_performance": paths[2]})


def add_overall_standings(spark, sf):
    return _features(spark, sf, "overall_standings", "goals")


def add_overall_performance(spark, sf):
    return _features(spark, sf, "overall_performance", "goals")


def features_goals(spark, sf):
    return FeatureBuilder(spark).match_features(_clean_table(spark, sf), target="goals")


def features_result_class(spark, sf):
    return FeatureBuilder(spark).match_features(_clean_table(spark, sf), target="result_class")


# --- evaluation ---------------------------------------------------------------
def _scored(spark, sf) -> DataFrame:
    truth = _final(spark, sf).select(
        "match_id", F.col("goals_team_1").alias("t1"), F.col("goals_team_2").alias("t2")
    )
    return truth.join(testdata.predictions(spark, sf), "match_id")


def tip_score_q(spark, sf):
    j = _scored(spark, sf)
    return j.select(
        "match_id",
        "t1",
        "t2",
        F.col("pred_goals_1").alias("p1"),
        F.col("pred_goals_2").alias("p2"),
        tip_score("t1", "t2", "pred_goals_1", "pred_goals_2").alias("tip_score"),
    )


def mean_tip_score_q(spark, sf):
    return mean_tip_score(_scored(spark, sf), "t1", "t2", "pred_goals_1", "pred_goals_2")


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(c), METRIC_DIGITS).alias(c) for c in df.columns])


def poisson_deviance(spark, sf):
    return _rounded(mean_poisson_deviance(testdata.deviance_input(spark, sf), [("y", "mu")]))


def multi_poisson_deviance(spark, sf):
    return _rounded(mean_poisson_deviance(_scored(spark, sf), [("t1", "mu_1"), ("t2", "mu_2")]))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_match_feed": scan_match_feed,
    "scan_records_glob": scan_records_glob,
    "scan_feed_arrays": scan_feed_arrays,
    "scan_season_files": scan_season_files_q,
    "normalize_seasons": normalize_seasons_q,
    "normalize_season_files": normalize_season_files,
    "season_files_report": season_files_report,
    "season_report": season_report_q,
    "merged_seasons": merged_seasons,
    "standings_refreshed": standings_refreshed,
    "performance_refreshed": performance_refreshed,
    "conform_teams_csv": conform_teams_csv,
    "clean_sink": clean_sink,
    "suffix_rename": suffix_rename,
    "standings_sink": standings_sink,
    "performance_sink": performance_sink,
    "stream_match_results": stream_match_results,
    "request_grid": request_grid_q,
    "available_seasons": available_seasons,
    "skipped_seasons": skipped_seasons,
    "flatten_feed": flatten_feed,
    "normalize_match_results": normalize_match_results,
    "normalize_goals": normalize_goals,
    "normalize_meta_subset": normalize_meta_subset,
    "seasons_without_records": seasons_without_records,
    "filter_excluded_leagues": filter_excluded_leagues,
    "conform_leagues": conform_leagues_q,
    "conform_teams": conform_teams_q,
    "unmapped_teams": unmapped_teams_q,
    "clean_matches": clean_matches,
    "clean_feature_subset": clean_feature_subset,
    "goals_features": goals_features,
    "points_features": points_features,
    "result_class": result_class_q,
    "league_name_split": league_name_split,
    "final_results": final_results,
    "team_view_overall": team_view_overall,
    "team_view_home": team_view_home,
    "team_view_away": team_view_away,
    "goals_base_view": goals_base_view_q,
    "result_class_base_view": result_class_base_view_q,
    "half_sample": half_sample_q,
    "running_totals": running_totals_q,
    "table_rank": table_rank_q,
    "rolling_3": rolling_3,
    "rolling_5": rolling_5,
    "running_avg": running_avg,
    "standings_overall": standings_overall,
    "standings_home": standings_home,
    "standings_away": standings_away,
    "performance_overall": performance_overall,
    "performance_home_away": performance_home_away,
    "standings_hot": standings_hot,
    "performance_hot": performance_hot,
    "add_overall_standings": add_overall_standings,
    "add_overall_performance": add_overall_performance,
    "features_goals": features_goals,
    "features_bucketed": features_bucketed,
    "features_result_class": features_result_class,
    "tip_score": tip_score_q,
    "mean_tip_score": mean_tip_score_q,
    "poisson_deviance": poisson_deviance,
    "multi_poisson_deviance": multi_poisson_deviance,
}
