"""Plan shape: pushdown, pruning, broadcast lookups, one shuffle per window table, no Python."""

import os

from helpers import clean_rows
from matchday.operators.conform import clean
from matchday.plans.tables import performance, standings
from matchday.sources import mappers
from matchday.testing.planinfo import plan_text
from test_tables import GAMES

SF = "/root/testdata/sf0.001"


def _clean_parquet(spark, tmp_dir):
    p = os.path.join(tmp_dir, "clean")
    clean_rows(spark, GAMES).write.parquet(p)
    return spark.read.parquet(p)


def test_performance_one_scan_one_shuffle(spark, tmp_dir):
    plan = plan_text(performance(_clean_parquet(spark, tmp_dir)), "simple")
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Generate inline" in plan  # both sides from one scan, no union
    assert "Union" not in plan
    # the final-result filter reaches the scan; only needed columns are read
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "EqualTo(result_name,Endergebnis)" in scan.split("PushedFilters:")[1]
    read_cols = scan.split("FileScan parquet [")[1].split("]")[0]
    assert "league_name" not in read_cols and "season_name" not in read_cols


def test_standings_two_shuffles(spark, tmp_dir):
    plan = plan_text(standings(_clean_parquet(spark, tmp_dir)), "simple")
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 2


def test_clean_is_map_only_with_broadcast_lookups(spark):
    import __spark_entry__ as E

    plan = plan_text(E.queries()["clean_matches"](spark, SF), "simple")
    assert plan.count("BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in plan
    assert "PushedFilters" in plan


def test_no_python_evaluation_in_any_query(spark):
    import __spark_entry__ as E

    skip = {"scan_match_feed", "scan_records_glob", "stream_match_results", "merged_seasons"}  # write while being built
    for name, fn in E.queries().items():
        if name in skip or name in ("half_sample", "result_class_base_view", "features_result_class"):
            continue
        plan = plan_text(fn(spark, SF), "simple")
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_features_shuffle_base_once_per_team(spark):
    import __spark_entry__ as E

    # at scale the lookups exceed the broadcast threshold: plan the shuffle joins
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(E.queries()["features_goals"](spark, SF), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    base_exchanges = [l for l in plan.splitlines() if "Exchange hashpartitioning(league_id" in l and "_salt_" in l]
    assert len(base_exchanges) == 2
    assert plan.count("SortMergeJoin") == 4
    # one exchange per lookup table; the second team's join reuses it at runtime
    lookup_exchanges = {l.split("Exchange")[1].split("[plan_id")[0] for l in plan.splitlines()
                        if "Exchange hashpartitioning(_lk_league" in l}
    assert len(lookup_exchanges) >= 1


def _many_leagues(spark, tmp_dir):
    """Thirty leagues, some with unmapped teams, repeated match rows, null days and two games of a team on a day."""
    games, mid = [], 0
    for league in range(30):
        for day in range(1, 7):
            for t1, t2 in ((1, 2), (3, 4), (None, 5 + league % 3), (None, None)):
                mid += 1
                games.append((mid, league if league else None, day if mid % 41 else None, t1, t2, (mid * 7) % 5, (mid * 3) % 4))
        games.append((mid, league, 3, 1, 4, 2, 2))
        games.append(games[-2])
    p = os.path.join(tmp_dir, "many")
    clean_rows(spark, games).write.parquet(p)
    return spark.read.parquet(p)


def test_features_of_matches_equal_the_joins(spark, tmp_dir):
    from matchday.plans.features import FeatureBuilder
    from matchday.plans.tables import team_tables

    m = _many_leagues(spark, tmp_dir)
    fb = FeatureBuilder(spark, seed="s")
    st, pf = team_tables(m)
    for target in ("goals", "result_class"):
        for steps in (("overall_standings", "overall_performance"), ("overall_performance",), ("overall_standings",)):
            tables = {"overall_standings": st, "overall_performance": pf}
            want = fb.get_features(m, {s: tables[s] for s in steps}, target=target)
            got = fb.match_features(m, steps, target=target)
            assert "Join" not in plan_text(got, "simple")
            assert got.columns == want.columns
            assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_features_of_matches_take_one_exchange(spark, tmp_dir):
    from matchday.plans.features import FeatureBuilder

    m = _many_leagues(spark, tmp_dir)
    plan = plan_text(FeatureBuilder(spark).match_features(m), "simple")
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan parquet") == 1


def test_features_of_matches_take_more_tasks_for_more_rows(spark, tmp_dir, monkeypatch):
    from matchday.plans import features

    m, fb = _many_leagues(spark, tmp_dir), features.FeatureBuilder(spark)
    want = fb.match_features(m)
    monkeypatch.setattr(features, "PANEL_TASK_ROWS", 20)
    for target in ("goals", "result_class"):
        got = fb.match_features(m, target=target)
        plan = plan_text(got, "simple")
        assert "Exchange hashpartitioning(league_id" in plan and f", {2 * 30 * 26 // 20}), REPARTITION_BY_NUM" in plan
        assert plan.count("Exchange hashpartitioning") == 1
    got = fb.match_features(m)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_large_standings_of_many_leagues_take_one_shuffle(spark, tmp_dir, monkeypatch):
    from matchday.plans import tables
    from matchday.sources.tables import with_row_bound

    m = _many_leagues(spark, tmp_dir)
    want = standings(m, hot_threshold=None)
    monkeypatch.setattr(tables, "task_slots", lambda spark: 8)
    # a bound above the threshold, though no league has so many rows
    got = standings(with_row_bound(m, 30 * 26), hot_threshold=100)
    plan = plan_text(got, "simple")
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_hot_keys_are_counted_within_large_leagues_only(spark, tmp_dir, monkeypatch):
    from matchday.operators import skew

    m, written = _many_leagues(spark, tmp_dir), []
    monkeypatch.setattr(skew, "materialize", lambda df, *a, f=skew.materialize, **k: written.append(a) or f(df, *a, **k))
    groups = [("league_id", "match_day"), ("league_id", "team_id_1")]
    assert skew.find_hot(m, groups, 26) == [None, None] and not written
    days, teams = skew.find_hot(m, groups, 4)
    assert written and days is not None and {r.league_id for r in teams.table.collect()} >= {1, 2}
    assert days.keys == m.groupBy("league_id", "match_day").count().where("count > 4").count()


def test_few_or_hot_leagues_take_the_joins(spark, tmp_dir):
    from matchday.plans.features import FeatureBuilder

    fb = FeatureBuilder(spark)
    few = fb.match_features(_clean_parquet(spark, tmp_dir))
    hot = fb.match_features(_many_leagues(spark, tmp_dir), hot_threshold=10)
    for df in (few, hot):
        assert "Join" in plan_text(df, "simple")
    assert hot.exceptAll(fb.match_features(_many_leagues(spark, os.path.join(tmp_dir, "again")))).count() == 0


def test_bucketed_team_tables_are_not_shuffled(spark, tmp_dir):
    from matchday.plans import FeatureBuilder, create_performance, create_standings

    paths = [os.path.join(tmp_dir, n) for n in ("clean", "st", "pf")]
    _many_leagues(spark, tmp_dir).write.parquet(paths[0])
    plain = [os.path.join(tmp_dir, n) for n in ("st-plain", "pf-plain")]
    for i, make in enumerate((create_standings, create_performance)):
        make(spark, paths[0], paths[1 + i], buckets=8)
        make(spark, paths[0], plain[i])
    steps = ("overall_standings", "overall_performance")
    fb = FeatureBuilder(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = fb.get_features(paths[0], dict(zip(steps, paths[1:])))
        plan = plan_text(got, "simple")
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        # the base is shuffled once for each team, the bucketed tables not at all
        assert len(exchanges) == 2 and all("_team_" in x for x in exchanges)
        want = fb.get_features(paths[0], dict(zip(steps, plain)))
        assert got.columns == want.columns and got.count() == want.count() and got.exceptAll(want).count() == 0
        got = fb.get_features(paths[0], dict(zip(steps, paths[1:])), "result_class")
        want = fb.get_features(paths[0], dict(zip(steps, plain)), "result_class")
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_known_rows_plan_no_hot_branch(spark, tmp_dir):
    from matchday.session import materialize
    from matchday.sources.tables import distinct_values, row_bound

    m = materialize(_many_leagues(spark, tmp_dir), "clean", distinct="league_id")
    assert row_bound(m) == 30 * 26 and distinct_values(m, "league_id") == 30
    assert plan_text(standings(m), "simple").count("FileScan parquet") == 1
