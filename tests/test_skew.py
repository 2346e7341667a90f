"""Hot window partitions: the split path equals the plain window path exactly."""

import pytest
from pyspark.sql import functions as F

from helpers import clean_rows
from matchday.operators.panels import performance_stats, running_totals, table_rank
from matchday.operators.views import team_view
from test_tables import GAMES


def _bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def skewed(spark):
    # one hot panel: 300 games of unmapped teams (null id) in league 10, plus normal teams
    games = list(GAMES)
    mid = 100
    for day in range(1, 61):
        for j in range(5):
            g1, g2 = (day + j) % 4, (day * j) % 3
            games.append((mid, 10, day, None, 1000 + j, g1, g2 if j != 4 else None))
            mid += 1
    return team_view(clean_rows(spark, games))


def test_running_totals_split_equals_window(spark, skewed):
    plain = running_totals(skewed, hot_threshold=None)
    split = running_totals(skewed, hot_threshold=100)
    assert plain.columns == split.columns
    assert _bag(plain) == _bag(split)


def test_performance_split_equals_window(spark, skewed):
    plain = performance_stats(skewed, hot_threshold=None)
    split = performance_stats(skewed, hot_threshold=100)
    assert plain.columns == split.columns
    a, b = _bag(plain), _bag(split)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == pytest.approx(y) if all(isinstance(v, (int, float, type(None))) for v in x) else x == y


def test_rank_split_equals_window(spark, skewed):
    totals = running_totals(skewed, hot_threshold=None)
    plain = table_rank(totals, hot_threshold=None)
    split = table_rank(totals, over=("league_id", "match_day"), hot_threshold=3)
    assert _bag(plain) == _bag(split)


def test_hot_path_is_used(spark, skewed):
    from matchday.operators.skew import hot_keys

    assert [tuple(r) for r in hot_keys(skewed, ["league_id", "team_id"], 100).collect()] == [(10, None)]


def test_standings_plan_split_equals_plain(spark):
    from matchday.plans.tables import standings

    games = list(GAMES) + [(200 + i, 10, 1 + i % 6, None, 3000 + i, i % 3, i % 2) for i in range(40)]
    m = clean_rows(spark, games)
    assert _bag(standings(m, hot_threshold=None)) == _bag(standings(m, hot_threshold=5))


BIG = 400_000


def _big(spark, tmp_path_factory, match_id):
    """All rows in one panel, with every column different, on several input files."""
    i = F.col("id")
    path = str(tmp_path_factory.mktemp("panel") / "rows")
    spark.range(0, BIG, numPartitions=8).select(
        match_id.alias("match_id"), F.lit(7).cast("bigint").alias("league_id"), F.lit("L").alias("league_name"), F.lit("S").alias("season_name"),
        (i % 997).alias("match_day"), F.lit(None).cast("bigint").alias("team_id"), F.concat(F.lit("T"), i % 31).alias("team_name"),
        (i % 2).cast("int").alias("home_team"), F.lit(1).alias("games"),
        *[(i * p % 5).cast("int").alias(c) for c, p in (("wins", 3), ("draws", 7), ("losses", 11))],
        *[F.when(i % 23 != 0, i * p % 9).alias(c) for c, p in (("goals_scored", 5), ("goals_conceded", 13), ("goals_diff", 17))],
        (i * 19 % 4).cast("int").alias("points"),
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def one_big_panel(spark, tmp_path_factory):
    return _big(spark, tmp_path_factory, F.col("id"))


@pytest.fixture(scope="module")
def hashed_panel(spark, tmp_path_factory):
    return _big(spark, tmp_path_factory, F.xxhash64("id"))


@pytest.mark.parametrize("sample", ["1", "100"])
def test_full_rows_of_a_large_panel(spark, one_big_panel, sample):
    name = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    before = spark.conf.get(name, None)
    spark.conf.set(name, sample)
    try:
        for f in (running_totals, performance_stats):
            plain, split = f(one_big_panel, hot_threshold=None), f(one_big_panel, hot_threshold=100_000, segment_rows=30_000)
            assert plain.count() == split.count() == BIG
            assert plain.exceptAll(split).count() == 0
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_sparse_ids_and_bounded_segments(spark, hashed_panel):
    from matchday.operators.skew import CARRIED, SEGMENT, in_segments

    for f in (running_totals, performance_stats):
        plain, split = f(hashed_panel, hot_threshold=None), f(hashed_panel, hot_threshold=100_000, segment_rows=20_000)
        assert plain.exceptAll(split).count() == 0 and split.count() == BIG
    order = [F.col(c).asc_nulls_first() for c in ("match_day", "match_id", "home_team")]
    seg, _ = in_segments(hashed_panel, ["league_id", "team_id"], order, ["points"], back=4, segment_rows=20_000)
    sizes = seg.groupBy(SEGMENT).agg(F.count_if(~F.col(CARRIED)).alias("n"), F.count_if(CARRIED).alias("c")).collect()
    assert max(r.n for r in sizes) <= 20_000 and len(sizes) >= BIG // 20_000
    assert max(r.c for r in sizes) == 4


@pytest.mark.parametrize("segment_rows", [1, 2, 3, 7])
def test_segments_shorter_than_the_frames(spark, skewed, segment_rows):
    for f in (running_totals, performance_stats):
        plain, split = f(skewed, hot_threshold=None), f(skewed, hot_threshold=100, segment_rows=segment_rows)
        assert plain.exceptAll(split).count() == 0 and split.count() == plain.count()


def test_hot_day_is_ranked_over_segments(spark, hashed_panel):
    rows = hashed_panel.withColumn("match_day", F.lit(3)).withColumn("goals_scored", F.xxhash64("match_id"))
    plain, split = table_rank(rows, hot_threshold=None), table_rank(rows, hot_threshold=1_000, segment_rows=25_000)
    assert plain.exceptAll(split).count() == 0 and split.count() == BIG


def test_a_known_bound_spares_the_count(spark, skewed):
    from matchday.operators.skew import find_hot
    from matchday.sources.tables import with_row_bound

    known = with_row_bound(skewed.select("*"), 700)
    assert find_hot(known, [["team_id"]], 700) == [None]
    hot = find_hot(known, [["team_id"], ["league_id", "match_day"]], 100)
    assert hot[0].keys == 1 and hot[0].rows == 300 and hot[1] is None
    assert find_hot(known, [["team_id"]], None) == [None]


def test_order_of_matches_between_unmapped_teams_is_total(spark):
    games = [(100 + i, 10, 1, None, None, i % 4, (i + 1) % 3) for i in range(6)]
    views = [team_view(clean_rows(spark, g)).repartition(3) for g in (games, games[::-1])]
    a, b = (_bag(running_totals(v, hot_threshold=None)) for v in views)
    assert a == b
    assert a == _bag(running_totals(views[0], hot_threshold=5))
