"""Empty and minimal inputs: every stage returns an empty (or one-row) result, never fails."""

import pytest

from helpers import CLEAN_DDL, clean_rows
from matchday.operators.metrics import mean_poisson_deviance, mean_tip_score
from matchday.operators.normalize import normalize, seasons_without_records
from matchday.operators.sampling import half_sample
from matchday.operators.views import result_class_base_view
from matchday.plans.features import FeatureBuilder
from matchday.plans.tables import performance, standings
from matchday.schemas import FEED_SCHEMA


def test_empty_feed(spark):
    feed = spark.createDataFrame([], FEED_SCHEMA)
    assert normalize(feed).count() == 0
    assert normalize(feed, "goals").count() == 0
    assert seasons_without_records(feed).count() == 0


def test_empty_clean_table(spark):
    m = spark.createDataFrame([], CLEAN_DDL)
    assert standings(m).count() == 0
    assert performance(m, "home_away").count() == 0
    fb = FeatureBuilder(spark)
    for target in ("goals", "result_class"):
        out = fb.get_features(m, {"overall_standings": standings(m), "overall_performance": performance(m)}, target)
        assert out.count() == 0
    assert result_class_base_view(m).count() == 0


def test_single_match(spark):
    m = clean_rows(spark, [(1, 10, 1, 1, 2, 3, 1)])
    st = {r.team_id: (r.points, r.rank) for r in standings(m).collect()}
    assert st == {1: (3, 1), 2: (0, 2)}
    assert half_sample(m.select("match_id")).count() == 0  # floor(1 / 2) = 0
    assert result_class_base_view(m).filter("home_team = 0").count() == 0


def test_empty_metrics(spark):
    df = spark.createDataFrame([], "t1 double, t2 double, p1 double, p2 double")
    row = mean_tip_score(df).collect()[0]
    assert row["mean_tip_score"] is None and row["n"] == 0
    dev = mean_poisson_deviance(spark.createDataFrame([], "y double, mu double"), [("y", "mu")]).collect()[0]
    assert dev["mean_poisson_deviance"] is None
    with pytest.raises(ValueError):
        mean_poisson_deviance(df, [])
