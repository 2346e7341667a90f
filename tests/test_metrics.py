"""Poisson deviance (single and multi target)."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.utils import CapturedException

from matchday.operators.metrics import mean_poisson_deviance


def _dev(y, mu):
    t = y * math.log(y / mu) if y > 0 else 0.0
    return 2 * (t - y + mu)


def test_single_target_matches_formula(spark):
    rows = [(0.0, 0.5), (1.0, 1.0), (3.0, 1.5), (2.0, 4.0)]
    df = spark.createDataFrame(rows, "y double, mu double")
    got = mean_poisson_deviance(df, [("y", "mu")]).collect()[0]
    want = sum(_dev(y, m) for y, m in rows) / len(rows)
    assert math.isclose(got["poisson_deviance_1"], want, rel_tol=1e-12)
    assert math.isclose(got["mean_poisson_deviance"], want, rel_tol=1e-12)


def test_multi_target_is_unweighted_mean(spark):
    rows = [(0.0, 0.5, 2.0, 1.0), (1.0, 1.0, 0.0, 0.25), (3.0, 1.5, 1.0, 3.0)]
    df = spark.createDataFrame(rows, "y1 double, m1 double, y2 double, m2 double")
    got = mean_poisson_deviance(df, [("y1", "m1"), ("y2", "m2")]).collect()[0]
    d1 = sum(_dev(r[0], r[1]) for r in rows) / 3
    d2 = sum(_dev(r[2], r[3]) for r in rows) / 3
    assert math.isclose(got["poisson_deviance_1"], d1, rel_tol=1e-12)
    assert math.isclose(got["poisson_deviance_2"], d2, rel_tol=1e-12)
    assert math.isclose(got["mean_poisson_deviance"], (d1 + d2) / 2, rel_tol=1e-12)


def test_invalid_domain(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 1.0)], "y double, mu double")
    with pytest.raises((CapturedException, PySparkException)):
        mean_poisson_deviance(df, [("y", "mu")]).collect()
    got = mean_poisson_deviance(df, [("y", "mu")], invalid="null").collect()[0]
    assert math.isclose(got["poisson_deviance_1"], _dev(2.0, 1.0))


def test_published_fixture_value(spark):
    """Mean deviance of the orders-derived fixture at sf0.001 (9 digits)."""
    import __spark_entry__ as E

    got = E.queries()["poisson_deviance"](spark, "/root/testdata/sf0.001").collect()[0]
    assert got["poisson_deviance_1"] == pytest.approx(2.064411684, abs=1e-9)
