"""Tip score: the ten published cases verbatim, plus missing values."""

import math

from pyspark.sql import functions as F

from matchday.functions.scoring import tip_score
from matchday.operators.metrics import mean_tip_score

# (true goals team 1, team 2, predicted team 1, team 2, expected points)
CASES = [
    (1, 0, 1, 0, 3),  # exact, team 1 wins
    (1, 1, 1, 1, 3),  # exact draw
    (0, 1, 0, 1, 3),  # exact, team 2 wins
    (2, 1, 1, 0, 2),  # goal difference, team 1 wins
    (2, 2, 0, 0, 2),  # draw, other score
    (1, 2, 0, 1, 2),  # goal difference, team 2 wins
    (2, 1, 5, 1, 2),  # tendency, team 1 wins
    (1, 2, 1, 5, 2),  # tendency, team 2 wins
    (1, 0, 0, 1, 0),  # wrong winner
    (0, 0, 1, 0, 0),  # wrong draw
]


def _rows():
    return [tuple(float(v) for v in c[:4]) for c in CASES]


def test_published_cases(spark):
    df = spark.createDataFrame(_rows(), "t1 double, t2 double, p1 double, p2 double")
    got = [r[0] for r in df.select(tip_score("t1", "t2", "p1", "p2")).collect()]
    assert got == [c[4] for c in CASES]


def test_mean_of_published_cases(spark):
    df = spark.createDataFrame(_rows(), "t1 double, t2 double, p1 double, p2 double")
    row = mean_tip_score(df).collect()[0]
    assert math.isclose(row["mean_tip_score"], 1.9)
    assert row["n"] == 10


def test_missing_values_score_zero(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (None, 0.0, 0.0, 0.0),
        (nan, 0.0, nan, 0.0),  # NaN = NaN is true in Spark, false for arrays: must be 0
        (1.0, 1.0, nan, nan),
        (inf, inf, 1.0, 1.0),  # inf - inf is NaN: no tendency
        (inf, 0.0, inf, 0.0),  # exact match on infinities
    ]
    df = spark.createDataFrame(rows, "t1 double, t2 double, p1 double, p2 double")
    got = [r[0] for r in df.select(tip_score("t1", "t2", "p1", "p2")).collect()]
    assert got == [0, 0, 0, 0, 3]


def test_integer_inputs(spark):
    df = spark.createDataFrame([(3, 1, 2, 0), (1, 1, 2, 2)], "a long, b long, c long, d long")
    got = [r[0] for r in df.select(tip_score(F.col("a"), "b", "c", "d")).collect()]
    assert got == [2, 2]


def test_with_tip_score_column(spark):
    from matchday.operators.metrics import with_tip_score

    df = spark.createDataFrame(_rows(), "t1 double, t2 double, p1 double, p2 double")
    assert [r.tip_score for r in with_tip_score(df).collect()] == [c[4] for c in CASES]
