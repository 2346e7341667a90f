"""Aggregate evaluation metrics (one global aggregate each: partial per task, final on one row)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import poisson_deviance_term, tip_score


def with_tip_score(
    df: DataFrame, t1: str = "t1", t2: str = "t2", p1: str = "p1", p2: str = "p2", name: str = "tip_score"
) -> DataFrame:
    return df.withColumn(name, tip_score(t1, t2, p1, p2))


def mean_tip_score(df: DataFrame, t1: str = "t1", t2: str = "t2", p1: str = "p1", p2: str = "p2") -> DataFrame:
    """One row: the mean tip score and the number of scored rows."""
    s = tip_score(t1, t2, p1, p2)
    return df.agg(F.avg(s).alias("mean_tip_score"), F.count(F.lit(1)).alias("n"))


def mean_poisson_deviance(
    df: DataFrame,
    targets: Sequence[tuple[str | Column, str | Column]],
    invalid: str = "error",
) -> DataFrame:
    """Mean Poisson deviance per target and their unweighted mean.

    ``targets`` lists (observed, predicted) column pairs. Output: one row with
    ``poisson_deviance_<i>`` per target (1-based) and ``mean_poisson_deviance``;
    with one target the two are equal.
    """
    if not targets:
        raise ValueError("at least one (y, mu) pair is needed")
    per = [
        F.avg(poisson_deviance_term(y, mu, invalid=invalid)).alias(f"poisson_deviance_{i + 1}")
        for i, (y, mu) in enumerate(targets)
    ]
    out = df.agg(*per)
    names = [f"poisson_deviance_{i + 1}" for i in range(len(targets))]
    total = F.col(names[0])
    for n in names[1:]:
        total = total + F.col(n)
    return out.withColumn("mean_poisson_deviance", total / F.lit(float(len(names))))
