"""Per-row scoring expressions of predicted results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: points of the tip game --------------------------------------
EXACT_POINTS = 3
TENDENCY_POINTS = 2
MISS_POINTS = 0
# -----------------------------------------------------------------------------


def _d(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def tip_score(t1: str | Column, t2: str | Column, p1: str | Column, p2: str | Column) -> Column:
    """Points of one tip: 3 for the exact score, 2 for the right tendency, else 0.

    Inputs are compared as doubles. A null or NaN anywhere gives 0 (array
    comparisons with NaN are false; Spark would treat NaN = NaN as true, so
    NaN is guarded explicitly).
    """
    t1, t2, p1, p2 = _d(t1), _d(t2), _d(p1), _d(p2)
    dt, dp = t1 - t2, p1 - p2
    unknown = (
        t1.isNull() | t2.isNull() | p1.isNull() | p2.isNull()
        | F.isnan(t1) | F.isnan(t2) | F.isnan(p1) | F.isnan(p2)
    )
    exact = (t1 == p1) & (t2 == p2)
    # inf - inf is NaN: such a difference matches no tendency
    tendency = (
        ~F.isnan(dt) & ~F.isnan(dp)
        & (((dt > 0) & (dp > 0)) | ((dt == 0) & (dp == 0)) | ((dt < 0) & (dp < 0)))
    )
    return (
        F.when(unknown, F.lit(MISS_POINTS))
        .when(exact, F.lit(EXACT_POINTS))
        .when(tendency, F.lit(TENDENCY_POINTS))
        .otherwise(F.lit(MISS_POINTS))
    )


def poisson_deviance_term(y: str | Column, mu: str | Column, invalid: str = "error") -> Column:
    """Unit Poisson deviance ``2 * (y * ln(y / mu) - y + mu)`` with ``y ln(y/mu) = 0`` at y = 0.

    The domain is y >= 0 and mu > 0. ``invalid="error"`` fails the job on the
    first bad row (only bad rows trigger it); ``invalid="null"`` turns them into
    nulls, which the mean then skips.
    """
    y, mu = _d(y), _d(mu)
    bad = (y < 0) | (mu <= 0) | y.isNull() | mu.isNull() | F.isnan(y) | F.isnan(mu)
    term = F.lit(2.0) * (F.when(y > 0, y * F.ln(y / mu)).otherwise(F.lit(0.0)) - y + mu)
    if invalid == "error":
        fail = F.raise_error(
            F.lit("Poisson deviance needs y >= 0 and mu > 0 (and no missing values)")
        ).cast("double")
        return F.when(bad, fail).otherwise(term)
    if invalid == "null":
        return F.when(bad, F.lit(None).cast("double")).otherwise(term)
    raise ValueError("invalid must be 'error' or 'null'")
