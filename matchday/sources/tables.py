"""Small helpers for building and scanning tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _literal(v, dtype: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    if isinstance(dtype, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(dtype, T.BooleanType):
        return "TRUE" if v else "FALSE"
    return f"CAST({v!r} AS {dtype.simpleString()})"


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small table held by the driver as an inline ``VALUES`` relation.

    It plans as a JVM ``LocalTableScan`` (no Python workers), and its size is
    the number of rows given, i.e. bounded by construction.
    """
    names = ", ".join(f"`{f.name}`" for f in schema.fields)
    if not rows:
        df = spark.createDataFrame([], schema)
    else:
        values = ", ".join(
            "(" + ", ".join(_literal(v, f.dataType) for v, f in zip(r, schema.fields)) + ")" for r in rows
        )
        df = spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
    return with_row_bound(df, len(rows))


ROW_BOUND_ATTR = "_matchday_row_bound"


def with_row_bound(df: DataFrame, n: int) -> DataFrame:
    """Record a proven upper bound on the rows of ``df`` (kept on this DataFrame object only)."""
    setattr(df, ROW_BOUND_ATTR, int(n))
    return df


def row_bound(df: DataFrame) -> int | None:
    return getattr(df, ROW_BOUND_ATTR, None)


_DISTINCT_ATTR = "_matchday_distinct_values"


def with_distinct_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """Record about how many values ``column`` has (kept on this DataFrame object only)."""
    setattr(df, _DISTINCT_ATTR, {**getattr(df, _DISTINCT_ATTR, {}), column: int(n)})
    return df


def distinct_values(df: DataFrame, column: str) -> int | None:
    return getattr(df, _DISTINCT_ATTR, {}).get(column)


# Largest dimension that is broadcast on request. Mapper rows are ~100 bytes,
# so this bounds a broadcast to a few MB per executor.
MAX_BROADCAST_ROWS = 50_000


def checked_broadcast(
    dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, known_rows: int | None = None
) -> DataFrame:
    """``broadcast(dim)`` if it has at most ``max_rows`` rows, else ``dim`` unchanged.

    ``known_rows`` is a proven bound (e.g. a table built from driver-side rows,
    see :func:`local_table`); without one, the check
    reads at most ``max_rows + 1`` rows, so it stays cheap even when the table
    turns out to be large.
    """
    bound = known_rows if known_rows is not None else row_bound(dim)
    n = bound if bound is not None else dim.limit(max_rows + 1).count()
    return F.broadcast(dim) if n <= max_rows else dim


def ensure_parallelism(df: DataFrame, key: str | None = None, min_partitions: int | None = None) -> DataFrame:
    """Spread an under-partitioned scan over the cluster's task slots.

    A scan of few large unsplittable inputs (one row group, one JSON array
    file per season) yields fewer partitions than the cluster has slots, and
    everything up to the first shuffle then runs in that many tasks. Only in
    that case the rows are hash-partitioned on ``key`` (deterministic on task
    retry; a later aggregate or join on the same key reuses the partitioning)
    or round-robin when no key is given. A large input is left untouched.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= target:
            return df
    except Exception:  # noqa: BLE001 - sessions without RDD access (e.g. Spark Connect)
        return df
    return df.repartition(target, key) if key else df.repartition(target)
