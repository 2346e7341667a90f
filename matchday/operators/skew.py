"""Hot window partitions: exact running and rolling statistics without one task per hot key.

A window partition is processed by one task. A football panel (one team in one
league season) has a few dozen rows, but a key can still be hot: all unmapped
teams of a league share the null team id, and a malformed feed can put
everything under one league id.

Hot keys are those with more rows than a threshold. Where a bound on all rows
is known (a table that :func:`~matchday.session.materialize` wrote counts its
rows while it writes) and lies below the threshold, there are none and nothing
runs. Otherwise one narrow pass counts rows by the first key column: no key has
more rows than it. Only where a value of it (a league) exceeds the threshold,
another pass counts rows per key, into a written table of the hot ones. Without
hot keys the plan is the plain window and nothing else.

Hot rows take a two-level scan:

1. they are written once, sorted by key and order over range partitions, each
   row with its place; a segment is a run of ``SEGMENT_ROWS`` places at most,
   whatever the values of the order columns;
2. a partial aggregate gives each (key, segment) its totals and its last k - 1
   rows. Places are consecutive, so the last k - 1 rows are the greatest of each
   residue of the place modulo k - 1;
3. a window over segments (one row each) gives every segment the totals and the
   last k - 1 rows of those before it: its carry rows;
4. carry rows and segment rows share one window per (key, segment), in which
   all statistics are plain window expressions. Carry rows are then dropped.

No task holds more than some segments, and no row is joined with another.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import checked_broadcast, row_bound

#: A window partition of so many rows is still an ordinary task (about 128 MB of panel rows).
DEFAULT_HOT_ROWS = 1_000_000
#: Rows of a segment at most.
SEGMENT_ROWS = 250_000
_PLACE_BITS = 33
#: Columns of hot rows beside their own: summed values, position, segment, and whether a row is only carried along.
RUN, PLACE, SEGMENT, CARRIED = "_run_", "_place", "_segment", "_carried"


class Hot(NamedTuple):
    """The hot keys as a written table, how many there are, and how many rows they have together."""

    table: DataFrame
    keys: int
    rows: int


def hot_keys(df: DataFrame, keys: Sequence[str], threshold: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """The keys with more than ``threshold`` rows, as a table (null is a key)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > F.lit(threshold)).select(*keys)


def surely_cold(df: DataFrame, threshold: int | None) -> bool:
    """Whether no key can be hot without a look at the rows: no threshold, or a known bound on all rows within it."""
    bound = row_bound(df)
    return threshold is None or (bound is not None and bound <= threshold)


class Sizes(NamedTuple):
    """How many values a column has (null is one), the rows of the most frequent one, and all rows."""

    values: int
    largest: int
    rows: int


def value_sizes(df: DataFrame, column: str) -> Sizes:
    """One pass over ``column``."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    sums = [F.coalesce(f("_rows"), F.lit(0)) for f in (F.max, F.sum)]
    return Sizes(*counts.agg(F.count(F.lit(1)), *sums).first())


def find_hot(
    df: DataFrame, groups: Sequence[Sequence[str]], threshold: int | None, largest: int | None = None
) -> list[Hot | None]:
    """For each list of key columns its hot keys, or None where there are none.

    ``None`` as threshold, or a known bound on the rows of ``df`` that does not exceed it, answers without running anything.
    Else the rows are counted by the first column that all lists share: keys within values of at most ``threshold`` rows are
    not hot (``largest``: the rows of the most frequent value, if known). Else all groups are counted in one pass over their columns.
    """
    if surely_cold(df, threshold):
        return [None] * len(groups)
    first = groups[0][0]
    if largest is None and all(g[0] == first and len(g) > 1 for g in groups):
        largest = value_sizes(df, first).largest
    if largest is not None and largest <= threshold:
        return [None] * len(groups)
    columns = list(dict.fromkeys(k for g in groups for k in g))
    counts = df.groupingSets([[F.col(k) for k in g] for g in groups], *[F.col(k) for k in columns]).agg(
        F.grouping_id().alias("_group"), F.count(F.lit(1)).alias("_rows"))
    hot = materialize(counts.filter(F.col("_rows") > F.lit(threshold)), "hot-keys")
    # one row for each list of keys
    sizes = {r["_group"]: (r["n"], r["rows"]) for r in hot.groupBy("_group").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_rows").alias("rows")).collect()}
    found: list[Hot | None] = []
    for g in groups:
        number = sum((k not in g) << (len(columns) - 1 - i) for i, k in enumerate(columns))
        n, rows = sizes.get(number, (0, 0))
        found.append(Hot(hot.filter(F.col("_group") == F.lit(number)).select(*g), n, rows) if n else None)
    return found


def same_key(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of ``keys`` with the columns of that name behind ``prefix``."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def split_hot(df: DataFrame, keys: Sequence[str], hot: Hot) -> tuple[DataFrame, DataFrame]:
    """(rows of other keys, rows of hot keys written once)."""
    table = hot.table.select(*[F.col(k).alias(f"_hot_{k}") for k in keys])
    table = checked_broadcast(table, known_rows=hot.keys)
    cond = same_key(keys, "_hot_")
    return df.join(table, cond, "left_anti"), materialize(df.join(table, cond, "left_semi"), "hot-rows")


def _segment_of(place: Column, segment_rows: int) -> Column:
    """The place at which a row's segment begins; segments begin anew in each range partition."""
    inside = place.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return place - F.pmod(inside, F.lit(segment_rows))


def in_segments(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], metrics: Sequence[str], back: int = 0,
    n_rows: int | None = None, segment_rows: int = SEGMENT_ROWS,
) -> tuple[DataFrame, WindowSpec]:
    """``rows`` with carry rows, and the window (per key and segment) in which running and rolling statistics are taken.

    Running sums of a metric ``m`` are those of ``_run_<m>``; frames of up to ``back`` rows before the current one read ``m``
    itself. Rows with ``_carried`` are to be dropped afterwards. Carry rows hold keys and metrics only. ``n_rows``: about how many
    rows there are (a known bound of ``rows`` if left out).
    """
    n = n_rows or row_bound(rows) or rows.count()
    sort = [*[F.col(k).asc_nulls_first() for k in keys], *order]
    ranges = rows.repartitionByRange(max(1, math.ceil(n / segment_rows)), *sort).sortWithinPartitions(*sort)
    # the id of a row is its partition's number times 2**33 plus its position there; written, it stays what it is
    placed = materialize(ranges.withColumn(PLACE, F.monotonically_increasing_id()), "hot-segments")
    placed = placed.withColumn(SEGMENT, _segment_of(F.col(PLACE), segment_rows))
    back = max(back, 1)
    last = F.struct(PLACE, *metrics)
    parts = placed.groupBy(*keys, SEGMENT, F.pmod(F.col(PLACE), F.lit(back)).alias("_residue")).agg(
        F.max(last).alias("_last"), *[F.sum(m).alias(f"_sum_{m}") for m in metrics])
    totals = parts.groupBy(*keys, SEGMENT).agg(
        F.sort_array(F.collect_list("_last")).alias("_tail"), *[F.sum(f"_sum_{m}").alias(f"_sum_{m}") for m in metrics])
    # one row for each segment of a key; each segment has a row at least, so `back` segments hold enough rows
    by_key = Window.partitionBy(*keys).orderBy(SEGMENT)
    before = totals.select(
        *keys, SEGMENT,
        F.flatten(F.collect_list("_tail").over(by_key.rowsBetween(-back, -1))).alias("_tail"),
        *[F.sum(f"_sum_{m}").over(by_key.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_sum_{m}") for m in metrics],
    ).withColumn("_tail", F.slice("_tail", F.greatest(F.size("_tail") - F.lit(back - 1), F.lit(1)), back))
    carried = before.select("*", F.posexplode("_tail").alias("_i", "_row")).select(
        *keys, SEGMENT, F.col(f"_row.{PLACE}").alias(PLACE), *[F.col(f"_row.{m}").alias(m) for m in metrics],
        *[F.when(F.col("_i") == 0, F.col(f"_sum_{m}")).alias(f"{RUN}{m}") for m in metrics], F.lit(True).alias(CARRIED))
    own = placed.withColumns({**{f"{RUN}{m}": F.col(m) for m in metrics}, CARRIED: F.lit(False)})
    w = Window.partitionBy(*keys, SEGMENT).orderBy(PLACE)
    return own.unionByName(carried, allowMissingColumns=True), w


def shuffle_width(spark) -> int:
    """The session's shuffle partition count (at least the default parallelism when known)."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), task_slots(spark))


def task_slots(spark) -> int:
    """Tasks that run at a time, 1 where that is not known."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
        return 1
