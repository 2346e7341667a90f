"""Exact, seeded, reproducible half sample of ids, without a global sort.

The sample is "the first floor(n * fraction) rows when ordered by
(md5(seed || id), id)". Ordering by a uniform hash is a random permutation, so
this is a uniform sample without replacement; fixing the seed makes it
reproducible.

The cut key is found in one pass over the ids, an aggregate whose groups are of
two kinds:

* hashes around the place where the cut is expected (``fraction`` of the hash
  range) keep their distinct (hash, id) keys with counts;
* all others are counted by their first two hex digits, 256 on either side.

Hashes are uniform, so the cut of n ids lies within a few standard deviations
(1 / sqrt(n) of the range) of the expected place, and the more rows there are,
the smaller the share that keeps keys. A few thousand groups are read at once.
More are written, and the cut is approached there on four, then eight digits, so
that only keys that share eight digits are ever ordered. Should the cut lie
outside the range with keys (few ids, or many copies of one), one more filtered
pass reads the ids with its two digits.

The sample itself is the predicate ``(hash, id) <= cut`` that every task
evaluates locally: two scans of the input in all.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import row_bound

BUCKET_HEX_DIGITS = 4
BUCKETS = 16**BUCKET_HEX_DIGITS
#: Half of the share of the hash range that keeps its keys: where the number of rows is not known, and else as a multiple of
#: 1 / sqrt(rows) (a standard deviation of the cut's place is half of that; a bound may be several times the rows).
HALF_SHARE, HALF_WIDTHS = 1 / 64, 8
#: Groups that the driver reads at once; more are written.
DRIVER_KEYS = 50_000


def sample_key(id_col: str | Column, seed: str = "") -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(str(seed)), F.coalesce(c.cast("string"), F.lit(""))))


def _bucket(digits: int = BUCKET_HEX_DIGITS) -> Column:
    return F.substring("_h", 1, digits)


def _walk(counts: Iterable[tuple[Any, int]], need: int) -> tuple[Any, int]:
    """The label in which the ``need``-th row falls, and its place in there; ``counts`` in order."""
    before = 0
    for label, n in counts:
        if before + n >= need:
            return label, need - before
        before += n
    raise ValueError("fewer rows than needed")


def _keyed(keys: DataFrame) -> DataFrame:
    return keys.groupBy("_h", "_id").agg(F.count(F.lit(1)).alias("n"))


def _cut_among(keys: DataFrame, need: int) -> tuple[str, Any]:
    """The ``need``-th key of a table of distinct keys with counts. 65,536 counts at a time reach the driver."""
    for digits in (BUCKET_HEX_DIGITS, 2 * BUCKET_HEX_DIGITS):
        counts = keys.groupBy(_bucket(digits).alias("b")).agg(F.sum("n").alias("n")).collect()
        b, need = _walk(sorted((r["b"], r["n"]) for r in counts), need)
        keys = keys.filter(_bucket(digits) == F.lit(b))
    # distinct keys with eight digits in common: about n / 2**32
    upto = Window.orderBy("_h", "_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = keys.select("_h", "_id", F.sum("n").over(upto).alias("upto")).filter(F.col("upto") >= F.lit(need))
    hit = cut.orderBy("_h", "_id").first()
    return hit["_h"], hit["_id"]


def half_sample_cut(
    df: DataFrame, id_col: str = "match_id", seed: str = "", fraction: float = 0.5, rows: int | None = None
) -> tuple[str, Any] | None:
    """The largest (hash, id) key inside the sample; None for an empty sample.

    ``rows``: a bound on the rows of ``df`` (its known bound if left out). It decides how much is kept, not what is found.
    """
    rows = rows if rows is not None else row_bound(df)
    half = HALF_SHARE if rows is None else HALF_WIDTHS / math.sqrt(max(rows, 1))
    place, width = int(fraction * BUCKETS), math.ceil(half * BUCKETS)
    low, high = (f"{x:0{BUCKET_HEX_DIGITS}x}" for x in (max(0, place - width), min(BUCKETS - 1, place + width)))
    keyed = df.select(sample_key(id_col, seed).alias("_h"), F.col(id_col).alias("_id"))
    side = F.when(_bucket() < F.lit(low), F.lit(-1)).when(_bucket() > F.lit(high), F.lit(1)).otherwise(F.lit(0))
    inside = side == 0
    groups = keyed.groupBy(
        side.alias("side"), F.when(inside, F.col("_h")).otherwise(_bucket(2)).alias("_h"), F.when(inside, F.col("_id")).alias("_id")
    ).agg(F.count(F.lit(1)).alias("n"))

    found = groups.limit(DRIVER_KEYS + 1).collect() if rows is not None and 2 * half * rows + 512 <= DRIVER_KEYS else None
    if found is not None and len(found) <= DRIVER_KEYS:
        kept = [((r["side"], r["_h"], r["_id"] is not None, r["_id"]), r["n"]) for r in found]
        tables = None
    else:
        tables = materialize(groups, "sample-keys")
        part = F.when(F.col("side") == 0, F.lit("")).otherwise(F.col("_h"))
        kept = [((r["side"], r["h"], False, None), r["n"]) for r in tables.groupBy("side", part.alias("h")).agg(F.sum("n").alias("n")).collect()]
    need = math.floor(sum(n for _, n in kept) * float(fraction))
    if need < 1:
        return None
    (at, h, _, i), need = _walk(sorted(kept), need)
    if at != 0:
        return _cut_among(materialize(_keyed(keyed.filter((side == F.lit(at)) & (_bucket(2) == F.lit(h)))), "sample-bucket"), need)
    return (h, i) if tables is None else _cut_among(tables.filter(F.col("side") == 0), need)


def half_sample_flag(
    df: DataFrame, id_col: str = "match_id", seed: str = "", fraction: float = 0.5, rows: int | None = None
) -> Column:
    """Boolean column: is this row's id in the sample of ``df``. Finding the cut runs one aggregate over the ids of ``df``."""
    cut = half_sample_cut(df, id_col, seed, fraction, rows)
    if cut is None:
        return F.lit(False)
    key, i = sample_key(id_col, seed), F.col(id_col)
    up_to = i.isNull() if cut[1] is None else i.isNull() | (i <= F.lit(cut[1]))
    return F.coalesce((key < F.lit(cut[0])) | ((key == F.lit(cut[0])) & up_to), F.lit(False))


def half_sample(
    df: DataFrame, id_col: str = "match_id", seed: str = "", fraction: float = 0.5, rows: int | None = None
) -> DataFrame:
    """Rows of ``df`` whose id is in the exact half sample."""
    return df.filter(half_sample_flag(df, id_col, seed, fraction, rows))
