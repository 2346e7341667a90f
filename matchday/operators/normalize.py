"""Feed normalisation: nested match objects -> one row per (match, record).

All of it is a single narrow projection over the scan: struct fields are
selected by path (Parquet/JSON nested-column pruning keeps only what is asked
for) and the record list goes through one ``explode_outer`` Generate. No
shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import GOAL_FLAG_ALIASES, META_COLUMNS, RECORD_FIELDS, RECORD_KINDS, meta_name


def validate_records(records: str) -> str:
    if records not in RECORD_KINDS:
        raise ValueError(f"{records} is not in {list(RECORD_KINDS)}.")
    return records


def validate_meta(meta: str | Sequence[str]) -> tuple[str, ...]:
    """``"all"`` or a list of valid meta paths; anything else is a ValueError."""
    if isinstance(meta, str):
        if meta == "all":
            return META_COLUMNS
        raise ValueError(f"meta should be 'all' or a subset of {list(META_COLUMNS)}")
    if isinstance(meta, (list, tuple)):
        invalid = [m for m in meta if m not in META_COLUMNS]
        if invalid:
            raise ValueError(f"{invalid} are not in {list(META_COLUMNS)}")
        return tuple(meta)
    raise ValueError(f"meta should be 'all' or a subset of {list(META_COLUMNS)}")


def _meta_column(path: str, separator: str) -> Column:
    c = F.col(path)
    if path == "matchIsFinished":
        c = c.cast("bigint")
    return c.alias(meta_name(path, separator))


def flatten(feed: DataFrame, meta: str | Sequence[str] = "all", separator: str = ".") -> DataFrame:
    """Nested objects to flat columns (``team1.teamId``); record lists are kept as arrays."""
    cols = validate_meta(meta)
    return feed.select(*[_meta_column(m, separator) for m in cols], "matchResults", "goals")


def record_columns(records: str, source: str = "_rec") -> list[Column]:
    """Typed columns of one record element; the own-goal flag merges its two spellings."""
    out = []
    for name, dtype in RECORD_FIELDS[records]:
        spellings = GOAL_FLAG_ALIASES.get(name) if records == "goals" else None
        if spellings:
            c = F.coalesce(*[F.col(f"{source}.{s}") for s in spellings])
        else:
            c = F.col(f"{source}.{name}")
        out.append(c.cast(dtype).alias(name))
    return out


def normalize(
    feed: DataFrame,
    records: str = "matchResults",
    meta: str | Sequence[str] = "all",
    separator: str = ".",
) -> DataFrame:
    """One row per element of ``records``; meta columns first, then the record fields.

    A match whose list is empty, null or missing keeps one row with null record
    columns (``explode_outer``), so match metadata is never lost.
    """
    validate_records(records)
    cols = validate_meta(meta)
    exploded = feed.select(
        *[_meta_column(m, separator) for m in cols],
        F.explode_outer(records).alias("_rec"),
    )
    return exploded.select(
        *[F.col(f"`{meta_name(m, separator)}`") for m in cols], *record_columns(records)
    )


def seasons_without_records(feed: DataFrame, records: str = "matchResults") -> DataFrame:
    """Per (league shortcut, season): match count, record count and whether no record exists.

    A partial aggregate (map-side combine) per season; at most one row per
    season crosses the shuffle from each task.
    """
    validate_records(records)
    n = F.coalesce(F.size(records), F.lit(0))
    n = F.when(n < 0, F.lit(0)).otherwise(n)  # size(null) is -1 under legacy settings
    return feed.groupBy("leagueShortcut", "leagueSeason").agg(
        F.count(F.lit(1)).alias("n_matches"),
        F.sum(n).cast("bigint").alias("n_records"),
        (F.max(n) == 0).alias("no_records"),
    )
