"""Table writers. Every write is distributed (one file set per task), never collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.normalize import validate_records
from ..schemas import RECORD_FIELDS
from .manifest import SEASON_PARTITIONS, Commit, write_version

#: Matches of a feed file at most, about 80 MB of JSON with goals.
FEED_FILE_ROWS = 50_000


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None
) -> None:
    """Write Parquet. A partitioned overwrite replaces only the partitions present in ``df``
    (dynamic partition overwrite), so others already written stay untouched.

    Rows are first rebalanced on the partition columns: each partition is written by one task, a large one by several
    (AQE splits it at the advisory size), instead of one file from every task.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(f"`{c}`") for c in partition_by])
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def is_record(records: str) -> Column:
    """Whether a normalised row holds a record (a match without records keeps one row of nulls)."""
    found = F.lit(False)
    for name, _ in RECORD_FIELDS[records]:
        found = found | F.col(f"`{name}`").isNotNull()
    return found


def commit_normalized(df: DataFrame, root: str, records: str = "matchResults", mode: str = "overwrite", writer: str = "batch") -> Commit:
    """Write a normalised record table below ``root/records`` as one commit of its season manifest.

    ``mode="overwrite"``: the commit replaces the seasons that ``df`` holds, like rewriting one file per season; others stay.
    ``mode="append"``: it adds to them. ``df`` must hold the two season columns.
    """
    validate_records(records)
    if missing := [p for p in SEASON_PARTITIONS if p not in df.columns]:
        raise ValueError(f"{missing} are needed to tell seasons apart; a write without them would replace every season")
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    return write_version(df, root, records, replaces=mode == "overwrite", writer=writer, has_records=is_record(records))


def write_normalized(df: DataFrame, root: str, records: str = "matchResults", mode: str = "overwrite") -> str:
    """:func:`commit_normalized`; returns the path of the table."""
    commit_normalized(df, root, records, mode)
    return f"{root.rstrip('/')}/{records}"


def write_feed_lines(feed: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = FEED_FILE_ROWS) -> None:
    """Write match objects as JSON Lines, e.g. as a landing zone for the stream.

    The lines repeat every key and most values, so they are written as gzip. Such a file is read by one task: none has more
    than ``rows_per_file`` matches.
    """
    (
        feed.write.mode(mode).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", rows_per_file).json(path)
    )
