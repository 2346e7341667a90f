"""Feed files -> normalised record tables, for many league seasons in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.normalize import normalize, validate_meta, validate_records
from ..sources.feed import (
    CORRUPT,
    available_seasons,
    catalogue_from_files,
    read_feed,
    request_grid,
    skipped_seasons,
    split_rejects,
)
from ..sources.manifest import SEASON_PARTITIONS
from ..sources.sinks import commit_normalized
from ..sources.tables import local_table

_REQUEST = T.StructType([T.StructField("league", T.StringType()), T.StructField("season", T.LongType())])


def normalize_seasons(
    spark: SparkSession,
    feed_path: str,
    out_root: str,
    leagues: Sequence[str] | None = None,
    seasons: Sequence[int] | None = None,
    records: str = "matchResults",
    meta: str | Sequence[str] = "all",
    layout: str = "array",
    separator: str = ".",
    errors: str = "fail",
) -> DataFrame:
    """Normalise the requested league seasons found under ``feed_path``.

    ``leagues`` and ``seasons`` each restrict the feed on their own; together
    they are the requested grid. With the feed's file layout
    (``layout="array"``, files named ``{league}_{season}.json``) a season is
    available when its file exists: file names are listed (no content is read)
    and only the matching files are read, whole. Other layouts are read
    completely and filtered on the league and season fields.

    All selected seasons are normalised by one scan and written by one
    partitioned write, committed as a whole (the commit replaces those seasons,
    others stay). The two season columns are always written, whatever ``meta``
    selects. Returns the requested-but-missing seasons (the "skipped" report;
    empty unless both lists are given). It comes out of the write, as does the
    report on seasons without records: :func:`~matchday.sources.feed.season_report`.

    A damaged file fails the call and commits nothing. ``errors="reject"`` leaves it out and writes what
    could not be parsed to ``out_root/{records}_rejects`` (file, record), by a second scan that runs only if there is any.
    """
    validate_records(records)
    if errors not in ("fail", "reject"):
        raise ValueError("errors must be 'fail' or 'reject'")
    cols = validate_meta(meta)
    cols = [*cols, *[c for c in SEASON_PARTITIONS if c not in cols]]
    nothing = spark.createDataFrame([], _REQUEST)
    both = leagues is not None and seasons is not None
    grid = request_grid(spark, leagues, seasons) if both else None
    catalogue, paths, selected = None, feed_path, F.lit(True)
    if layout == "array" and (leagues is not None or seasons is not None):
        catalogue = catalogue_from_files(spark, feed_path)
        wanted = catalogue if grid is None else available_seasons(grid, catalogue)
        if grid is None:
            wanted = wanted.filter(_selected("league", "season", leagues, seasons))
        # as many rows as there are season files among those asked for
        found = wanted.collect()
        if not found:
            return nothing if grid is None else skipped_seasons(grid, catalogue)
        base = feed_path.rstrip("/")
        paths = [f"{base}/{r['league']}_{r['season']}.json" for r in found]
    else:
        selected = _selected("leagueShortcut", "leagueSeason", leagues, seasons)
    feed = read_feed(spark, paths, layout=layout, errors="fail" if errors == "fail" else "keep")
    damaged, good = Observation(), feed
    if errors == "reject":
        good = split_rejects(feed.observe(damaged, F.count(CORRUPT).alias("n")))[0]
    rows = normalize(good.filter(selected), records=records, meta=cols, separator=separator)
    commit = commit_normalized(rows, out_root, records)
    # without a row to write the figures may be gone with the input
    if errors == "reject" and (not commit.rows or damaged.get["n"]):
        split_rejects(feed)[1].write.mode("append").parquet(f"{out_root.rstrip('/')}/{records}_rejects")
    if grid is None:
        return nothing
    if catalogue is not None:
        return skipped_seasons(grid, catalogue)
    # every match keeps a row (outer explode), so the write saw every season found; the grid is the caller's two lists
    missing = [(lg, int(s)) for lg in dict.fromkeys(leagues) for s in dict.fromkeys(seasons) if (lg, int(s)) not in commit.seasons]
    return local_table(spark, missing, _REQUEST)


def _selected(league: str, season: str, leagues: Sequence[str] | None, seasons: Sequence[int] | None) -> Column:
    out = F.lit(True)
    if leagues is not None:
        out = out & F.col(league).isin(list(leagues))
    if seasons is not None:
        out = out & F.col(season).isin([int(s) for s in seasons])
    return out
