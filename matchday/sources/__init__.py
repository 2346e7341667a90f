"""Scans, sinks, lookup tables and the test-data feed."""

from .feed import (
    annotate_requests,
    available_seasons,
    catalogue_from_files,
    feed_catalogue,
    read_feed,
    request_grid,
    scan_records,
    scan_season_files,
    season_report,
    skipped_seasons,
    split_rejects,
)
from .mappers import league_mapper, read_mapper_csv, team_mapper
from .manifest import vacuum
from .sinks import commit_normalized, write_feed_lines, write_normalized, write_table

__all__ = [
    "annotate_requests",
    "available_seasons",
    "catalogue_from_files",
    "commit_normalized",
    "feed_catalogue",
    "league_mapper",
    "read_feed",
    "read_mapper_csv",
    "request_grid",
    "scan_records",
    "scan_season_files",
    "season_report",
    "skipped_seasons",
    "split_rejects",
    "team_mapper",
    "vacuum",
    "write_feed_lines",
    "write_normalized",
    "write_table",
]
