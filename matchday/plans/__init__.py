"""End-to-end stages: ingest, clean, tables, features."""

from .cleaning import clean_records
from .features import FeatureBuilder
from .ingest import normalize_seasons
from .refresh import refresh_tables, scan_refreshed
from .tables import create_performance, create_standings, performance, standings

__all__ = [
    "FeatureBuilder",
    "clean_records",
    "create_performance",
    "create_standings",
    "normalize_seasons",
    "performance",
    "refresh_tables",
    "scan_refreshed",
    "standings",
]
