"""Normalised records -> clean match table, at table and at path level."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.features import DEFAULT_FEATURES
from ..functions.predicates import EXCLUDED_LEAGUE_IDS
from ..operators.conform import clean
from ..sources import mappers
from ..sources.feed import scan_records
from ..sources.sinks import write_table


def clean_records(
    spark: SparkSession,
    records_root: str,
    out_path: str,
    records: str = "matchResults",
    features: Iterable[str] = DEFAULT_FEATURES,
    league_mapper: DataFrame | None = None,
    team_mapper: DataFrame | None = None,
    excluded_league_ids: Sequence[int] = EXCLUDED_LEAGUE_IDS,
    separator: str = ".",
) -> dict[str, int]:
    """Scan all seasons of one record kind, clean them and write one table.

    Mappers default to the packaged lookup tables. Returns what the write counted: ``rows``, and of the features
    ``league_name``, ``team_id_1`` and ``team_id_2`` that were asked for how many rows have none (the mappers do not know them).
    """
    df = scan_records(spark, records_root, records, separator=separator)
    out = clean(
        df,
        league_mapper if league_mapper is not None else mappers.league_mapper(spark),
        team_mapper if team_mapper is not None else mappers.team_mapper(spark),
        features=features,
        excluded_league_ids=excluded_league_ids,
        separator=separator,
    )
    seen = Observation()
    unmapped = [F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in ("league_name", "team_id_1", "team_id_2") if c in out.columns]
    write_table(out.observe(seen, F.count(F.lit(1)).alias("rows"), *unmapped), out_path)
    return dict(seen.get)
