"""Entity conforming: league and team ids/names mapped through lookup tables.

Lookup tables are dimensions (a few hundred rows); they are broadcast only
after their size is checked, otherwise the join stays a shuffle join that AQE
may still turn into a broadcast at runtime.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import DEFAULT_FEATURES, build_features, league_name_raw
from ..functions.predicates import EXCLUDED_LEAGUE_IDS, not_excluded_league
from ..sources.tables import MAX_BROADCAST_ROWS, checked_broadcast, row_bound  # noqa: F401

def conform_leagues(records: DataFrame, league_mapper: DataFrame, broadcast: bool = True) -> DataFrame:
    """Add ``league_name_raw`` (name without the season) and the mapped ``league_name_unique``."""
    lm = league_mapper.select("league_name_raw", "league_name_unique")
    if broadcast:
        lm = checked_broadcast(lm, known_rows=row_bound(league_mapper))
    return records.withColumn("league_name_raw", league_name_raw()).join(lm, "league_name_raw", "left")


def conform_teams(
    records: DataFrame, team_mapper: DataFrame, separator: str = ".", broadcast: bool = True
) -> DataFrame:
    """Add ``team_id_unique_1`` / ``team_id_unique_2`` for the feed's raw team ids (left joins)."""
    tm = team_mapper.select("team_id_raw", "team_id_unique")
    if broadcast:
        tm = checked_broadcast(tm, known_rows=row_bound(team_mapper))
    out = records
    for side in (1, 2):
        raw = F.col(f"`team{side}{separator}teamId`")
        m = tm.select(
            F.col("team_id_raw").alias(f"_team_id_raw_{side}"),
            F.col("team_id_unique").alias(f"team_id_unique_{side}"),
        )
        out = out.join(m, raw == F.col(f"_team_id_raw_{side}"), "left").drop(f"_team_id_raw_{side}")
    return out


def unmapped_teams(
    records: DataFrame, team_mapper: DataFrame, separator: str = ".", broadcast: bool = True
) -> DataFrame:
    """Raw team ids of the feed (either side) that the team mapper does not know, with
    their number of record rows: the teams that end up with a null conformed id.

    Both sides are unpivoted by one Generate and pre-aggregated per raw id
    (partial aggregate) before the anti join with the mapper.
    """
    side = lambda n: F.struct(
        F.col(f"`team{n}{separator}teamId`").alias("team_id_raw"),
        F.col(f"`team{n}{separator}teamName`").alias("team_name"),
    )
    ids = records.select(F.inline(F.array(side(1), side(2)))).filter(F.col("team_id_raw").isNotNull())
    counts = ids.groupBy("team_id_raw").agg(
        F.min("team_name").alias("team_name"), F.count(F.lit(1)).alias("n_rows")
    )
    tm = team_mapper.select("team_id_raw")
    if broadcast:
        tm = checked_broadcast(tm, known_rows=row_bound(team_mapper))
    return counts.join(tm, "team_id_raw", "left_anti")


def clean(
    records: DataFrame,
    league_mapper: DataFrame,
    team_mapper: DataFrame,
    features: Iterable[str] = DEFAULT_FEATURES,
    excluded_league_ids: Sequence[int] = EXCLUDED_LEAGUE_IDS,
    separator: str = ".",
    broadcast: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Normalised records -> clean match table.

    Drops the excluded leagues (a pushed-down Parquet filter), conforms league
    and team identities with broadcast lookups and projects the named features,
    and the columns ``keep`` of the records behind them.
    One map-only stage: scan, filter, two/three broadcast hash joins, project.
    """
    df = records.filter(not_excluded_league(excluded_league_ids))
    df = conform_leagues(df, league_mapper, broadcast=broadcast)
    df = conform_teams(df, team_mapper, separator=separator, broadcast=broadcast)
    cols = build_features(list(features), sep=separator)
    try:
        return df.select(*cols, *[F.col(f"`{c}`") for c in keep])
    except AnalysisException as e:
        raise ValueError(
            "The requested features need columns the records do not have "
            f"(records of another kind?): {e}"
        ) from e
