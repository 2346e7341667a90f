"""Standings and form tables that follow a record table season by season.

The record table's manifest says which version each league season has; the tables' own manifests say which version they were
made from. A refresh reads and computes only the seasons whose version moved on, and commits them as replacements. League ids
identify a league season, so no window reaches over the seasons that are left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.features import DEFAULT_FEATURES
from ..operators.conform import clean
from ..operators.panels import PERFORMANCE_KEYS, STANDINGS_KEYS
from ..schemas import PANEL_METRICS, PERFORMANCE_METRICS, performance_columns
from ..session import materialize
from ..sources import manifest, mappers
from ..sources.feed import scan_records
from ..sources.manifest import SEASON_PARTITIONS
from .tables import performance, standings

RECORDS = "matchResults"
#: name -> how the table is made from clean matches.
TABLES: dict[str, Callable[..., DataFrame]] = {"standings": standings, "performance": performance}
_TEXT = {"league_name", "season_name", "team_name"}


def table_schema(name: str) -> T.StructType:
    """Columns of a refreshed table, the two season columns last."""

    def kind(c: str) -> T.DataType:
        if c in _TEXT:
            return T.StringType()
        if c == "home_team":
            return T.IntegerType()
        return T.DoubleType() if c.endswith("_avg") and c[:-4] in PERFORMANCE_METRICS else T.LongType()

    columns = {"standings": [*STANDINGS_KEYS, *PANEL_METRICS, "rank"], "performance": [*PERFORMANCE_KEYS, *performance_columns()]}[name]
    fields = [T.StructField(c, kind(c)) for c in columns]
    return T.StructType([*fields, T.StructField(SEASON_PARTITIONS[0], T.StringType()), T.StructField(SEASON_PARTITIONS[1], T.LongType())])


def changed_seasons(spark: SparkSession, records_root: str, out_root: str, name: str) -> dict[tuple[str | None, int | None], int]:
    """The seasons whose record version the table has not followed yet, with that version."""
    have = manifest.season_versions(spark, records_root, RECORDS).select(*SEASON_PARTITIONS, "version")
    if manifest.has_log(spark, out_root, name):
        made = manifest.season_versions(spark, out_root, name).select(
            *[F.col(c).alias(f"_m_{c}") for c in SEASON_PARTITIONS], F.col("source").alias("_m_source"))
        same = [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in SEASON_PARTITIONS]
        have = have.join(made, same[0] & same[1], "left").filter(
            F.col("_m_source").isNull() | (F.col("_m_source") < F.col("version"))).select(*SEASON_PARTITIONS, "version")
    return {(r[0], r[1]): r[2] for r in have.collect()}


def refresh_tables(
    spark: SparkSession,
    records_root: str,
    out_root: str,
    names: Iterable[str] = tuple(TABLES),
    league_mapper: DataFrame | None = None,
    team_mapper: DataFrame | None = None,
    separator: str = ".",
) -> dict[str, list[tuple[str | None, int | None]]]:
    """Bring ``out_root/standings`` and ``out_root/performance`` up to the records committed below ``records_root``.

    Returns the seasons that were computed, by table: all of them the first time, later those with a new commit. A season
    whose final results are all gone is committed empty. The list of changed seasons reaches the driver.
    """
    done: dict[str, list[tuple[str | None, int | None]]] = {}
    for name in names:
        if name not in TABLES:
            raise ValueError(f"{name} is not in {list(TABLES)}")
        changed = changed_seasons(spark, records_root, out_root, name)
        done[name] = sorted(changed, key=repr)
        if not changed:
            continue
        records = scan_records(spark, records_root, RECORDS, separator=separator, seasons=list(changed))
        matches = clean(
            records,
            league_mapper if league_mapper is not None else mappers.league_mapper(spark),
            team_mapper if team_mapper is not None else mappers.team_mapper(spark),
            features=DEFAULT_FEATURES, separator=separator, keep=SEASON_PARTITIONS,
        )
        table = TABLES[name](materialize(matches, "changed-matches"), carry=SEASON_PARTITIONS)
        table = table.select(*[F.col(f.name).cast(f.dataType) for f in table_schema(name).fields])
        manifest.write_version(table, out_root, name, sources=changed)
    return done


def scan_refreshed(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """All seasons of a refreshed table, without the two season columns."""
    return manifest.scan(spark, out_root, name, table_schema(name)).drop(*SEASON_PARTITIONS)
