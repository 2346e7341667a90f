"""Feed and table scans, and the season catalogue used to plan what to process."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.normalize import validate_records
from ..schemas import FEED_SCHEMA, normalized_schema
from . import manifest

# Files of the feed's native layout are named "{league}_{season}.json".
SEASON_FILE_PATTERN = r"^(.+)_([0-9]+)\.json$"


#: Column of the text that could not be parsed, in feeds read with ``errors="keep"``.
CORRUPT = "_corrupt_record"
ERROR_MODES = ("fail", "keep")


def feed_options(reader, layout: str, errors: str = "fail"):
    """A (batch or stream) reader with the declared schema and the options of a layout and error mode."""
    if layout not in ("array", "lines"):
        raise ValueError("layout must be 'array' or 'lines'")
    if errors not in ERROR_MODES:
        raise ValueError(f"errors must be in {list(ERROR_MODES)}")
    if layout == "array":
        reader = reader.option("multiLine", True)
    if errors == "fail":
        return reader.schema(FEED_SCHEMA).option("mode", "FAILFAST")
    schema = T.StructType([*FEED_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    return reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)


def read_feed(spark: SparkSession, path: str | Sequence[str], layout: str = "array", errors: str = "fail") -> DataFrame:
    """Scan match feed files with the declared schema (never inferred).

    ``layout="array"``: each file is one JSON array of match objects, the
    format the feed API serves (one file per league season). Such files are not
    splittable, so parallelism equals the file count: convert to Parquet once.
    ``layout="lines"``: JSON Lines, one match per line, splittable.
    Missing keys read as null.

    ``errors="fail"``: text that is no JSON of the schema (a file cut short, say) fails the job that reads it.
    ``errors="keep"``: the feed has a column ``_corrupt_record`` with such text (a line, or a whole array file) and null
    elsewhere; :func:`split_rejects` parts the two.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return feed_options(spark.read, layout, errors).json(paths)


def split_rejects(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the matches, the rejects: file, record) of a feed read with ``errors="keep"``."""
    good = feed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    # the JSON reader refuses plans that need this column alone: the id's test is true of every row
    any_id = F.coalesce(F.col("matchID"), F.lit(0)) >= F.lit(-(2**63))
    bad = feed.filter(F.col(CORRUPT).isNotNull() & any_id).select(
        F.col("_metadata.file_path").alias("file"), F.col(CORRUPT).alias("record"))
    return good, bad


def scan_records(
    spark: SparkSession, root: str, records: str = "matchResults", separator: str = ".",
    seasons: Sequence[tuple[str | None, int | None]] | None = None,
) -> DataFrame:
    """All seasons of one record kind committed below ``root`` by batch writes and by streams.

    The schema is declared, so partition columns keep their feed types and
    filters on league/season prune whole directories; ``seasons`` reads those
    (league shortcut, season) pairs only. A season's rows are those of its last
    batch write and of what streams added since; of a match that both hold, the
    later rows count (see :mod:`~matchday.sources.manifest`).
    """
    validate_records(records)
    schema = normalized_schema(records, separator=separator)
    if manifest.has_log(spark, root, records):
        return manifest.scan(spark, root, records, schema, key="matchID", only=seasons)
    # partition columns come last from the reader; restore the declared order
    out = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{records}").select(*[F.col(f"`{f.name}`") for f in schema.fields])
    return out if seasons is None else out.filter(manifest._any_season(seasons))


def season_report(spark: SparkSession, root: str, records: str = "matchResults") -> DataFrame:
    """leagueShortcut, leagueSeason, version, has_records of every season committed below ``root``, read from the log alone."""
    validate_records(records)
    return manifest.season_versions(spark, root, records).drop("source")


def scan_season_files(
    spark: SparkSession, path: str, records: str = "matchResults", separator: str = "."
) -> DataFrame:
    """All season files of one record kind in one folder, named ``{league}_{season}_{records}.parquet``.

    The cleaned table of the folder (``{records}_clean.parquet``) does not end alike and is not read.
    """
    validate_records(records)
    schema = normalized_schema(records, separator=separator)
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/*{records}.parquet")


def feed_catalogue(feed: DataFrame) -> DataFrame:
    """Distinct (league shortcut, season) pairs present in a feed."""
    return feed.select(
        F.col("leagueShortcut").alias("league"), F.col("leagueSeason").alias("season")
    ).distinct()


def catalogue_from_files(spark: SparkSession, path: str) -> DataFrame:
    """(league, season) pairs of "{league}_{season}.json" files below ``path``, from file metadata."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .load(path)
        .select(F.regexp_extract(F.element_at(F.split("path", "/"), -1), SEASON_FILE_PATTERN, 0).alias("f"))
    )
    name = F.col("f")
    return (
        files.filter(name != "")
        .select(
            F.regexp_extract(name, SEASON_FILE_PATTERN, 1).alias("league"),
            F.regexp_extract(name, SEASON_FILE_PATTERN, 2).cast("bigint").alias("season"),
        )
        .distinct()
    )


def request_grid(spark: SparkSession, leagues: Sequence[str], seasons: Sequence[int]) -> DataFrame:
    """Every requested (league, season) pair, from the caller's two lists."""
    schema = T.StructType([T.StructField("league", T.StringType())])
    lg = spark.createDataFrame([(x,) for x in leagues], schema)
    return lg.select("league", F.explode(F.array(*[F.lit(int(s)).cast("bigint") for s in seasons])).alias("season"))


def annotate_requests(grid: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Every requested pair with ``available`` (true: processed, false: skipped)."""
    cat = catalogue.select("league", "season").distinct().withColumn("available", F.lit(True))
    out = grid.join(cat, ["league", "season"], "left")
    return out.select("league", "season", F.coalesce(F.col("available"), F.lit(False)).alias("available"))


def available_seasons(grid: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Requested pairs that exist (processed)."""
    return grid.join(catalogue.select("league", "season"), ["league", "season"], "left_semi")


def skipped_seasons(grid: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Requested pairs that do not exist (reported as skipped)."""
    return grid.join(catalogue.select("league", "season"), ["league", "season"], "left_anti")
