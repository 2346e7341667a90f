"""Season manifest: an append-only log of commits to a table that is partitioned by league season.

Layout of a table ``name`` below ``root``::

    root/name/leagueShortcut=<l>/leagueSeason=<s>/version=<v>/*.parquet    data, never changed once committed
    root/name_log/<v>-<writer>.json                                        one commit: a JSON line for each season

A writer reserves a version, writes its data into folders of that version and then commits: the log file appears by a rename, so
readers see all of a commit or nothing. Seasons are known from the write itself (an observed set of season pairs), not from a
second scan.

A commit either replaces its seasons or adds to them. The rows of a season are those of its last replacing commit and of all
commits behind it; of a match that several of these hold, the last one's rows count. Batch rewrites replace, streams add, so
both may write to one table in any order. Older data stays on disk, and in the log, until :func:`vacuum`.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import checked_broadcast

SEASON_PARTITIONS: tuple[str, ...] = ("leagueShortcut", "leagueSeason")
VERSION = "version"
_LOG_DDL = (
    "version bigint, writer string, replaces boolean, leagueShortcut string, leagueSeason bigint, has_records boolean, source bigint"
)


class Commit(NamedTuple):
    """A committed version; ``seasons``: (league shortcut, season) -> whether it has records. ``rows`` counts all rows written."""

    version: int
    rows: int
    seasons: dict[tuple[str | None, int | None], bool]


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _log(root: str, name: str) -> str:
    return f"{_path(root, name)}_log"


def _reserve(spark: SparkSession, root: str, name: str) -> int:
    """A version that no other writer has: the file ``<v>.open`` is created only if it is not there."""
    taken = [int(x.split(".")[0].split("-")[0]) for x in _names(spark, _log(root, name)) if x[:1].isdigit()]
    v = max(taken, default=0) + 1
    while True:
        fs, p = _fs(spark, f"{_log(root, name)}/{v:012d}.open")
        if fs.createNewFile(p):
            return v
        v += 1


def committed(spark: SparkSession, root: str, name: str, writer: str) -> bool:
    """Whether a writer of this name (one micro-batch of a stream, say) has committed."""
    return any(x.endswith(f"-{writer}.json") for x in _names(spark, _log(root, name)))


def write_version(
    df: DataFrame, root: str, name: str, replaces: bool = True, writer: str = "batch", has_records: Column | None = None,
    sources: Mapping[tuple[str | None, int | None], int] | None = None,
) -> Commit:
    """Write ``df`` as a new version and commit it.

    ``df`` holds the two season columns. ``has_records`` says of a row whether it is a record. ``sources``: seasons with the
    version of another table that this commit follows; they are replaced even if ``df`` has no row of theirs.

    Rows are rebalanced on the season columns first: a season is written by one task, a large one by several (AQE splits it at
    the advisory size). The set of seasons in one write reaches the driver.
    """
    spark, sources = df.sparkSession, dict(sources or {})
    version = _reserve(spark, root, name)
    season = F.struct(*[F.col(f"`{c}`") for c in SEASON_PARTITIONS])
    seen = Observation()
    full = F.collect_set(F.when(F.lit(True) if has_records is None else has_records, season))
    # observed behind the exchange: below it, adaptive execution drops the figures of an empty input with the input
    dealt = df.hint("rebalance", *[F.col(f"`{c}`") for c in SEASON_PARTITIONS])
    (
        dealt.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.to_json(F.collect_set(season)).alias("seasons"), F.to_json(full).alias("full"))
        .withColumn(VERSION, F.lit(version).cast("bigint"))
        # dynamic: a job stages its files on its own and moves only its folders, which are new
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*SEASON_PARTITIONS, VERSION).parquet(_path(root, name))
    )
    written, filled = ([tuple(x.get(c) for c in SEASON_PARTITIONS) for x in json.loads(seen.get[k])] for k in ("seasons", "full"))
    listed, filled = dict.fromkeys([*written, *sources]), set(filled)
    commit = Commit(version, seen.get["rows"], {s: s in filled for s in listed})
    lines = [
        dict(version=version, writer=writer, replaces=replaces, leagueShortcut=s[0], leagueSeason=s[1], has_records=has, source=sources.get(s))
        for s, has in commit.seasons.items()
    ]
    fs, tmp = _fs(spark, f"{_log(root, name)}/_{version:012d}.tmp")
    out = fs.create(tmp, True)
    out.write("".join(json.dumps(x) + "\n" for x in lines).encode())
    out.close()
    done = _fs(spark, f"{_log(root, name)}/{version:012d}-{writer}.json")[1]
    if not fs.rename(tmp, done):
        raise RuntimeError(f"version {version} of {name} could not be committed")
    fs.delete(_fs(spark, f"{_log(root, name)}/{version:012d}.open")[1], False)
    return commit


def has_log(spark: SparkSession, root: str, name: str) -> bool:
    return any(x.endswith(".json") for x in _names(spark, _log(root, name)))


def entries(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All commits: a row for each version and season."""
    return spark.read.schema(_LOG_DDL).json(f"{_log(root, name)}/*.json")


def _flagged(log: DataFrame) -> DataFrame:
    """The log with ``live`` (does this commit count for its season) and ``n`` (how many of the season do)."""
    season = Window.partitionBy(*SEASON_PARTITIONS)
    last = F.coalesce(F.max(F.when(F.col("replaces"), F.col(VERSION))).over(season), F.lit(0))
    flagged = log.withColumn("_last", last).withColumn("live", F.col(VERSION) >= F.col("_last")).drop("_last")
    return flagged.withColumn("n", F.sum(F.col("live").cast("int")).over(season))


def live_versions(log: DataFrame) -> DataFrame:
    """version, league, season, has_records, source and ``n`` (versions of that season) of all that counts."""
    return _flagged(log).filter("live").drop("live")


def season_versions(spark: SparkSession, root: str, name: str) -> DataFrame:
    """league, season, version (the last one), has_records, source: one row for each season of the table."""
    live = live_versions(entries(spark, root, name))
    return live.groupBy(*SEASON_PARTITIONS).agg(
        F.max(VERSION).alias(VERSION), F.max("has_records").alias("has_records"), F.max("source").alias("source"))


def _same_season(prefix: str) -> Column:
    a, b = SEASON_PARTITIONS
    return F.col(a).eqNullSafe(F.col(prefix + a)) & F.col(b).eqNullSafe(F.col(prefix + b))


def _renamed(df: DataFrame, prefix: str, *more: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in (*SEASON_PARTITIONS, *more)])


def scan(
    spark: SparkSession, root: str, name: str, schema: T.StructType, key: str | None = None,
    only: Sequence[tuple[str | None, int | None]] | None = None,
) -> DataFrame:
    """The rows of all live versions. ``key``: the column by which a later version's rows stand for an earlier one's (a null
    key stands for no other). ``only``: seasons to read; other folders are pruned.

    Where no season has more than one version in the log, this is a plain scan. Dead versions of a season are
    left out by an anti join with their (checked) list; only seasons with several live versions are shuffled, by match.
    """
    path = _path(root, name)
    columns = [F.col(f"`{f.name}`") for f in schema.fields]
    flagged = _flagged(entries(spark, root, name))
    dead = flagged.filter(~F.col("live"))
    several = flagged.filter(F.col("live") & (F.col("n") > 1))
    state = flagged.agg(
        F.collect_set(VERSION).alias("known"), F.count_if(~F.col("live")).alias("dead"),
        F.count_if(F.col("live") & (F.col("n") > 1)).alias("several")).first()

    full = T.StructType([*[f for f in schema.fields if f.name != VERSION], T.StructField(VERSION, T.LongType())])
    # folders of versions that were never committed are pruned
    rows = spark.read.schema(full).parquet(path).filter(F.col(VERSION).isin(sorted(state["known"])))
    if only is not None:
        rows = rows.filter(_any_season(only))
    if state["dead"]:
        gone = checked_broadcast(_renamed(dead, "_d_", VERSION), known_rows=state["dead"])
        rows = rows.join(gone, _same_season("_d_") & (F.col(VERSION) == F.col(f"_d_{VERSION}")), "left_anti")
    if key is None or not state["several"]:
        return rows.select(*columns)
    many = checked_broadcast(_renamed(several, "_m_").distinct(), known_rows=state["several"])
    one, more = (rows.join(many, _same_season("_m_"), how) for how in ("left_anti", "left_semi"))
    k = F.col(f"`{key}`")
    last = F.max(VERSION).over(Window.partitionBy(*SEASON_PARTITIONS, k))
    newest = more.filter(k.isNotNull()).withColumn("_last", last).filter(F.col("_last") == F.col(VERSION)).drop("_last")
    return one.unionByName(newest).unionByName(more.filter(k.isNull())).select(*columns)


def _any_season(seasons: Sequence[tuple[str | None, int | None]]) -> Column:
    """The partition filter of some seasons: folders are pruned while the scan is planned."""
    a, b = SEASON_PARTITIONS
    out = F.lit(False)
    by_season: dict[int | None, list[str | None]] = {}
    for league, season in seasons:
        by_season.setdefault(season, []).append(league)
    for season, leagues in by_season.items():
        named = F.col(a).isin([x for x in leagues if x is not None])
        if None in leagues:
            named = named | F.col(a).isNull()
        out = out | (F.col(b).eqNullSafe(F.lit(season)) & named)
    return out


def vacuum(spark: SparkSession, root: str, name: str) -> list[int]:
    """Delete the data and the commits of versions that hold no live season, and the data of those never committed and not
    open; returns them.

    Readers that began before may still need them, so this is never done by a write.
    """
    log, path = entries(spark, root, name), _path(root, name)
    keep = {r[0] for r in live_versions(log).select(VERSION).distinct().collect()}
    opened = {int(x.split(".")[0]) for x in _names(spark, _log(root, name)) if x.endswith(".open")}
    fs, folders = _fs(spark, f"{path}/*/*/{VERSION}=*")
    gone = set()
    for f in fs.globStatus(folders):
        if (v := int(f.getPath().getName().split("=")[1])) not in keep | opened:
            fs.delete(f.getPath(), True)
            gone.add(v)
    for x in _names(spark, _log(root, name)):
        if x.endswith(".json") and int(x.split("-")[0]) not in keep:
            fs.delete(_fs(spark, f"{_log(root, name)}/{x}")[1], False)
    return sorted(gone)
