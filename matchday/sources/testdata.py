"""Match feeds derived from the TPC-H-style test tables.

The driver's test data has no football feed, so one is derived from
``orders`` (one match per order) and ``lineitem`` (one goal per line). Each
block of 306 consecutive order keys is one league season: a double round robin
of 18 teams, 34 match days of 9 games. The derivation is written as SQL
expression text valid in both Spark SQL and DuckDB, so the DuckDB oracle builds
the same *input* and checks the pipeline's *operators* independently.

Everything is a narrow projection of ``orders``; only the goals list needs a
``groupBy(l_orderkey)`` of ``lineitem`` (small groups: about 4 lines per order,
at most 17 at sf0.1) and a join with ``orders`` on the same key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FEED_SCHEMA, TEAM_MAPPER_SCHEMA
from .mappers import LEAGUE_MAPPER_CSV
from .tables import ensure_parallelism, local_table

# --- fixed values: league name spelling per (league block % 8) ---------------------
# The seven raw spellings of the default league mapper, in its file order, then one
# league the mapper does not know.
SPELLINGS: tuple[str, ...] = tuple(
    line.split(",")[0] for line in LEAGUE_MAPPER_CSV.strip().splitlines()[1:]
) + ("Testliga",)
# -----------------------------------------------------------------------------

GAMES_PER_SEASON = 306


def _spelling_case() -> str:
    whens = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SPELLINGS[:-1]))
    return f"CASE lg % 8 {whens} ELSE '{SPELLINGS[-1]}' END"


def _team_id(pos: str) -> str:
    return (
        f"CASE WHEN {pos} = 17 AND lg % 5 = 4 THEN 999 WHEN {pos} = 16 AND lg % 5 = 4 THEN 998 "
        f"WHEN {pos} < 4 AND lg % 2 = 1 THEN 200 + {pos} ELSE 100 + {pos} END"
    )


_DATE = (
    "CONCAT(CAST(yy AS STRING), '-', LPAD(CAST(mo AS STRING), 2, '0'), '-', "
    "LPAD(CAST(dd AS STRING), 2, '0'))"
)

# Each stage: expressions evaluated on top of all columns of the previous stage.
MATCH_STAGES: tuple[tuple[str, ...], ...] = (
    (
        f"CAST((o_orderkey - o_orderkey % {GAMES_PER_SEASON}) / {GAMES_PER_SEASON} AS BIGINT) AS lg",
        f"o_orderkey % {GAMES_PER_SEASON} AS pos",
    ),
    ("CAST((pos - pos % 9) / 9 AS BIGINT) AS rd", "pos % 9 AS slot"),
    ("rd % 17 AS r",),
    (
        "CASE WHEN slot = 0 THEN 17 ELSE (r + slot) % 17 END AS a",
        "CASE WHEN slot = 0 THEN r ELSE (r - slot + 17) % 17 END AS b",
    ),
    (
        "CASE WHEN rd >= 17 THEN b ELSE a END AS hm",
        "CASE WHEN rd >= 17 THEN a ELSE b END AS aw",
        "CAST((rd - rd % 4) / 4 AS BIGINT) AS m0",
    ),
    (
        f"{_team_id('hm')} AS t1",
        f"{_team_id('aw')} AS t2",
        "2000 + lg % 100 + CASE WHEN m0 >= 5 THEN 1 ELSE 0 END AS yy",
        "(7 + m0) % 12 + 1 AS mo",
        "1 + (rd % 4) * 7 + CASE WHEN slot < 5 THEN 0 ELSE 1 END AS dd",
        "o_orderkey % 97 <> 0 AS has_result",
        "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_custkey % 5 END AS p1",
        "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE CAST(FLOOR(o_totalprice) AS BIGINT) % 4 END AS p2",
    ),
)

# Flat match columns (nested feed paths with "_" for ".") plus helper columns.
MATCH_COLUMNS: tuple[str, ...] = (
    "o_orderkey AS matchID",
    f"CONCAT({_DATE}, 'T', CASE WHEN slot < 5 THEN '15:30:00' ELSE '18:30:00' END) AS matchDateTime",
    "'W. Europe Standard Time' AS timeZoneID",
    "CASE WHEN lg = 2 THEN 50 WHEN lg = 3 THEN 4570 ELSE 1000 + lg END AS leagueId",
    f"CONCAT({_spelling_case()}, ' ', CAST(2000 + lg % 100 AS STRING), '/', "
    "CAST(2001 + lg % 100 AS STRING)) AS leagueName",
    "2000 + lg % 100 AS leagueSeason",
    "CONCAT('l', CAST(lg % 8 AS STRING)) AS leagueShortcut",
    f"CONCAT({_DATE}, 'T', CASE WHEN slot < 5 THEN '13:30:00Z' ELSE '16:30:00Z' END) AS matchDateTimeUTC",
    "CASE WHEN rd = 33 AND lg % 3 = 1 THEN 'Relegation Hinspiel' "
    "ELSE CONCAT(CAST(rd + 1 AS STRING), '. Spieltag') END AS group_groupName",
    "rd + 1 AS group_groupOrderID",
    "lg * 100 + rd + 1 AS group_groupID",
    "t1 AS team1_teamId",
    "CONCAT('Team ', CAST(t1 AS STRING)) AS team1_teamName",
    "CONCAT('T', CAST(t1 AS STRING)) AS team1_shortName",
    "CONCAT('icons/', CAST(t1 AS STRING), '.png') AS team1_teamIconUrl",
    "CAST(NULL AS STRING) AS team1_teamGroupName",
    "t2 AS team2_teamId",
    "CONCAT('Team ', CAST(t2 AS STRING)) AS team2_teamName",
    "CONCAT('T', CAST(t2 AS STRING)) AS team2_shortName",
    "CONCAT('icons/', CAST(t2 AS STRING), '.png') AS team2_teamIconUrl",
    "CAST(NULL AS STRING) AS team2_teamGroupName",
    f"CONCAT({_DATE}, 'T23:00:00') AS lastUpdateDateTime",
    "o_orderstatus = 'F' AS matchIsFinished",
    "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CONCAT('Stadium ', CAST(t1 AS STRING)) END AS location",
    "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey * 10 END AS numberOfViewers",
    "has_result",
    "p1",
    "p2",
)

# --- fixed values: result records of one match ---------------------------------
FINAL_RESULT = {"name": "Endergebnis", "order": 2, "desc": "Ergebnis nach Ende der offiziellen Spielzeit"}
HALF_TIME_RESULT = {"name": "Halbzeitergebnis", "order": 1, "desc": "Ergebnis zur Halbzeit"}
# -----------------------------------------------------------------------------

# One goal per lineitem row.
GOAL_COLUMNS: tuple[str, ...] = (
    "l_orderkey * 10 + l_linenumber AS goalID",
    "CAST(l_linenumber AS BIGINT) AS scoreTeam1",
    "l_partkey % 4 AS scoreTeam2",
    "CAST(FLOOR(l_quantity) AS BIGINT) AS matchMinute",
    "l_suppkey AS goalGetterID",
    "CONCAT('Player ', CAST(l_suppkey AS STRING)) AS goalGetterName",
    "l_returnflag = 'R' AS isPenalty",
    # the own-goal flag under its two spellings: odd lines use one, even lines the other
    "CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_linestatus = 'O' END AS isOwnFoal",
    "CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus = 'O' ELSE NULL END AS isOwnGoal",
    "l_quantity > 45 AS isOvertime",
    "CASE WHEN l_returnflag = 'A' THEN 'Kopfball' ELSE NULL END AS comment",
)

# Predictions per match for the evaluation queries.
PREDICTION_COLUMNS: tuple[str, ...] = (
    "o_orderkey AS match_id",
    "(o_custkey + o_orderkey) % 5 AS pred_goals_1",
    "(o_orderkey + 1) % 4 AS pred_goals_2",
    "CAST(0.5 + (o_orderkey % 7) / 2.0 AS DOUBLE) AS mu_1",
    "CAST(0.5 + (o_orderkey % 5) / 2.0 AS DOUBLE) AS mu_2",
)

# Single-target deviance input straight from orders.
DEVIANCE_COLUMNS: tuple[str, ...] = (
    "o_orderkey AS match_id",
    "o_custkey % 5 AS y",
    "CAST(0.5 + (o_orderkey % 7) / 2.0 AS DOUBLE) AS mu",
)

ORDERS_COLUMNS = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
LINEITEM_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_returnflag",
    "l_linestatus",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan(spark: SparkSession, sf_dir: str, name: str, columns: tuple[str, ...], key: str) -> DataFrame:
    """Projected scan of a test table, spread over the task slots when under-partitioned."""
    return ensure_parallelism(read_table(spark, sf_dir, name).select(*columns), key=key)


def flat_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat row per match (feed paths with ``_``) plus ``has_result``, ``p1``, ``p2``."""
    orders = scan(spark, sf_dir, "orders", ORDERS_COLUMNS, "o_orderkey")
    return spark.sql(matches_sql("{orders}"), orders=orders)


def matches_sql(source: str) -> str:
    """The flat-match derivation as one SQL statement over ``source`` (a table or view name)."""
    sql = f"SELECT {', '.join(ORDERS_COLUMNS)} FROM {source}"
    for i, stage in enumerate(MATCH_STAGES):
        sql = f"SELECT *, {', '.join(stage)} FROM ({sql}) s{i}"
    return f"SELECT {', '.join(MATCH_COLUMNS)} FROM ({sql}) sm"


def _struct(prefix: str, fields: tuple[str, ...]) -> Column:
    return F.struct(*[F.col(f"{prefix}_{f}").alias(f) for f in fields])


def _result(spec: dict, halve: bool, rid_offset: int) -> Column:
    def pts(c: str) -> Column:
        # scores are >= 0: exact integer halving
        return F.expr(f"CAST(({c} - {c} % 2) / 2 AS BIGINT)") if halve else F.col(c).cast("bigint")

    return F.struct(
        (F.col("matchID") * 2 + F.lit(rid_offset)).alias("resultID"),
        F.lit(spec["name"]).alias("resultName"),
        pts("p1").alias("pointsTeam1"),
        pts("p2").alias("pointsTeam2"),
        F.lit(spec["order"]).cast("bigint").alias("resultOrderID"),
        F.lit(spec["order"]).cast("bigint").alias("resultTypeID"),
        F.lit(spec["desc"]).alias("resultDescription"),
    )


def goal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(l_orderkey, goals)``: the goal objects of each match (bounded groups)."""
    li = scan(spark, sf_dir, "lineitem", LINEITEM_COLUMNS, "l_orderkey")
    by_name = {e.rsplit(" AS ", 1)[1]: F.expr(e) for e in GOAL_COLUMNS}
    element = FEED_SCHEMA["goals"].dataType.elementType
    goal = F.struct(*[by_name[f.name].cast(f.dataType).alias(f.name) for f in element.fields])
    return li.groupBy("l_orderkey").agg(F.collect_list(goal).alias("goals"))


def match_feed(spark: SparkSession, sf_dir: str, with_goals: bool = True) -> DataFrame:
    """The nested match feed, shaped exactly like :data:`FEED_SCHEMA`.

    ``with_goals=False`` leaves the goals list null and skips the lineitem
    aggregation and join (for pipelines that only use results).
    """
    flat = flat_matches(spark, sf_dir)
    team = ("teamId", "teamName", "shortName", "teamIconUrl", "teamGroupName")
    results = F.slice(
        F.array(_result(FINAL_RESULT, False, 2), _result(HALF_TIME_RESULT, True, 1)),
        1,
        F.when(F.col("has_result"), F.lit(2)).otherwise(F.lit(0)),
    )
    goals_type = FEED_SCHEMA["goals"].dataType
    if with_goals:
        flat = flat.join(goal_lists(spark, sf_dir), F.col("matchID") == F.col("l_orderkey"), "left")
        goals = F.col("goals")
    else:
        goals = F.lit(None).cast(goals_type)
    return flat.select(
        "matchID",
        "matchDateTime",
        "timeZoneID",
        "leagueId",
        "leagueName",
        "leagueSeason",
        "leagueShortcut",
        "matchDateTimeUTC",
        _struct("group", ("groupName", "groupOrderID", "groupID")).alias("group"),
        _struct("team1", team).alias("team1"),
        _struct("team2", team).alias("team2"),
        "lastUpdateDateTime",
        "matchIsFinished",
        "location",
        "numberOfViewers",
        results.alias("matchResults"),
        goals.alias("goals"),
    )


def team_mapper(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """Mapper for the derived feed: raw 100+i and 200+i map to i+1; 998 and 999 stay unmapped."""
    rows = [(f"Team {100 + i}", 100 + i, i + 1) for i in range(18)]
    rows += [(f"Team {200 + i}", 200 + i, i + 1) for i in range(4)]
    return local_table(spark, rows, TEAM_MAPPER_SCHEMA)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted goals and Poisson means per match."""
    return scan(spark, sf_dir, "orders", ORDERS_COLUMNS, "o_orderkey").selectExpr(*PREDICTION_COLUMNS)


def deviance_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, sf_dir, "orders", ORDERS_COLUMNS, "o_orderkey").selectExpr(*DEVIANCE_COLUMNS)
