"""Size checks: broadcast only under a proven bound; repartition only under-partitioned scans."""

from matchday.operators.conform import checked_broadcast
from matchday.sources.tables import ensure_parallelism, local_table, row_bound
from matchday.schemas import TEAM_MAPPER_SCHEMA
from matchday.testing.planinfo import plan_text


def _join_plan(spark, dim):
    facts = spark.range(0, 1000).withColumnRenamed("id", "k")
    return plan_text(facts.join(dim, "k", "left"), "simple")


def test_broadcast_only_below_the_bound(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no automatic broadcast either
    try:
        small = spark.range(0, 10).withColumnRenamed("id", "k")
        big = spark.range(0, 200).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in _join_plan(spark, checked_broadcast(small, max_rows=100))
        plan = _join_plan(spark, checked_broadcast(big, max_rows=100))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_local_tables_carry_their_bound(spark):
    t = local_table(spark, [("a", 1, 1), ("b", 2, 1)], TEAM_MAPPER_SCHEMA)
    assert row_bound(t) == 2 and t.count() == 2
    assert "LocalTableScan" in plan_text(t, "simple")


def test_parallelism_guard(spark):
    slots = spark.sparkContext.defaultParallelism
    few = spark.range(0, 100, numPartitions=1)
    assert ensure_parallelism(few, key="id").rdd.getNumPartitions() == slots
    many = spark.range(0, 100, numPartitions=slots * 2)
    assert ensure_parallelism(many, key="id") is many
