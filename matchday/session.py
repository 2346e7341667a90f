"""Session construction and shared scratch storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

# Settings the library's plans are tuned for. AQE re-plans joins and coalesces
# shuffle partitions at runtime; skew-join splitting is on for the lookup joins.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "matchday",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session with the library's defaults.

    On a cluster pass ``master=None`` and let the launcher decide; the shuffle
    partition count should then be sized to the data (roughly input bytes /
    128 MB), AQE coalesces the rest.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for intermediate tables that the driver and all executors share.

    It is the cluster's checkpoint folder (``spark.checkpoint.dir``). Where that is unset, a local session (one machine) gets
    a temporary folder; on a cluster each machine would write to its own disk, so there it is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="matchday-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the checkpoint root; whatever is written there goes when the session's JVM ends."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(there)
    return path


def materialize(df, name: str, distinct: str | None = None):
    """Write ``df`` as Parquet below the checkpoint root and return a scan of it.

    Cuts the lineage: later stages (and task retries after a lost executor)
    read the written table instead of recomputing everything upstream, and
    every branch that uses the table scans only the columns it needs.

    The rows (and about how many values of the column ``distinct``) are counted while they are written; the scan carries the
    figures as its :func:`~matchday.sources.tables.row_bound` and :func:`~matchday.sources.tables.distinct_values`.
    """
    from .sources.tables import with_distinct_values, with_row_bound

    path = scratch_path(df.sparkSession, name)
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows")]
    if distinct:
        counts.append(F.approx_count_distinct(distinct).alias("values"))
    df.observe(seen, *counts).write.mode("overwrite").parquet(path)
    out = with_row_bound(df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"])
    return with_distinct_values(out, distinct, seen.get["values"]) if distinct else out
