"""Tables that cut lineage, in the folder the cluster shares."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from matchday.session import scratch_path

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from the place where the driver found it (a cluster may ship it instead)."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, known) if x)


#: Settings of Python workers under which freed memory goes back to the system instead of staying with an idle worker.
_FRUGAL = {
    "ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "262144", "MALLOC_TRIM_THRESHOLD_": "1048576",
}


def frugal(spark: SparkSession) -> None:
    """Lets Python workers import this package, and give freed memory back."""
    importable(spark)
    for name, value in _FRUGAL.items():
        spark.sparkContext.environment.setdefault(name, value)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet below ``spark.checkpoint.dir``, and a scan of it.

    A lost executor costs the tasks that it ran, not the work upstream; each later use reads the columns it needs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
