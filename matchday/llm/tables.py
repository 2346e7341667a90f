"""The tables that the registered queries read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchday.llm.scratch import importable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
