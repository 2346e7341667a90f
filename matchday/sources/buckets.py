"""Bucketed lookup tables: rows dealt by their join key when they are written, so that joins on it need no Exchange.

A bucketed table is Parquet with a note beside its files (``_bucketing.json``: key, buckets, schema). Spark knows buckets only of
catalog tables, so a scan registers the folder as an external table of the session, under a name that follows from the
folder and the write. Without the note (a write that broke off) the folder is scanned as plain Parquet.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_NOTE = "_bucketing.json"
_ATTR = "_matchday_bucketed_by"


def _file(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write ``df`` below ``path`` in ``buckets`` buckets by hash of ``keys``, each file sorted by them.

    Rows are dealt to one task for each bucket first, so there is one file a bucket.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    name = f"matchday_write_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")  # external: its files stay
    note = {"keys": list(keys), "buckets": buckets, "schema": df.schema.jsonValue(), "write": name}
    fs, p = _file(spark, f"{path}/{_NOTE}")
    out = fs.create(p, True)
    out.write(json.dumps(note).encode())
    out.close()


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    """The table below ``path``; a bucketed one with its buckets known."""
    path = path.rstrip("/")
    fs, p = _file(spark, f"{path}/{_NOTE}")
    if not fs.exists(p):
        return spark.read.parquet(path)
    stream = fs.open(p)  # readers skip files whose names begin with an underscore
    note = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    schema, keys = T.StructType.fromJson(note["schema"]), ", ".join(f"`{k}`" for k in note["keys"])
    name = f"matchday_{hashlib.md5((path + note['write']).encode()).hexdigest()}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {int(note['buckets'])} BUCKETS LOCATION '{path}'")
    df = spark.table(name)
    setattr(df, _ATTR, tuple(note["keys"]))
    return df


def bucketed_by(df: DataFrame) -> tuple[str, ...] | None:
    """The bucket key of a scan by :func:`scan_table` (kept on this DataFrame object only)."""
    return getattr(df, _ATTR, None)
