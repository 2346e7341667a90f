"""Incremental normalisation of feed files as they land.

The batch normaliser (:func:`matchday.operators.normalize.normalize`) is a
stateless projection plus ``explode_outer``, so the same function runs
unchanged on a streaming DataFrame. Each micro-batch is one commit of the
record table's season manifest, named after the stream and the batch: a batch
that is run again after a failure finds its commit and writes nothing. New files
in the landing folder are read exactly once, as the checkpoint records.
``trigger="availableNow"`` processes everything new and stops (scheduled
ingestion); ``trigger="continuous-poll"`` keeps polling at ``interval``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.normalize import normalize, validate_meta, validate_records
from ..sources.feed import feed_options
from ..sources.manifest import SEASON_PARTITIONS, committed
from ..sources.sinks import commit_normalized


def feed_stream(
    spark: SparkSession, landing_dir: str, layout: str = "array", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming scan of match feed files (declared schema; ``array`` = one JSON array per file). A damaged file fails the query."""
    reader = feed_options(spark.readStream, layout)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.json(landing_dir)


def normalize_stream(
    spark: SparkSession,
    landing_dir: str,
    out_root: str,
    records: str = "matchResults",
    meta: str | Sequence[str] = "all",
    separator: str = ".",
    layout: str = "array",
    checkpoint: str | None = None,
    trigger: str = "availableNow",
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start a query that adds newly landed matches, normalised, to ``out_root/{records}``.

    Batch writes go to the same table: :func:`~matchday.sources.feed.scan_records` gives a season's rows from its last batch
    write and what streams added since. A match that lands again replaces its earlier rows (across micro-batches; within one,
    all its rows stay).

    Unless ``checkpoint`` is given, each landing folder has its own (``out_root/_checkpoints/..``), which follows from the two
    folders alone: a query that is started again in another session resumes where the last one stopped. The two season
    columns are always written.
    """
    validate_records(records)
    cols = validate_meta(meta)
    cols = [*cols, *[c for c in SEASON_PARTITIONS if c not in cols]]
    out = normalize(feed_stream(spark, landing_dir, layout), records=records, meta=cols, separator=separator)
    root = out_root.rstrip("/")
    name = hashlib.md5(landing_dir.rstrip("/").encode()).hexdigest()[:12]
    ckpt = checkpoint or f"{root}/_checkpoints/{records}-{name}"
    stream = hashlib.md5(f"{name} {ckpt}".encode()).hexdigest()[:12]

    def commit(batch: DataFrame, number: int) -> None:
        writer = f"stream-{stream}-{number}"
        if not committed(batch.sparkSession, root, records, writer):
            commit_normalized(batch, root, records, mode="append", writer=writer)

    query = out.writeStream.foreachBatch(commit).option("checkpointLocation", ckpt).outputMode("append")
    if trigger == "availableNow":
        query = query.trigger(availableNow=True)
    elif trigger == "continuous-poll":
        query = query.trigger(processingTime=interval)
    else:
        raise ValueError("trigger must be 'availableNow' or 'continuous-poll'")
    return query.start()
