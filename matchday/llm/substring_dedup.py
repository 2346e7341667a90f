"""Substring dedup: seed and extend, over words.

Every window of ``LEAST`` words has an anchor, the smallest hash among its ``ANCHOR``-word grams (winnowing, so equal windows
have equal anchors). Anchors that two documents share are the seeds. From a seed a match extends both ways over all windows
that have it as their anchor: its span. Equal spans are compared once, by the first document that holds one; only there the
span's windows are looked up one by one. Windows that a document with a smaller id holds are repeats; they merge to maximal
ones, and their words go.

Windows, spans and anchors are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm.bitmap import bitmap
from matchday.llm.scratch import written
from matchday.llm.tables import table
from matchday.llm.words import Spans, chunks, encoded, hashed, long_lists, split_words, starts

LEAST = 50
ANCHOR = 25


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _anchored(words: pa.Array, counts: np.ndarray, least: int, anchor: int):
    """Runs of windows with one anchor: text, first and last window (flat places), anchor; and the texts' span hashes."""
    codes, distinct = encoded(words)
    spans = Spans(hashed(distinct)[codes])
    at, windows = starts(counts, least)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), spans
    grams = np.arange(len(codes) - anchor + 1)
    smallest = _smallest(spans.of(grams, grams + anchor), least - anchor + 1)[at]
    text = np.repeat(np.arange(len(counts)), windows)
    new = np.concatenate([[True], (smallest[1:] != smallest[:-1]) | (text[1:] != text[:-1])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return text[first], at[first], at[last], smallest[first], spans


def _anchors(batches, least: int, anchor: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches, "text"):
        words, counts = split_words(texts)
        text, _, _, value, _ = _anchored(words, counts, least, anchor)
        yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), batch.column("doc_id").take(pa.array(text))], ["anchor", "doc_id"])


_SEED = pa.struct([("span", pa.int64()), ("first", pa.int64()), ("windows", pa.list_(pa.int64()))])


def _seeded(batches, shared: Broadcast, least: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """For each document its words, and the spans around its shared anchors with the hashes of their windows."""
    for batch, texts in chunks(batches, "text"):
        words, counts = split_words(texts)
        text, lo, hi, value, spans = _anchored(words, counts, least, anchor)
        hit = shared.value.has(value) & np.asarray(batch.column("doc_id").is_valid())[text]
        text, lo, hi = text[hit], lo[hit], hi[hit]
        size = hi - lo + 1
        window = np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        seeds = pa.StructArray.from_arrays([
            pa.array(spans.of(lo, hi + least).view(np.int64)), pa.array(lo - (np.cumsum(counts) - counts)[text]),
            long_lists(spans.of(window, window + least), size)], fields=list(_SEED))
        ends = np.concatenate([[0], np.cumsum(counts)])
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends), words), pa.scalar(" ", pa.large_string()))
        at = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(counts)))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_id"), joined.cast(pa.string()), pa.array(counts),
             pa.ListArray.from_arrays(pa.array(at), seeds)],
            ["doc_id", "text_id", "words", "n_words", "seeds"])


def _cut(batches, least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, n_removed = [], []
        for words, n, repeats in zip(batch.column("words"), batch.column("n_words").to_pylist(), batch.column("repeats").to_pylist(), strict=True):
            gone = np.zeros(n + 1, np.int64)
            for r in repeats:
                first = r["first"] + (np.arange(r["size"]) if r["whole"] else np.array(r["windows"], np.int64))
                np.add.at(gone, first, 1)
                np.add.at(gone, first + least, -1)
            stays = np.cumsum(gone[:n]) == 0
            n_removed.append(n - int(stays.sum()))
            kept.append(" ".join(np.array(words.as_py().split(" "), dtype=object)[stays]) if n else "")
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, anchor: int = ANCHOR) -> DataFrame:
    """One row for each document: doc_id, n_words, n_removed, kept (the words that stay, joined by one space).

    A word goes if a window of ``least`` words that covers it also starts in a document with a smaller id. Windows are judged
    on the input. A null text has no words; a null id is neither smaller nor larger than another, so such a document stays
    whole and removes nothing. Of repeated rows (one id) none is smaller: each stays unless a smaller id has its windows.
    Texts shorter than ``least`` stay whole; an empty table gives an empty result; other columns are not looked at.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(whole, F.length(whole)).alias("text_id"), whole.alias("text"))
    anchors = (
        source.where("doc_id IS NOT NULL").select("doc_id", "text")
        .mapInArrow(lambda b: _anchors(b, least, anchor), f"anchor bigint, doc_id {kind}")
    )
    seeds = written(
        anchors.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor"), "anchors")
    shared = bitmap(seeds, "anchor", seeds.count())
    seeded = source.mapInArrow(
        lambda b: _seeded(b, shared, least, anchor),
        f"doc_id {kind}, text_id bigint, words string, n_words bigint, "
        "seeds array<struct<span: bigint, first: bigint, windows: array<bigint>>>")
    # only documents with a shared anchor are kept aside; the others are read from the source once more, at the end
    rows = written(seeded.where(F.size("seeds") > 0), "seeded")
    spans = rows.select("doc_id", "text_id", F.explode("seeds").alias("s")).select("doc_id", "text_id", "s.*")
    # the first holder of each span, and of each window among the first holders of spans
    held = written(spans.groupBy("span").agg(F.min("doc_id").alias("holder"), F.first("windows").alias("windows")), "spans")
    each = held.select("span", "holder", F.posexplode("windows").alias("at", "window"))
    # written, so that the join below deals both sides out anew and can split a window that many spans hold
    earliest = written(
        each.groupBy("window").agg(F.min("holder").alias("earliest"), F.max("holder").alias("latest")).where("earliest < latest")
        .select("window", "earliest"), "windows")
    again = (
        each.join(earliest, "window").where(F.col("earliest") < F.col("holder"))
        .groupBy("span").agg(F.collect_list("at").alias("again"))
    )
    holders = held.select("span", "holder", F.size("windows").alias("size")).join(again, "span", "left")
    repeats = (
        spans.select("doc_id", "text_id", "span", "first").join(holders, "span")
        .withColumn("whole", F.col("holder") < F.col("doc_id"))
        .where(F.col("whole") | F.col("again").isNotNull())
        .groupBy(F.col("doc_id").alias("_doc_id"), F.col("text_id").alias("_text_id"))
        .agg(F.collect_set(F.struct(
            "first", "size", "whole", F.when(F.col("whole"), F.array().cast("array<int>")).otherwise(F.col("again")).alias("windows"))).alias("repeats"))
    )
    touched = rows.select("doc_id", "text_id", "words", "n_words")
    same = (F.col("doc_id") == F.col("_doc_id")) & (F.col("text_id") == F.col("_text_id"))
    out = f"doc_id {kind}, n_words bigint, n_removed bigint, kept string"
    cut = (
        touched.join(repeats, same, "left")
        .select("doc_id", "words", "n_words", F.coalesce("repeats", F.expr(
            "cast(array() as array<struct<first: bigint, size: int, whole: boolean, windows: array<int>>>)")).alias("repeats"))
        .mapInArrow(lambda b: _cut(b, least), out)
    )
    untouched = seeded.where(F.size("seeds") == 0).select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("words").alias("kept"))
    return cut.unionByName(untouched)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: Fixed by the query's contract: windows of 50 words.
ORACLE_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), w AS (
  SELECT k, doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
  FROM (SELECT k, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d)
), f AS (SELECT h, min(doc_id) AS first FROM w GROUP BY h
), g AS (
  SELECT DISTINCT k, unnest(range(i, i + 50)) AS p FROM w JOIN f USING (h) WHERE first < doc_id
), a AS (SELECT k, list(p) AS gone FROM g GROUP BY k
), p AS (SELECT k, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM (
    SELECT k, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM d
  ) ANTI JOIN (SELECT k, p AS i FROM g) USING (k, i) GROUP BY k
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN p USING (k)
"""
