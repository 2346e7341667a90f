"""Benchmark decontamination by greedy string tiling.

Documents meet benchmark items on shared seeds of ``SEED`` tokens. For each pair that meets, running Karp-Rabin greedy
string tiling marks the longest matches that do not overlap, longest first, so that passages are found in any order. A
document is contaminated if tiles cover ``COVERAGE`` of an item's tokens.

What reaches the tiling is only the part of a document that seeds cover; a tile is at least one seed long, so nothing is
lost. Equal parts are tiled once however many documents hold them.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm.bitmap import Bitmap, bitmap
from matchday.llm.scratch import written
from matchday.llm.tables import table
from matchday.llm.words import chunks, encoded, hashed, long_lists, plain, short_windows, split_words, starts

SEED, COVERAGE = 5, 0.8
_FIRST_LENGTH = 20
_PRIME = (1 << 61) - 1
_BASE = 1_000_003


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and each text's number of them. A token is a word in lower case without ASCII punctuation at its ends."""
    words, counts = split_words(texts)
    codes, distinct = encoded(words)
    bare = plain(distinct)
    full = np.asarray(bare.is_valid()) & (pa.compute.binary_length(bare).to_numpy(zero_copy_only=False) > 0)
    full = full[codes]
    seen = np.concatenate([[0], np.cumsum(full)])
    ends = np.cumsum(counts)
    return hashed(bare)[codes[full]], seen[ends] - seen[ends - counts]


def _runs(tokens: list[int], marked: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """Start and hash of each window of ``size`` unmarked tokens, by a rolling hash."""
    drop = pow(_BASE, size, _PRIME)
    h, length = 0, 0
    for i, (x, m) in enumerate(zip(tokens, marked, strict=True)):
        if m:
            h, length = 0, 0
            continue
        h, length = (h * _BASE + x) % _PRIME, length + 1
        if length > size:
            h = (h - tokens[i - size] * drop) % _PRIME
        if length >= size:
            yield i - size + 1, h


def tiles(item: list[int], text: list[int], least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two token sequences: (place in item, place in text, length) of each tile.

    Matches are taken longest first; of equally long ones the first in the item, then in the text. A tile is ``least`` tokens
    long at least, and no token is in two tiles. Either sequence may be empty.
    """
    in_item, in_text = [False] * len(item), [False] * len(text)
    out: list[tuple[int, int, int]] = []
    size = max(least, min(_FIRST_LENGTH, len(item), len(text)))
    while True:
        places = defaultdict(list)
        for t, h in _runs(text, in_text, size):
            places[h].append(t)
        found: dict[int, list[tuple[int, int]]] = defaultdict(list)
        longest = 0
        for p, h in _runs(item, in_item, size):
            for t in places.get(h, ()):
                if p and t and item[p - 1] == text[t - 1] and not in_item[p - 1] and not in_text[t - 1]:
                    continue  # part of the match that began before
                n = 0
                while p + n < len(item) and t + n < len(text) and item[p + n] == text[t + n] and not in_item[p + n] and not in_text[t + n]:
                    n += 1
                if n >= size:
                    found[n].append((p, t))
                    longest = max(longest, n)
        if longest > 2 * size:
            size = longest
            continue
        queue = {n: sorted(x) for n, x in found.items()}
        for n in range(longest, size - 1, -1):
            for p, t in sorted(queue.get(n, ())):
                # what is left of a match that longer ones have cut
                a = 0
                while a < n:
                    if in_item[p + a] or in_text[t + a]:
                        a += 1
                        continue
                    b = a
                    while b < n and not in_item[p + b] and not in_text[t + b]:
                        b += 1
                    if b - a == n:
                        out.append((p, t, n))
                        in_item[p : p + n] = in_text[t : t + n] = [True] * n
                    elif b - a >= size:
                        queue.setdefault(b - a, []).append((p + a, t + a))
                    a = b
        if size <= least:
            return out
        size = max(least, size // 2)


def _item_rows(batches) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches, "text"):
        h, counts = _tokens(texts)
        at, windows = starts(counts, SEED)
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), long_lists(h, counts), long_lists(short_windows(h, SEED)[at], windows)],
            ["item_id", "tokens", "seeds"])


def _document_rows(batches, seeds: Bitmap) -> Iterator[pa.RecordBatch]:
    """For each document the tokens that seeds cover, runs parted by 0, those seeds, and a name for the tokens (null: none)."""
    for batch, texts in chunks(batches, "text"):
        h, counts = _tokens(texts)
        at, windows = starts(counts, SEED)
        w = short_windows(h, SEED)[at]
        hit = seeds.has(w)
        text_of = np.repeat(np.arange(len(counts)), windows)[hit]
        places, w = at[hit], w[hit]
        part, named, n_seeds = [[]] * len(counts), [None] * len(counts), np.bincount(text_of, minlength=len(counts))
        for i in np.unique(text_of):
            p = places[np.searchsorted(text_of, i) : np.searchsorted(text_of, i, side="right")]
            cover = np.unique(p[:, None] + np.arange(SEED))
            cuts = np.flatnonzero(np.diff(cover) > 1) + 1
            part[i] = np.insert(h[cover], cuts, np.uint64(0)).view(np.int64).tolist()
            named[i] = hashlib.blake2b(np.array(part[i]).tobytes(), digest_size=16).hexdigest()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(named, pa.string()), pa.array(part, pa.list_(pa.int64())), long_lists(w, n_seeds)],
            ["doc_id", "part", "tokens", "seeds"])


def _covered(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        covered, size = [], []
        for text, item in zip(batch.column("text_tokens").to_pylist(), batch.column("item_tokens").to_pylist(), strict=True):
            covered.append(sum(n for _, _, n in tiles(item, text)))
            size.append(len(item))
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("item_id"), pa.array(covered, pa.int64()), pa.array(size, pa.int64())],
            ["part", "item_id", "covered", "size"])


def _own_names(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(f"`{key}`").alias("x"), F.col(f"`{text}`").alias("text"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
               coverage: float = COVERAGE) -> DataFrame:
    """One row for each document: doc_id, contaminated, item_id (of the item covered most; ties: the smallest), coverage, n_items.

    Null texts are empty. Items with fewer than ``SEED`` tokens cannot be told from chance and match nothing; items with the
    same tokens count once, by their smallest id. With an empty benchmark all documents are clean; an empty table gives an
    empty result; repeated rows stay, null ids too; other columns are not looked at.
    """
    items = (
        _own_names(benchmark, item_id, text).withColumnRenamed("x", "item_id")
    )
    kind = items.schema["item_id"].dataType.simpleString()
    lists = "tokens array<bigint>, seeds array<bigint>"
    items = written(
        items.mapInArrow(_item_rows, f"item_id {kind}, {lists}")
        .where(F.size("seeds") > 0).groupBy("tokens").agg(F.min("item_id").alias("item_id"), F.first("seeds").alias("seeds")),
        "items",
    )
    each = written(items.select("item_id", F.explode("seeds").alias("seed")).distinct(), "seeds")
    all_seeds = each.select("seed").distinct()
    known = bitmap(all_seeds, "seed", all_seeds.count())
    id_kind = docs.schema[doc_id].dataType.simpleString()
    rows = written(
        _own_names(docs, doc_id, text).withColumnRenamed("x", "doc_id").mapInArrow(
            lambda b: _document_rows(b, known.value),
            f"doc_id {id_kind}, part string, {lists}"),
        "seeded",
    )
    parts = rows.where("part IS NOT NULL").groupBy("part").agg(F.first("tokens").alias("tokens"), F.first("seeds").alias("seeds"))
    pairs = parts.select("part", F.explode(F.array_distinct("seeds")).alias("seed")).join(each, "seed").select("part", "item_id").distinct()
    tiled = (
        pairs.join(parts.select("part", F.col("tokens").alias("text_tokens")), "part")
        .join(items.select("item_id", F.col("tokens").alias("item_tokens")), "item_id")
        .mapInArrow(_covered, f"part string, item_id {kind}, covered bigint, size bigint")
        .withColumn("coverage", F.col("covered") / F.col("size"))
        .where(F.col("covered") > 0)
        .groupBy("part")
        .agg(
            F.max("coverage").alias("coverage"),
            F.count(F.when(F.col("covered") >= F.ceil(F.lit(coverage) * F.col("size")), True)).alias("n_items"),
            F.min_by("item_id", F.struct(-F.col("coverage"), "item_id")).alias("item_id"),
        )
    )
    found = rows.where("part IS NOT NULL").select("doc_id", "part").join(tiled, "part", "left")
    clean = rows.where("part IS NULL").select("doc_id")
    return found.select(
        "doc_id", (F.coalesce("n_items", F.lit(0)) > 0).alias("contaminated"), "item_id",
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
    ).unionByName(clean.select(
        "doc_id", F.lit(False).alias("contaminated"), F.lit(None).cast(kind).alias("item_id"), F.lit(0.0).alias("coverage"),
        F.lit(0).cast("long").alias("n_items")))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
