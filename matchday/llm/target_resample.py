"""Target-distribution importance resampling over hashed word and word-pair features.

A feature's bucket is its CRC-32 modulo 10,000. The vocabulary has a head and a tail. Head: frequent words with the CRC state
behind them, and frequent pairs of these with their buckets, both exact and broadcast (each bounded in rows and bytes). Tail: all
other features take the CRC of their bytes directly, a pair from the state of its first word. Totals count every
occurrence once: features that a task sees often are sent as counts by feature and hashed once, the others as counts by bucket.
So the head only spares work, and buckets, totals and weights are exact whatever it holds.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm.scratch import importable, written
from matchday.llm.tables import table
from matchday.llm.words import chunks, encoded, split_words

BUCKETS = 10_000
#: Bounds of the broadcast head: words, bytes of a word, pairs (4 MB and 2 MB at most).
HEAD_WORDS, HEAD_BYTES, HEAD_PAIRS = 1 << 16, 64, 1 << 17
#: A task sends a feature by name if it is seen so often in as many features as are counted together; otherwise by bucket.
OFTEN, TOGETHER = 8, 1 << 22
#: Fixed by the query's contract: words that a drawn document needs, the share drawn, the seed.
LEAST_WORDS, SHARE_PERCENT, SEED = 20, 25, 7

#: A-Z to a-z; what no word holds to a space (ASCII but for digits and letters).
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def lowered(texts: pa.LargeStringArray) -> pa.LargeStringArray:
    """The texts with A-Z lower-cased and a space for each character between words; bytes keep their places."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    clean = bytes(memoryview(data)[int(at[0]) : int(at[-1])]).translate(_WORD_BYTES) if data is not None else b""
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer((at - at[0]).tobytes()), pa.py_buffer(clean))


class Head:
    """The frequent words, and the buckets of frequent pairs by the places of their words."""

    def __init__(self, words: list[str], pairs: np.ndarray):
        self.words = pa.array(words, pa.large_string())
        self.states = np.array([crc32(w.encode()) for w in words], np.int64)
        self.pairs = np.sort(pairs)
        text = [b" " + w.encode() for w in words]
        self.buckets = np.array([crc32(text[p & 0xFFFF], int(self.states[p >> 16])) % BUCKETS for p in self.pairs.tolist()], np.int64)

    def places(self, distinct: pa.Array) -> np.ndarray:
        """Each word's place in the head, -1 for the others."""
        return pc.fill_null(pc.index_in(distinct, self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def states_of(self, distinct: pa.Array, places: np.ndarray) -> np.ndarray:
        """CRC state behind each word; the tail's directly."""
        out = np.zeros(len(places), np.int64)
        known = places >= 0
        out[known] = self.states[places[known]]
        out[~known] = [crc32(w.encode()) for w in distinct.filter(pa.array(~known)).to_pylist()]
        return out


def _pairs_of(codes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The pair codes (first * n + second) of adjacent words of one text, and each text's number of pairs."""
    inside = np.ones(len(codes), bool)
    inside[np.cumsum(counts)[counts > 0] - 1] = False
    first = np.flatnonzero(inside)
    return codes[first] * n + codes[first + 1], np.maximum(counts - 1, 0)


def _pair_buckets(first: np.ndarray, second: np.ndarray, states: np.ndarray, distinct: pa.Array) -> np.ndarray:
    """Buckets of pairs of word codes, by the direct CRC of a space and the second word from the state of the first."""
    used, at = np.unique(second, return_inverse=True)
    tails = [b" " + w.encode() for w in distinct.take(pa.array(used)).to_pylist()]
    return np.fromiter((crc32(tails[j], s) for s, j in zip(states[first].tolist(), at.tolist())), np.int64, len(first)) % BUCKETS


_COUNTS = pa.schema([("word", pa.string()), ("pair", pa.int64()), ("bucket", pa.int32()), ("n", pa.int64())])
_COUNTS_DDL = "word string, pair bigint, bucket int, n bigint"


def _rows(words=None, pairs=None, n=None, buckets: np.ndarray | None = None) -> pa.RecordBatch:
    if buckets is not None:
        at = np.flatnonzero(buckets)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(len(at), pa.string()), pa.nulls(len(at), pa.int64()), pa.array(at, pa.int32()), pa.array(buckets[at])], schema=_COUNTS)
    words = pa.nulls(len(n), pa.string()) if words is None else words.cast(pa.string())
    pairs = pa.nulls(len(n), pa.int64()) if pairs is None else pa.array(pairs)
    return pa.RecordBatch.from_arrays([words, pairs, pa.nulls(len(n), pa.int32()), pa.array(n)], schema=_COUNTS)


def _count_words(batches, often: int, together: int) -> Iterator[pa.RecordBatch]:
    """Counts of words: by word where they are frequent in the task and short, else by bucket."""
    buckets, kept, seen = np.zeros(BUCKETS, np.int64), [], 0

    def settle() -> pa.RecordBatch:
        both = pa.table({"w": pa.chunked_array([d for d, _ in kept]), "n": pa.chunked_array([pa.array(n) for _, n in kept])})
        sums = both.group_by("w").aggregate([("n", "sum")])
        words, n = sums["w"].combine_chunks(), sums["n_sum"].to_numpy()
        named = (n >= often) & (pc.binary_length(words).to_numpy(zero_copy_only=False) <= HEAD_BYTES)
        rest = pa.array(~named)
        np.add.at(buckets, np.array([crc32(w.encode()) % BUCKETS for w in words.filter(rest).to_pylist()], np.int64), n[~named])
        return _rows(words=words.filter(pa.array(named)), n=n[named])

    for _, texts in chunks(batches, "text"):
        codes, distinct = encoded(split_words(lowered(texts))[0])
        if len(codes):
            kept.append((distinct, np.bincount(codes, minlength=len(distinct)).astype(np.int64)))
            seen += len(distinct)
        if seen > together // 8:
            yield settle()
            kept, seen = [], 0
    if kept:
        yield settle()
    yield _rows(buckets=buckets)


def _count_pairs(batches, head: Head, often: int, together: int) -> Iterator[pa.RecordBatch]:
    """Counts of pairs: by the places of their words where both are in the head and the pair is frequent in the task, else by bucket."""
    buckets, kept, seen = np.zeros(BUCKETS, np.int64), [], 0

    def settle() -> pa.RecordBatch:
        pairs, at = np.unique(np.concatenate([p for p, _ in kept]), return_inverse=True)
        n = np.bincount(at, np.concatenate([n for _, n in kept]), len(pairs)).astype(np.int64)
        rare = n < often
        np.add.at(buckets, _pair_buckets(pairs[rare] >> 16, pairs[rare] & 0xFFFF, head.states, head.words), n[rare])
        return _rows(pairs=pairs[~rare], n=n[~rare])

    for _, texts in chunks(batches, "text"):
        words, counts = split_words(lowered(texts))
        codes, distinct = encoded(words)
        if not len(codes):
            continue
        places = head.places(distinct)
        states = head.states_of(distinct, places)
        pairs, n = np.unique(_pairs_of(codes, counts, len(distinct))[0], return_counts=True)
        first, second = pairs // len(distinct), pairs % len(distinct)
        both = (places[first] >= 0) & (places[second] >= 0)
        np.add.at(buckets, _pair_buckets(first[~both], second[~both], states, distinct), n[~both])
        kept.append((places[first[both]] << 16 | places[second[both]], n[both]))
        seen += int(both.sum())
        if seen > together // 4:
            yield settle()
            kept, seen = [], 0
    if kept:
        yield settle()
    yield _rows(buckets=buckets)


def _weigh(batches, head: Head, gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The columns of the documents but the text, and n_words, n_features, weight."""
    for batch, texts in chunks(batches, "text"):
        words, counts = split_words(lowered(texts))
        codes, distinct = encoded(words)
        features = counts + np.maximum(counts - 1, 0)
        sums = np.zeros(len(counts), np.int64)
        if len(codes):
            places = head.places(distinct)
            states = head.states_of(distinct, places)
            pair, n_pairs = _pairs_of(codes, counts, len(distinct))
            pairs, at = np.unique(pair, return_inverse=True)
            first, second = pairs // len(distinct), pairs % len(distinct)
            bucket = np.full(len(pairs), -1, np.int64)
            if len(head.pairs):
                both = np.flatnonzero((places[first] >= 0) & (places[second] >= 0))
                code = places[first[both]] << 16 | places[second[both]]
                found = np.minimum(np.searchsorted(head.pairs, code), len(head.pairs) - 1)
                hit = head.pairs[found] == code
                bucket[both[hit]] = head.buckets[found[hit]]
            tail = bucket < 0
            bucket[tail] = _pair_buckets(first[tail], second[tail], states, distinct)
            for gain, ends in ((gains[states % BUCKETS][codes], np.cumsum(counts)), (gains[bucket][at], np.cumsum(n_pairs))):
                sums += np.diff(np.concatenate([[0], np.concatenate([[0], np.cumsum(gain)])[ends]]))
        weight = np.where(features > 0, sums // np.maximum(features, 1), 0)
        rest = [batch.column(c) for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(counts), pa.array(features), pa.array(weight)],
            [*[c for c in batch.schema.names if c != "text"], "n_words", "n_features", "weight"])


def _texts(rows: DataFrame, text: str) -> DataFrame:
    return rows.select(F.col(f"`{text}`").cast("string").alias("text"))


def _most(counts: DataFrame, column: str, most: int) -> np.ndarray | list:
    """The values of ``column`` with the highest ``n``, ``most`` at most: all above a limit that a histogram of logarithms gives."""
    level = F.floor(F.log2("n") * 32).alias("level")
    above, limit = 0, None
    # a few thousand rows at most: 32 levels for each doubling of a count
    for row in counts.groupBy(level).agg(F.count("*").alias("k")).orderBy(F.desc("level")).collect():
        above += row["k"]
        if above > most:
            break
        limit = row["level"]
    if limit is None:
        return []
    return counts.where(F.floor(F.log2("n") * 32) >= limit).select(column).toArrow()[column].to_pylist()


def _summed(counts: DataFrame, sides: tuple[str, str], name: str) -> DataFrame:
    n = [F.sum(F.when(F.col("side") == s, F.col("n")).otherwise(0)).alias(s) for s in sides]
    return written(counts.groupBy("word", "pair", "bucket").agg(*n), name)


def bucket_totals(docs: DataFrame, target: DataFrame, text: str = "text", often: int = OFTEN, together: int = TOGETHER,
                  head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS) -> tuple[DataFrame, Head]:
    """bucket, s, t: how many features of all documents and of all target texts fall in it; and the head of the vocabulary.

    A null text has none. Buckets without a feature are missing. The other parameters bound the head and change no total.
    """
    spark = docs.sparkSession
    importable(spark)

    def counted(count: Callable, name: str) -> DataFrame:
        sides = [_texts(rows, text).mapInArrow(count, _COUNTS_DDL).withColumn("side", F.lit(side)) for side, rows in (("s", docs), ("t", target))]
        return _summed(sides[0].unionByName(sides[1]), ("s", "t"), name)

    words = counted(lambda b: _count_words(b, often, together), "resample-words")
    frequent = words.where("word IS NOT NULL").select("word", F.col("s").alias("n")).where("n > 0")
    head = Head(sorted(_most(frequent, "word", head_words)), np.zeros(0, np.int64))
    shared = spark.sparkContext.broadcast(head)
    try:
        pairs = counted(lambda b: _count_pairs(b, shared.value, often, together), "resample-pairs")
    finally:
        shared.unpersist()
    frequent = pairs.where("pair IS NOT NULL").select("pair", F.col("s").alias("n")).where("n > 0")
    full = Head(head.words.to_pylist(), np.array(_most(frequent, "pair", head_pairs), np.int64))

    by_word = words.where("word IS NOT NULL").select(_bucket(F.crc32(F.col("word").cast("binary"))).alias("bucket"), "s", "t")
    # a pair's words are in the head, so its bytes are those of two rows of a bounded table
    places = spark.createDataFrame(pa.table({"place": np.arange(len(head.words)), "w": head.words.cast(pa.string())}))
    by_pair = (
        pairs.where("pair IS NOT NULL")
        .join(places.select(F.col("place").alias("p1"), F.col("w").alias("w1")), F.shiftright("pair", 16) == F.col("p1"))
        .join(places.select(F.col("place").alias("p2"), F.col("w").alias("w2")), F.col("pair").bitwiseAND(F.lit(0xFFFF)) == F.col("p2"))
        .select(_bucket(F.crc32(F.concat("w1", F.lit(" "), "w2").cast("binary"))).alias("bucket"), "s", "t")
    )
    direct = words.unionByName(pairs).where("bucket IS NOT NULL").select("bucket", "s", "t")
    totals = direct.unionByName(by_word).unionByName(by_pair).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    return written(totals, "resample-totals"), full


def _bucket(crc: Column) -> Column:
    return F.pmod(crc, F.lit(BUCKETS)).cast("int")


def gains_of(totals: DataFrame) -> np.ndarray:
    """The gain of each bucket; BUCKETS rows at most reach the driver."""
    rows = totals.toArrow()
    s, t = np.zeros(BUCKETS), np.zeros(BUCKETS)
    s[rows["bucket"].to_numpy()], t[rows["bucket"].to_numpy()] = rows["s"].to_numpy(), rows["t"].to_numpy()
    all_s, all_t = float(s.sum()), float(t.sum())
    ratio = (t + 1) * (all_s + BUCKETS) / ((s + 1) * (all_t + BUCKETS))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def weighted(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits: int) -> DataFrame:
    """doc_id, n_words, n_features, weight (floored mean gain; 0 without features) of every document, written.

    ``limits``: the parameters of :func:`bucket_totals` that bound the head.
    """
    totals, head = bucket_totals(docs, target, text, **limits)
    shared = docs.sparkSession.sparkContext.broadcast((head, gains_of(totals)))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint"
    try:
        return written(rows.mapInArrow(lambda b: _weigh(b, *shared.value), schema), "resample-weights")
    finally:
        shared.unpersist()


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln(u))) for a number u in (0, 1) that follows from seed and id; a null id counts as the empty string."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))


def ranked(scores: DataFrame, share_percent: int = SHARE_PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scores`` (a written table of doc_id, n_words, score, ...) with rank: 1, 2, ... for the drawn documents by score
    descending, then id ascending (a null id first), null for the others.

    The cut's score comes from a histogram of scores; only documents from there on are sorted, in ranges, and a document's rank is its
    place in its range behind the rows of the ranges before. Rows alike in both are in any order.
    """
    may = F.col("n_words") >= least_words
    levels = scores.where(may).groupBy("score").agg(F.count("*").alias("k"))
    drawn, above, cut = 0, 0, None
    # a score is an integer in a range of some tens of thousands, whatever the number of documents
    counts = sorted(levels.collect(), key=lambda r: -r["score"])
    drawn = share_percent * sum(r["k"] for r in counts) // 100
    for row in counts:
        if above >= drawn:
            break
        above, cut = above + row["k"], row["score"]
    none = scores.withColumn("rank", F.lit(None).cast("long"))
    if cut is None:
        return none
    high = may & (F.col("score") >= cut)
    order = [F.desc("score"), F.asc("doc_id")]
    # the id of a row is its range's number times 2**33 plus its place there
    placed = written(
        scores.where(high).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()),
        "resample-order")
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    # one row for each range
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("k")).collect())
    before, starts = 0, {}
    for p, k in sizes:
        starts[p], before = before, before + k
    ranges = placed.sparkSession.createDataFrame(
        pa.table({"_part": pa.array(list(starts), pa.int64()), "_start": pa.array(list(starts.values()), pa.int64())}))
    rank = (F.col("_start") + place + 1).cast("long")
    inside = placed.withColumn("_part", part).join(ranges, "_part").select(*scores.columns, F.when(rank <= drawn, rank).alias("rank"))
    return none.where(~F.coalesce(high, F.lit(False))).unionByName(inside)


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", share_percent: int = SHARE_PERCENT,
             least_words: int = LEAST_WORDS, seed: int = SEED, **limits: int) -> DataFrame:
    """One row for each document: doc_id, n_words, n_features, weight, score, rank (null: not drawn).

    Null and empty texts have no features and weight 0. Rows with one id share its chance and stay as rows; a null id counts as
    the empty string. An empty table of documents gives an empty result, an empty target gains from its smoothing alone. Other
    columns are not looked at.
    """
    rows = weighted(docs, target, doc_id, text, **limits)
    scores = rows.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    return ranked(scores, share_percent, least_words)


def op11_target_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return picked.select("doc_id", "n_features", "weight", "score", "rank")


_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ORACLE_SQL = rf"""
WITH RECURSIVE steps AS (
  SELECT CAST(i AS BIGINT) AS i, 0 AS k, CAST(i AS BIGINT) AS c FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE c & 1 WHEN 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
), tab AS (SELECT list(c ORDER BY i) AS crc FROM steps WHERE k = 8
), texts AS (
  SELECT row_number() OVER () AS k, doc_id, 1 AS doc, text FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, 0, text FROM benchmark
), w AS (
  SELECT k, doc_id, doc, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPLIT}'), lambda x: x <> '') AS ws FROM texts
), f AS (
  SELECT k, doc, unnest(ws) AS f FROM w
  UNION ALL SELECT k, doc, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w
), b AS (
  SELECT f, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(
      range(0, length(hex(encode(f))) // 2), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT))),
    lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT f FROM f) CROSS JOIN tab
), n AS (
  SELECT bucket, CAST(sum(doc) AS DOUBLE) AS s, CAST(count(*) - sum(doc) AS DOUBLE) AS t FROM f JOIN b USING (f) GROUP BY bucket
), g AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM n) + {BUCKETS}) / ((s + 1) * ((SELECT sum(t) FROM n) + {BUCKETS})))) AS BIGINT) AS gain
  FROM n
), d AS (SELECT k, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total FROM f JOIN b USING (f) JOIN g USING (bucket) WHERE doc = 1 GROUP BY k
), x AS (
  SELECT w.doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_features,
         CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight,
         CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(w.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM w LEFT JOIN d USING (k) WHERE w.doc = 1
), s AS (
  SELECT *, CAST(weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0))) AS BIGINT) AS score FROM x
), r AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place,
         count(*) FILTER (n_words >= {LEAST_WORDS}) OVER () AS n FROM s
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, score,
       CASE WHEN n_words >= {LEAST_WORDS} AND place <= {SHARE_PERCENT} * n // 100 THEN place END AS rank FROM r
"""
