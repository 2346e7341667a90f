"""Phrase collocations by Rabin-Karp fingerprints.

Prefix polynomials give every run of 1 to 3 words a 64-bit fingerprint. Tasks send fingerprints with their counts and a pointer to
a document that holds the phrase; a shuffle adds the counts and keeps one pointer. A phrase can only be frequent if its parts are,
so each length counts only phrases whose parts passed the length before (by a bitmap of bounded size, which may let others pass).
Frequent fingerprints alone are turned into text, by reading the documents that their pointers name.

Each occurrence carries 32 bits of a second, independent polynomial too. Where these differ within a fingerprint, or a pointer's
document does not hold it, the fingerprint's occurrences are counted again by their text, so collisions do not change a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchday.llm.bitmap import Bitmap, bitmap
from matchday.llm.scratch import frugal, written
from matchday.llm.tables import table
from matchday.llm.words import chunks, encoded, mixed, split_words

#: Fixed by the query's contract: words of a candidate, its least count, the share that drops one inside a longer one, rows a language.
LONGEST, LEAST_COUNT, INSIDE_PERCENT, TOP = 3, 10, 50, 2000
NO_LANG = "und"
#: Bytes of text whose phrases are counted together in a task.
SLICE = 4 << 20
#: Ranks are taken within this many parts of a language first.
SALTS = 256

#: A-Z to a-z, a tab to a space, what ends a piece to a new line.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else 10 if 10 <= b <= 13 or chr(b) in ".,;:!?" else 32 if b == 9 else b for b in range(256))


_M = 0x9E3779B97F4A7C15
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int, which: str) -> np.ndarray:
    """The first ``n`` powers of the multiplier, or of its inverse, modulo 2**64."""
    known = _POWERS[which]
    if len(known) < n:
        base = np.full(n, _M if which == "up" else pow(_M, -1, 1 << 64), np.uint64)
        base[0] = 1
        with np.errstate(over="ignore"):
            known = _POWERS[which] = np.multiply.accumulate(base)
    return known[:n]


class Phrases:
    """The words of some texts, and fingerprints of the runs of words that lie in one piece of one text."""

    def __init__(self, texts: pa.LargeStringArray, langs: list[str], bits: int):
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
        raw = bytes(memoryview(data)[int(at[0]) : int(at[-1])]).translate(_BYTES) if data is not None else b""
        at = at - at[0]
        clean = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(at.tobytes()), pa.py_buffer(raw))
        words, self.counts = split_words(clean)
        codes, self.distinct = encoded(words)
        self.codes = codes.astype(np.int32)
        self.text_of = np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)
        self._bits = np.uint64((1 << bits) - 1)
        self._breaks = self._pieces(np.frombuffer(raw, np.uint8), at)
        self._langs = np.array([xxhash.xxh3_64_intdigest(x, 13) for x in langs], np.uint64)
        both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.distinct.to_pylist())), ">u8").astype(np.uint64)
        self._checks = both[::2]
        with np.errstate(over="ignore"):
            terms = both[1::2][self.codes] * _powers(len(self.codes), "up")
            self._prefix = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(terms)])

    def _pieces(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The number of the piece in which each word lies (texts and pieces counted on)."""
        ends = raw == 10
        first = np.zeros(len(raw) + 1, bool)
        first[at] = True
        first = first[:-1]
        full = ~(ends | (raw == 32))
        starts = full.copy()
        starts[1:] &= ~full[:-1] | first[1:]
        starts = np.flatnonzero(starts)
        # breaks before each word: ends of pieces, and beginnings of texts
        marks = np.flatnonzero(ends | first)
        return np.searchsorted(marks, starts, "right").astype(np.int32)

    def runs(self, n: int) -> np.ndarray:
        """The first words of the runs of ``n`` words within a piece."""
        m = max(len(self.codes) - n + 1, 0)
        return np.flatnonzero(self._breaks[:m] == self._breaks[n - 1 : n - 1 + m])

    def prints(self, first: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of runs: the difference of two prefix polynomials, brought to one power, with language and length."""
        with np.errstate(over="ignore"):
            h = (self._prefix[first + n] - self._prefix[first]) * _powers(len(self.codes), "down")[first]
            return mixed(h ^ (self._langs[self.text_of[first]] + np.uint64(n))) & self._bits

    def checks(self, first: np.ndarray, n: int) -> np.ndarray:
        """31 bits of a polynomial of other hashes of the words."""
        h = np.zeros(len(first), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(n):
                h = h * np.uint64(_M) + self._checks[self.codes[first + i]]
        return (mixed(h) >> np.uint64(33)).astype(np.int64)

    def strings(self, first: np.ndarray, n: int) -> pa.Array:
        parts = [self.distinct.take(pa.array(self.codes[first + i])).cast(pa.string()) for i in range(n)]
        return pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]


def _slices(batches, bits: int):
    for batch, texts in chunks(batches, "text", SLICE):
        yield batch, Phrases(texts, batch.column("lang").to_pylist(), bits)


def _grouped(keys: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place and the size of each group of equal (key, more); a group that others with its key interrupt comes in parts."""
    order = np.argsort(keys)
    k, m = keys[order], more[order]
    new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (m[1:] != m[:-1])])) if len(k) else np.zeros(0, np.int64)
    return order[new], np.diff(np.concatenate([new, [len(k)]]))


_COUNTED = "print bigint, seen bigint, pointer bigint, lang string"


def _count(batches, n: int, bits: int, passed: Bitmap | None) -> Iterator[pa.RecordBatch]:
    """Fingerprints of the runs of ``n`` words whose parts passed: print, seen (the check above 32 bits of count), pointer. For
    single words also rows without a print: the language's number of words."""
    for batch, p in _slices(batches, bits):
        first = p.runs(n)
        if passed is not None and len(first):
            first = first[passed.has(p.prints(first, n - 1)) & passed.has(p.prints(first + 1, n - 1))]
        prints = p.prints(first, n)
        checks = p.checks(first, n)
        at, k = _grouped(prints, checks)
        keys = batch.column("key").to_numpy(zero_copy_only=False)[p.text_of[first[at]]]
        rows = [pa.array(prints[at].view(np.int64)), pa.array(checks[at] << 32 | k), pa.array(keys, pa.int64()), pa.nulls(len(at), pa.string())]
        yield pa.RecordBatch.from_arrays(rows, ["print", "seen", "pointer", "lang"])
        if n == 1:
            sums = pa.table({"lang": batch.column("lang"), "n": pa.array(p.counts)}).group_by("lang").aggregate([("n", "sum")])
            none = pa.nulls(len(sums), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, sums["n_sum"].combine_chunks(), none, sums["lang"].combine_chunks()], ["print", "seen", "pointer", "lang"])


def _spread(column: str) -> Column:
    """A hash of a hash, as well mixed as the bitmap needs it."""
    return F.xxhash64(column)


def _among(batches, keys: Bitmap) -> Iterator[pa.RecordBatch]:
    """The rows whose hashed key may be in the table."""
    for batch in batches:
        near = batch.filter(pa.array(keys.has(batch.column("h").to_numpy(zero_copy_only=False))))
        if len(near):
            yield near.select(["text", "lang", "key"])


def _spell(batches, bits: int) -> Iterator[pa.RecordBatch]:
    """The phrases of the prints that each document is to give, with their checks."""
    for batch, p in _slices(batches, bits):
        wanted = batch.column("wanted")
        texts = np.repeat(np.arange(len(batch)), pc.list_value_length(wanted).to_numpy(zero_copy_only=False))
        flat = wanted.flatten()
        prints, sizes = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for n in range(1, LONGEST + 1):
            mine = sizes == n
            asked = np.unique(prints[mine].view(np.uint64))
            if not len(asked):
                continue
            first = p.runs(n)
            have = p.prints(first, n)
            place = np.minimum(np.searchsorted(asked, have), len(asked) - 1)
            first, have = first[asked[place] == have], have[asked[place] == have]
            # one occurrence of each print in each document that was asked for it
            at = np.unique(np.stack([have, p.text_of[first].astype(np.uint64)]), axis=1, return_index=True)[1] if len(have) else np.zeros(0, np.int64)
            want = set(zip(texts[mine].tolist(), prints[mine].view(np.uint64).tolist()))
            keep = [(t, x) in want for t, x in zip(p.text_of[first[at]].tolist(), have[at].tolist())]
            at = at[np.array(keep, bool)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(have[at].view(np.int64)), pa.array(np.full(len(at), n, np.int32)),
                 batch.column("lang").take(pa.array(p.text_of[first[at]])), p.strings(first[at], n), pa.array(p.checks(first[at], n))],
                ["print", "size", "lang", "phrase", "check"])


def _recount(batches, bits: int, unsettled: Bitmap) -> Iterator[pa.RecordBatch]:
    """Counts by text of the phrases whose prints may be unsettled."""
    for batch, p in _slices(batches, bits):
        for n in range(1, LONGEST + 1):
            first = p.runs(n)
            prints = p.prints(first, n)
            at = unsettled.has(prints)
            first, prints = first[at], prints[at].view(np.int64)
            rows = pa.table({
                "print": pa.array(prints), "lang": batch.column("lang").take(pa.array(p.text_of[first])), "phrase": p.strings(first, n)})
            sums = rows.group_by(["print", "lang", "phrase"]).aggregate([([], "count_all")])
            yield pa.RecordBatch.from_arrays(
                [sums["print"].combine_chunks(), pa.array(np.full(len(sums), n, np.int32)), sums["lang"].combine_chunks(),
                 sums["phrase"].combine_chunks(), sums["count_all"].combine_chunks()], ["print", "size", "lang", "phrase", "n"])


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to 3 words with ``least`` occurrences in their language (lang, size, phrase, n), and each language's
    number of words (lang, n). Both are written tables.

    A null text is empty, a null language ``und``. ``bits``: width of the fingerprints, less only in tests.
    """
    spark = docs.sparkSession
    frugal(spark)
    clean = docs.select(
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"),
    ).withColumn("key", F.xxhash64("text", "lang"))
    counted, passed, words = [], None, None
    for n in range(1, LONGEST + 1):
        filtered = passed

        def count(batches, n=n, shared=filtered):
            return _count(batches, n, bits, shared and shared.value)

        rows = clean.mapInArrow(count, _COUNTED)
        k, check = F.col("seen").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftright("seen", 32)
        sums = rows.groupBy("print", "lang").agg(
            F.sum(F.when(F.col("print").isNull(), F.col("seen")).otherwise(k)).alias("n"), F.min(check).alias("check"),
            F.max(check).alias("other"), F.min("pointer").alias("pointer"))
        kept = written(sums.where(F.col("print").isNull() | (F.col("n") >= least)), f"phrases-{n}")
        if passed is not None:
            passed.unpersist()
        if n == 1:
            words = written(kept.where("print IS NULL").select("lang", "n"), "language-words")
        kept = kept.where("print IS NOT NULL").withColumn("size", F.lit(n))
        counted.append(kept)
        if n < LONGEST:
            passed = bitmap(kept.select("print"), "print", kept.count())
    prints = counted[0].unionByName(counted[1]).unionByName(counted[2]).drop("lang")

    # a document is asked for as many phrases as it holds at most; pointers are least hashes, so few documents are asked
    asked = written(prints.groupBy(F.col("pointer").alias("key")).agg(F.collect_list(F.struct("print", "size")).alias("wanted")), "phrase-pointers")
    holding = bitmap(asked.select(_spread("key").alias("h")), "h", asked.count())
    near = clean.withColumn("h", _spread("key")).mapInArrow(lambda b: _among(b, holding.value), "text string, lang string, key bigint")
    # copies of a text meet in a partial aggregate first, so a hot text is one row of each task
    holders = near.groupBy("key").agg(F.min_by(F.struct("text", "lang"), "text").alias("d"))
    spelled = holders.join(asked, "key").select("d.text", "d.lang", "wanted").mapInArrow(
        lambda b: _spell(b, bits), "print bigint, size int, lang string, phrase string, check bigint")
    found = written(prints.join(spelled.withColumnRenamed("check", "spelled"), ["print", "size"], "left"), "phrase-texts")
    holding.unpersist()
    settled = (F.col("check") == F.col("other")) & (F.col("spelled") == F.col("check"))
    open_ = written(found.where(~F.coalesce(settled, F.lit(False))).select("print").distinct(), "unsettled-prints")
    out = found.where(settled).join(open_, "print", "left_anti").select("lang", "size", "phrase", "n")
    n_open = open_.count()
    if n_open:
        shared = bitmap(open_, "print", n_open)
        again = clean.mapInArrow(lambda b: _recount(b, bits, shared.value), "print bigint, size int, lang string, phrase string, n bigint")
        again = again.join(open_, "print", "left_semi").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        out = out.unionByName(again)
    phrases = written(out, "frequent-phrases")
    if n_open:
        shared.unpersist()
    return phrases, words


def _whole(c: str) -> Column:
    return F.col(c).cast("decimal(38,0)")


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(phrases: DataFrame, words: DataFrame, top: int = TOP, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` candidates (phrases of two words or more).

    A candidate's score is the least of its cuts; candidates inside a longer one with at least ``inside_percent`` of their
    count go. Products are decimals of 38 digits.
    """
    w = F.split("phrase", " ")
    long = phrases.where("size > 1").withColumnRenamed("n", "a")
    cuts = long.select("lang", "size", "phrase", "a", F.explode(F.expr("sequence(1, size - 1)")).alias("cut"))
    sides = cuts.select("lang", "size", "phrase", "a", "cut", F.inline(F.array(
        F.struct(F.lit(True).alias("left"), _part(w, 1, F.col("cut")).alias("part")),
        F.struct(F.lit(False).alias("left"), _part(w, F.col("cut") + 1, F.col("size") - F.col("cut")).alias("part")))))
    known = phrases.select("lang", F.col("phrase").alias("part"), "n")
    both = sides.join(known, ["lang", "part"]).groupBy("lang", "size", "phrase", "a", "cut").agg(
        F.max(F.when(F.col("left"), F.col("n"))).alias("l"), F.max(F.when(~F.col("left"), F.col("n"))).alias("r"))
    score = F.expr("(cast(1000000 as decimal(7,0)) * (cast(a as decimal(15,0)) * cast(a as decimal(15,0)))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    best = both.groupBy("lang", "size", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    inner = F.filter(
        F.flatten(F.transform(F.expr("sequence(2, size - 1)"), lambda k: F.transform(
            F.sequence(F.lit(1), F.col("size") - k + 1), lambda i: F.array_join(F.slice(w, i, k), " ")))), lambda x: x.isNotNull())
    longer = long.where("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = best.join(most, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a")))
    rows = left.select("lang", "phrase", "a", "best.l", "best.r", "best.score", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranks = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranks.join(F.broadcast(words) if words.count() <= 10_000 else words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 collocations. Phrases of all documents are counted; an empty table gives an empty result."""
    return collocations(*frequent_phrases(table(spark, sf_dir, "documents")))


ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '{NO_LANG}') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), p AS (
  SELECT lang, list_filter(string_split_regex(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda x: x <> '') AS ws FROM d
), g AS (
  SELECT lang, 1 AS size, unnest(ws) AS phrase FROM p
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM p
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM p
), f AS (SELECT lang, size, phrase, count(*) AS n FROM g GROUP BY ALL
), words AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= {LEAST_COUNT}
), cuts AS (
  SELECT c.lang, c.size, c.phrase, a, k, x.n AS l, y.n AS r,
         CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.n AS HUGEINT) * y.n) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c) c
  JOIN f x ON x.lang = c.lang AND x.size = k AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.size = c.size - k AND y.phrase = array_to_string(w[k + 1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_ AS (
  SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a AS longer FROM c WHERE size = 3
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * longer >= {INSIDE_PERCENT} * a)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r.r AS r, words.n AS n, score FROM r JOIN words USING (lang) WHERE rank <= {TOP}
"""
