"""Quality rules: counts within each document, and line frequency across the documents of a host.

A normalised line (words lower-cased, single spaces) that stands in many distinct texts of one host is a line of the site,
not of the document. Such lines are removed, and a document of which too little is left is rejected. Native DataFrame
operations only; no row ever holds more than one document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm.scratch import written
from matchday.llm.tables import table

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
#: Words of a window for the repetition rule; fixed by the query's contract, as are the two limits of the base rules.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: A line is the host's if it stands in this many distinct texts, and in this share of the host's distinct texts.
LINE_TEXTS, LINE_SHARE = 10, 0.01
#: A document is depleted if less than this share of its words is left.
LEAST_LEFT = 0.2


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACE, -1), "")


def lines_of(text: Column) -> Column:
    """Lines (split at ``\\n``) that have a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: F.regexp_like(x, F.lit(_WORD)))


def _line_key(line: Column) -> Column:
    return F.xxhash64(F.lower(F.array_join(words_of(line), " ")))


def _repeated_words(words: Column) -> Column:
    """Words in windows that occur twice or more. Windows are compared by 64-bit hashes, within one document only."""
    def covered(grams: Column) -> Column:
        ordered = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            marked = F.transform(s, lambda x, j: F.struct(x["i"].alias("i"), (
                F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))
            ).alias("twice")))
            return F.sort_array(F.transform(F.filter(marked, lambda x: x["twice"]), lambda x: x["i"]))

        # each window adds the words up to the next one, the last its whole width
        return _let(ordered, lambda s: _let(positions(s), lambda p: F.aggregate(
            F.transform(p, lambda v, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - v, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda a, v: a + v)))

    def count(w: Column) -> Column:
        grams = F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]))
        return _let(grams, lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(F.lit(0).cast("long")))

    return F.when(F.size(words) >= WINDOW, count(words)).otherwise(F.lit(0).cast("long"))


def document_counts(text: Column) -> Column:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text, as a struct of bigint."""
    long = lambda c, name: c.cast("long").alias(name)
    return _let(words_of(text), lambda w: _let(lines_of(text), lambda lines: F.struct(
        long(F.size(w), "n_words"),
        long(F.length(F.array_join(w, "")), "word_chars"),
        long(F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")), "n_symbols"),
        long(F.size(lines) - F.size(F.array_distinct(lines)), "n_dup_lines"),
        _repeated_words(w).alias("n_repeat_words"),
    )))


def host_lines(lines: DataFrame, texts: int = LINE_TEXTS, share: float = LINE_SHARE) -> DataFrame:
    """The lines of each host that are to go: host, line. ``lines``: host, text_id, lines, a row for each distinct text."""
    each = lines.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
    sizes = lines.groupBy("host").agg(F.count("*").alias("n_texts"))
    return (
        each.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= texts)
        .join(sizes, "host").where(F.col("n") >= share * F.col("n_texts")).select("host", "line")
    )


def judge_quality(docs: DataFrame, keep: Sequence[str], text: str = "text", host: str = "source", cleaned: str | None = None,
                  texts: int = LINE_TEXTS, share: float = LINE_SHARE, least_left: float = LEAST_LEFT) -> DataFrame:
    """One row for each document: the columns ``keep``, the counts, base_failed, n_removed_words, kept.

    ``cleaned`` names a further column with the text without its host's lines (null if the text is null). A null text counts
    as empty and fails; a null host is a host of its own. An empty table gives an empty result. Repeated rows stay, and other
    columns are not looked at; a kept column named like an output gives way to it.
    """
    t = F.col(f"`{text}`")
    whole = F.coalesce(t, F.lit(""))
    outputs = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "kept", cleaned}
    kept = [c for c in keep if c not in outputs]
    key = [F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("\0")).alias("_host"), F.xxhash64(whole, F.length(whole)).alias("_text_id")]
    lines = written(
        docs.select(*key, F.transform(lines_of(whole), lambda x: F.struct(
            _line_key(x).alias("line"), F.size(words_of(x)).alias("n"))).alias("lines"))
        .groupBy(F.col("_host").alias("host"), F.col("_text_id").alias("text_id")).agg(F.first("lines").alias("lines")),
        "host-lines",
    )
    removed = (
        lines.select("host", "text_id", F.explode("lines").alias("l")).select("host", "text_id", "l.line", "l.n")
        .join(host_lines(lines, texts, share), ["host", "line"])
        .groupBy(F.col("host").alias("_host"), F.col("text_id").alias("_text_id"))
        .agg(F.sum("n").alias("_sum"), F.collect_set("line").alias("_bad"))
    )
    own = [F.col(f"`{c}`").alias(f"_keep_{i}") for i, c in enumerate(kept)]
    rows = docs.select(
        *own, *key, document_counts(whole).alias("_c"), *([t.alias("_t")] if cleaned else []))
    both = rows.join(removed, ["_host", "_text_id"], "left")
    gone = F.coalesce(F.col("_sum"), F.lit(0)).cast("long")
    failed = (F.col("_c.n_words") < LEAST_WORDS) | (100 * F.col("_c.n_repeat_words") > MOST_REPEATED * F.col("_c.n_words"))
    left = F.col("_c.n_words") - gone
    out = [
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(kept)], "_c.*", failed.alias("base_failed"), gone.alias("n_removed_words"),
        (~failed & (left >= least_left * F.col("_c.n_words"))).alias("kept"),
    ]
    if cleaned:
        clean = F.array_join(F.filter(F.split("_t", "\n", -1), lambda x: ~F.array_contains("_bad", _line_key(x))), "\n")
        out.append(F.when(F.col("_bad").isNull(), F.col("_t")).otherwise(clean).alias(cleaned))
    return both.select(*out)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return judge_quality(docs, keep=["doc_id"])


ORACLE_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT k, t, list_filter(string_split_regex(t, '{_SPACE}'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls FROM d
), g AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, gram) AS n
  FROM (SELECT k, i, array_to_string(ws[i:i + {WINDOW} - 1], ' ') AS gram
        FROM (SELECT k, ws, unnest(range(1, len(ws) - {WINDOW} + 2)) AS i FROM w))
), r AS (
  SELECT k, count(DISTINCT p) AS n_repeat_words FROM (SELECT k, unnest(range(i, i + {WINDOW})) AS p FROM g WHERE n > 1) GROUP BY k
), l AS (
  SELECT k, host, t, len(lw) AS n, lower(array_to_string(lw, ' ')) AS line
  FROM (SELECT k, t, list_filter(string_split_regex(unnest(ls), '{_SPACE}'), lambda x: x <> '') AS lw FROM w) JOIN d USING (k, t)
), bad AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT t) AS n FROM l GROUP BY host, line)
  JOIN (SELECT host, count(DISTINCT t) AS texts FROM d GROUP BY host) USING (host)
  WHERE n >= {LINE_TEXTS} AND n >= {LINE_SHARE} * texts
), gone AS (SELECT k, sum(n) AS n FROM l JOIN bad USING (host, line) GROUP BY k
), c AS (
  SELECT k, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines FROM w
), a AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_words,
         n_words < {LEAST_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {MOST_REPEATED} * n_words AS base_failed
  FROM d JOIN c USING (k) LEFT JOIN r USING (k) LEFT JOIN gone USING (k)
)
SELECT *, NOT base_failed AND n_words - n_removed_words >= {LEAST_LEFT} * n_words AS kept FROM a
"""
