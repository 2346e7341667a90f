"""Secret scans over a ledger of content-addressed blobs.

Every version of every document is a blob, named by the SHA-256 of its text. The ledger has a row for each pair of blob
and rule version that was ever scanned, with the spans found. A run scans only pairs that are missing, appends them, and
joins the findings back to all rows that hold the blob. Native DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm.tables import table
from matchday.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """``pattern``: a Java regular expression. A match counts if the length of its ``group`` is ``least`` at least."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed by the query's contract. Runs of one character class are matched with their least length at once: a shorter run
#: cannot hold a longer match.
BASE = (
    Rule(
        "assign", 1,
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6,
    ),
    Rule("access", 1, "AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, "[0-9a-f]{24,}"),
)
#: Spans that the operator adds: private key blocks and tokens with a fixed prefix.
ADDED = (
    Rule("pem", 1, "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("prefixed", 1, "(?:gh[opsu]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,})"),
)
RULES = BASE + ADDED
_SPAN = "array<struct<start: bigint, end: bigint>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.transform(F.array(value), body)[0]


def spans(text: Column, rule: Rule) -> Column:
    """Code point offsets (end exclusive) of the leftmost non-overlapping matches that count, in order.

    The pieces between the matches and the matches themselves alternate, so running sums of their lengths are the offsets.
    """
    # every piece with its match: a struct of lengths
    def located(pieces: Column, found: Column, counted: Column) -> Column:
        steps = F.transform(found, lambda m, i: F.struct(
            F.length(F.get(pieces, i)).cast("long").alias("gap"), F.length(m).cast("long").alias("size"),
            F.length(F.get(counted, i)).alias("counts")))
        rolled = F.aggregate(
            steps,
            F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("out")),
            lambda acc, s: F.struct(
                (acc["at"] + s["gap"] + s["size"]).alias("at"),
                F.when(s["counts"] >= rule.least, F.concat(acc["out"], F.array(F.struct(
                    (acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["gap"] + s["size"]).alias("end")))))
                .otherwise(acc["out"]).alias("out"),
            ),
        )
        return rolled["out"]

    p = F.lit(rule.pattern)
    several = _let(F.split(text, rule.pattern, -1), lambda pieces: _let(F.regexp_extract_all(text, p, F.lit(0)), lambda found: _let(
        F.regexp_extract_all(text, p, F.lit(rule.group)) if rule.group else found, lambda counted: located(pieces, found, counted))))
    return F.when(F.regexp_like(text, p), several).otherwise(F.array().cast(_SPAN))


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan_versions(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """Brings the ledger up to date with ``versions`` and returns it: blob, kind, version, spans.

    ``ledger`` is the path of the ledger table, made if it does not exist. Its rows are only ever added, for pairs of blob and
    (kind, version) that it lacks; blobs without a finding have a row with no spans, so that they are not scanned again.
    Each distinct text is scanned once however many rows hold it; null counts as the empty text. An empty table adds nothing.
    A run that fails before its append is committed leaves the ledger as it was.
    """
    spark = versions.sparkSession
    schema = f"blob string, kind string, version int, spans {_SPAN}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(ledger)
    exists = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    blobs = (
        versions.select(blob_of(whole).alias("blob"), whole.alias("text"))
        .groupBy("blob").agg(F.first("text").alias("text"))
    )
    wanted = F.array(*[F.lit(f"{r.kind}:{r.version}") for r in rules])
    if exists:
        seen = (
            spark.read.schema(schema).parquet(ledger)
            .groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", "version")).alias("seen"))
        )
        blobs = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
        blobs = blobs.where(F.size(F.array_except(wanted, "seen")) > 0)
    else:
        blobs = blobs.withColumn("seen", F.array().cast("array<string>"))
    entries = [
        F.when(~F.array_contains("seen", f"{r.kind}:{r.version}"), F.struct(
            F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), spans(F.col("text"), r).alias("spans")))
        for r in rules
    ]
    (
        blobs.select("blob", F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
        .select("blob", "e.kind", "e.version", "e.spans")
        .write.mode("append").parquet(ledger)
    )
    return spark.read.schema(schema).parquet(ledger)


def findings(versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``versions`` with column ``found``: the spans of its blob under ``rules`` by start, then kind as the rules list them.

    A column of that name is replaced; all other columns stay, whatever their names, and rows stay as they are, repeated ones
    too. Of two versions of a kind in ``rules``, both give their spans.
    """
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(f"{r.kind}:{r.version}"), F.lit(i))])
    named = F.concat_ws(":", "kind", "version")
    key = "_blob"
    while key in versions.columns:
        key += "_"
    held = (
        ledger.where(named.isin([f"{r.kind}:{r.version}" for r in rules]) & (F.size("spans") > 0))
        .dropDuplicates(["blob", "kind", "version"])
        .select(F.col("blob").alias(key), "kind", order[named].alias("nth"), F.explode("spans").alias("s"))
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("s.start", "nth", "s.end", "kind"))).alias("found"))
    )
    none = "array<struct<start: bigint, nth: int, end: bigint, kind: string>>"
    return (
        versions.drop("found").withColumn(key, blob_of(F.col(f"`{text}`"))).join(held, key, "left").drop(key)
        .withColumn("found", F.coalesce("found", F.array().cast(none)))
    )


def redacted(text: Column, found: Column) -> Column:
    """``text`` with every span replaced by ``[kind]``; of spans that overlap, the first to start covers the rest."""
    rolled = F.aggregate(
        found,
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(
                acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                F.lit("["), s["kind"], F.lit("]"))).otherwise(acc["out"]).alias("out"),
        ),
    )
    rest = _let(rolled, lambda r: F.concat(r["out"], F.substring(text, (r["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(found) == 0, text).otherwise(rest)


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = scan_versions(docs, scratch_path(spark, "llm-secret-ledger"))
    found = findings(docs, ledger).drop("text")
    base = F.filter("found", lambda s: s["nth"] < len(BASE))
    n = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"), F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
    )


def _oracle() -> str:
    rules = " UNION ALL ".join(
        f"SELECT '{r.kind}' AS kind, {i} AS nth, {r.least} AS least, k, string_split_regex(t, p) AS pieces, "
        f"regexp_extract_all(t, p, 0) AS whole, regexp_extract_all(t, p, {r.group}) AS counted "
        "FROM (SELECT k, t, '" + r.pattern.replace("'", "''") + "' AS p FROM d)"
        for i, r in enumerate(RULES)
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({rules}),
e AS (SELECT k, kind, nth, least, pieces, whole, counted, unnest(range(1, len(whole) + 1)) AS i FROM m),
o AS (
  SELECT k, kind, nth, least, length(whole[i]) AS size, length(counted[i]) AS n,
         sum(length(pieces[i])) OVER w + sum(length(whole[i])) OVER w - length(whole[i]) AS start
  FROM e WINDOW w AS (PARTITION BY k, kind ORDER BY i)
), s AS (
  SELECT k, kind, nth, CAST(start AS BIGINT) AS start,
         concat(kind, ':', CAST(start AS BIGINT), ':', CAST(start + size AS BIGINT)) AS span FROM o WHERE n >= least
), f AS (
  SELECT k, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY start, nth) FILTER (nth < {len(BASE)}) AS base,
         string_agg(span, ',' ORDER BY start, nth) AS spans
  FROM s GROUP BY k
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN f USING (k)
"""


ORACLE_SQL = _oracle()
