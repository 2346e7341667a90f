"""URL filters: rules over hosts and path prefixes, by hash prefixes and full digests.

Every URL is expanded into the host suffixes and path prefixes of the shapes that the rules have (labels in the host,
characters in the path); the expressions meet the rules on the first 32 bits of their SHA-256, the whole digest confirms,
and the longest rule wins. Native DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday.llm.tables import table
from matchday.sources.tables import local_table

#: Fixed by the query's contract: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DEFAULT_VERDICT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PREFIX = 8  # hexadecimal digits


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("host", "path", "verdict")])
    return local_table(spark, list(rules), schema)


def _after_scheme(url):
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    return F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))


def host_of(url):
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url):
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def judge_urls(urls: DataFrame, rules: DataFrame, url: str = "url", keep: Sequence[str] = (),
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row for each row of ``urls``: the columns ``keep``, and host, path, rule, verdict.

    A rule fits its host and that host's subdomains if the path starts with the rule's path. The longest rule (host and
    path together) wins; of equally long ones that with more host labels, then ``block``. No rule: a null rule and the
    default verdict. A null URL or one without ``://`` has an empty host and path, which no rule with a host fits. An empty
    rule table gives the default everywhere; rules with a null host, path or verdict are left out. Columns besides ``url`` and
    ``keep`` are not looked at, and a kept column named like an output gives way to it. Repeated rows stay.

    The shapes of the rules (a pair of small numbers for each combination in use) are read by the driver.
    """
    r = rules.dropna(subset=["host", "path", "verdict"]).select(
        "host", "path", "verdict", F.concat("host", "path").alias("rule"), F.size(F.split("host", r"\.")).alias("labels")
    ).dropDuplicates(["host", "path", "verdict"])
    shapes = [tuple(x) for x in r.select("labels", F.length("path")).distinct().collect()]
    out = [F.col(f"`{c}`") for c in keep if c not in ("host", "path", "rule", "verdict")]
    rows = urls.select(*out, host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    if not shapes:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    digest = F.sha2(F.concat(F.lit(""), "expression"), 256)
    expressions = (
        rows.select("host", "path").distinct()
        .withColumn("_labels", F.split("host", r"\."))
        .withColumn("_shape", F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(m).alias("m")) for n, m in shapes])))
        .where((F.size("_labels") >= F.col("_shape.n")) & (F.length("path") >= F.col("_shape.m")))
        .select("host", "path", F.concat(
            F.array_join(F.expr("slice(_labels, -_shape.n, _shape.n)"), "."), F.expr("left(path, _shape.m)")
        ).alias("expression"))
        .withColumn("digest", digest)
        .withColumn("prefix", F.left("digest", F.lit(_PREFIX)))
    )
    known = (
        r.select("rule", "verdict", "labels", F.sha2("rule", 256).alias("rule_digest"))
        .withColumn("prefix", F.left("rule_digest", F.lit(_PREFIX)))
    )
    best = (
        expressions.join(known, "prefix").where(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "labels", F.col("verdict") == "block")).alias("best"))
    )
    return rows.join(best, ["host", "path"], "left").select(
        *out, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark), keep=["page_id"])


ORACLE_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT row_number() OVER () AS k, page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r(rhost, rpath, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT k, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY k ORDER BY length(rhost || rpath) DESC) AS n
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM p LEFT JOIN fits f ON f.k = p.k AND f.n = 1
"""
