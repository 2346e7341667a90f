"""URL filters, secret scans and quality rules: DuckDB's answer on a whole table, and edge cases."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from check_oracle import duck, rows_of  # noqa: E402
from matchday.llm import quality, secret_scan, url_filter  # noqa: E402
from matchday.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duck(SF)
    got = rows_of(QUERIES[name](spark, SF).toPandas())
    assert got == rows_of(con.execute(ORACLE_SQL[name]).fetchdf())


def test_url_rules(spark):
    urls = [
        (1, None), (2, "no scheme.com/en/"), (3, "HTTP://WWW.Example.COM/en/a?q#f"), (4, "http://a.b.example.com/en/"), (5, "x://example.com"),
        (6, "http://sub.net/es/x"), (7, "http://net/es"), (8, "http://xnet/es/"), (9, "http://example.com/en?x=/en/"), (10, "http://com/a"),
        (4, "http://a.b.example.com/en/"), (11, "http://é.com/ü/"), (12, "http:///en/"), (13, "http://evilexample.com/en/"),
    ]
    df = spark.createDataFrame([(*u, "taken") for u in urls], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in
           url_filter.judge_urls(df, url_filter.rule_table(spark), keep=["page_id", "rule"]).collect()}
    assert got == {
        1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("www.example.com", "/en/a", "www.example.com/en/", "allow"),
        4: ("a.b.example.com", "/en/", "example.com/en/", "block"), 5: ("example.com", "", None, "allow"),
        6: ("sub.net", "/es/x", "net/es/", "block"), 7: ("net", "/es", None, "allow"), 8: ("xnet", "/es/", None, "allow"),
        9: ("example.com", "/en", "com/", "allow"), 10: ("com", "/a", "com/", "allow"), 11: ("é.com", "/ü/", "com/", "allow"),
        12: ("", "/en/", None, "allow"), 13: ("evilexample.com", "/en/", "com/", "allow"),
    }
    assert url_filter.judge_urls(df, url_filter.rule_table(spark)).count() == len(urls)


def test_url_rules_any_shape_ties_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://a.bc/xyz" + "/p" * 3000)], "page_id long, url string")
    rules = spark.createDataFrame(
        [("bc", "/xy", "block"), ("a.bc", "/", "allow"), ("a.bc", "/", "block"), ("bc", "/xyz/p/p", "allow"), (None, "/", "block")],
        "host string, path string, verdict string")
    assert [(r.rule, r.verdict) for r in url_filter.judge_urls(df, rules).collect()] == [("bc/xyz/p/p", "allow")]
    assert [r.verdict for r in url_filter.judge_urls(df, rules.where("path = '/'")).collect()] == ["block"]
    assert [(r.rule, r.verdict) for r in url_filter.judge_urls(df, rules.limit(0)).collect()] == [(None, "allow")]
    assert url_filter.judge_urls(df.limit(0), rules).collect() == []


SECRETS = [
    (1, None), (2, ""), (3, 'é😀 token = "abcdef" x'), (4, "password=abc secret: token :abcdef"), (5, "AKIA" + "A" * 16 + " " + "0" * 24),
    (6, "AKIAX" + "AKIA" + "B" * 16), (7, "API_KEY:" + "f" * 30), (7, "API_KEY:" + "f" * 30), (8, "-----BEGIN RSA PRIVATE KEY-----"),
    (9, "0" * 23 + "g"), (10, ("token=abcdefg " * 300).strip()),
]


def test_secret_spans(spark, tmp_dir):
    df = spark.createDataFrame([(*x, "taken") for x in SECRETS], "doc_id long, text string, found string")
    ledger = secret_scan.scan_versions(df, tmp_dir + "/ledger")
    got = {}
    for r in secret_scan.findings(df, ledger).collect():
        got[r.doc_id] = [(s.kind, s.start, s.end) for s in r.found]
    assert got[1] == got[2] == got[9] == []
    assert got[3] == [("assign", 3, 18)] and got[4] == []
    assert got[5] == [("access", 0, 20), ("hex", 21, 45)] and got[6] == [("access", 0, 25)]
    assert got[7] == [("assign", 0, 38), ("hex", 8, 38)] and got[8] == [("pem", 0, 31)]
    assert len(got[10]) == 300 and got[10][-1] == ("assign", 299 * 14, 299 * 14 + 13)


def test_ledger_scans_only_what_is_new(spark, tmp_dir):
    path = tmp_dir + "/ledger"
    df = spark.createDataFrame(SECRETS[:5], "doc_id long, text string")
    first = secret_scan.scan_versions(df, path).count()
    assert first == len(secret_scan.RULES) * 4  # null and empty are one blob
    assert secret_scan.scan_versions(df, path).count() == first
    newer = [secret_scan.Rule("hex", 2, "[0-9a-f]{12,}"), *secret_scan.RULES]
    assert secret_scan.scan_versions(df, path, newer).count() == first + 4
    more = spark.createDataFrame([(9, "another text"), (3, SECRETS[2][1])], "doc_id long, text string")
    assert secret_scan.scan_versions(more, path).count() == first + 4 + len(secret_scan.RULES)
    assert secret_scan.scan_versions(df.limit(0), path).count() == first + 4 + len(secret_scan.RULES)


def test_redaction(spark, tmp_dir):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(SECRETS, "doc_id long, text string")
    found = secret_scan.findings(df, secret_scan.scan_versions(df, tmp_dir + "/ledger"))
    got = {r.doc_id: r.t for r in found.select("doc_id", secret_scan.redacted(F.col("text"), F.col("found")).alias("t")).collect()}
    assert got[1] is None and got[2] == "" and got[3] == 'é😀 [assign]" x' and got[7] == "[assign]" and got[5] == "[access] [hex]"


def test_quality_of_edge_cases(spark):
    prose = " ".join(f"word{i}" for i in range(30))
    site = "the same line of one site stands in all of its pages"
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t", None), (4, "a b c d e " * 4, "a"), (5, prose, None), (5, prose, None)]
    rows += [(100 + i, f"{site}\n{prose} own{i}", "a") for i in range(12)]
    rows += [(200 + i, f"{site}\n{site.upper()}  \n{site} x{i} y z", "a") for i in range(3)] + [(300, site + "\nx y", "b"), (301, site, "a")]
    rows += [(400 + i, f"copied line of many words that is in one text only\n{prose}", "c") for i in range(20)]
    df = spark.createDataFrame([(*r, "taken") for r in rows], "doc_id long, text string, source string, kept string")
    out = quality.judge_quality(df, keep=["doc_id", "kept"], cleaned="clean")
    got = sorted(((r.doc_id, r.kept, r.clean) for r in out.collect()), key=repr)
    want = brute.quality([(t, s) for _, t, s in rows], quality.LINE_TEXTS, quality.LINE_SHARE, quality.LEAST_LEFT)
    assert got == sorted(((r[0], *w) for r, w in zip(rows, want)), key=repr)
    kept = {d: k for d, k, _ in got}
    assert kept[100] and kept[5] and kept[400] and not kept[301] and not kept[4]
    assert quality.judge_quality(df.limit(0), keep=["doc_id"]).collect() == []


def test_the_share_decides_on_hosts_of_over_1000_texts(spark):
    own = lambda host, i: " ".join(f"{host}{i}w{j}" for j in range(12))
    rows = [(f"{host}{i}", own(host, i) + (f"\nLine of {host}" if i < n else ""), host)
            for host, texts, n in (("a", 1000, 10), ("b", 1500, 14), ("c", 1500, 15), ("d", 1000, 9)) for i in range(texts)]
    rows += [(f"copy{i}", rows[0][1], "a") for i in range(700)]  # copies of a text count once
    got = {r.doc_id: r.n_removed_words for r in quality.judge_quality(
        spark.createDataFrame(rows, "doc_id string, text string, source string"), keep=["doc_id"]).collect()}
    assert [got[f"{h}0"] for h in "abcd"] == [3, 0, 3, 0] and got["a10"] == got["c15"] == 0 and got["copy3"] == 3


def test_private_names_do_not_clash(spark, tmp_path):
    rows = [(1, "token = abcdefgh", "b", "h", "t"), (2, None, "b", "h", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _blob string, _host string, _text_id string").withColumn("source", F.lit("s"))
    both = [*secret_scan.RULES, *[type(r)(**{**r.__dict__, "version": r.version + 1}) for r in secret_scan.RULES[:1]]]
    ledger = secret_scan.scan_versions(df, f"{tmp_path}/ledger", rules=both)
    got = {r.doc_id: r for r in secret_scan.findings(df, ledger, rules=both).collect()}
    assert got[1]["_blob"] == "b" and got[2].found == [] and len(got[1].found) == 2 * len(
        {r.doc_id: r for r in secret_scan.findings(df, ledger).collect()}[1].found)
    kept = quality.judge_quality(df, keep=["doc_id", "_host", "_text_id", "_blob"]).collect()
    assert {(r.doc_id, r["_host"], r["_text_id"], r["_blob"]) for r in kept} == {(1, "h", "t", "b"), (2, "h", "t", "b")}
