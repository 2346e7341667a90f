"""Main text of pages (held-out accuracy) and pseudonyms (permutations)."""

import datetime as dt
import html
import random
import re
import time

import pytest

from matchday.llm import html_text, pseudonyms
from matchday.llm.boosted_trees import fit
from matchday.llm.scratch import importable


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


@pytest.fixture(scope="module")
def trees():
    return html_text.train()


def test_held_out_pages(trees):
    rng, hit, extra, lost = random.Random(12345), 0, 0, 0
    for _ in range(200):
        source, main = html_text.training_page(rng)
        got = {w.strip(".,;!?") for w in html_text.main_texts([source], trees)[0].split()}
        hit, extra, lost = hit + len(got & main), extra + len(got - main), lost + len(main - got)
    assert hit / (hit + lost) > 0.99 and hit / (hit + extra) > 0.95


def test_articles_of_the_table(spark, trees):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    right = 0
    for r, got in zip(rows, html_text.main_texts([r.html for r in rows], trees)):
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:p|h1)>", article))
        right += got == "\n".join(x for x in blocks if x)
    assert right >= 0.99 * len(rows)


def test_other_layouts(trees):
    text = "A sentence of the article that has some words in it, and a second part."
    page = f"""<html><body><header class="site-header"><p>Name of the site</p></header><div id="menu"><a href="/">Home</a> <a href="/b">Blog</a></div>
    <div class="cookie-banner"><p>We use cookies &amp; more.</p><button>OK</button></div><div class="post"><h1>Title &lt;1&gt;</h1>
    <p>{text}<p>{text} <em>two</em>\n three</p><ul><li>{text}</li></ul></div><section id="comments"><div class="comment"><p>{text}</p></div></section>
    <aside class="sidebar"><p>{text}</p></aside><form class="newsletter"><p>Your mail</p><input></form><footer>&copy; site</footer></body></html>"""
    assert html_text.main_texts([page], trees)[0] == f"Title <1>\n{text}\n{text} two three\n{text}"


def test_labels_never_contradict(trees):
    rng = random.Random(3)
    for _ in range(50):
        page = html_text.Page(html_text.training_page(rng)[0])
        kept = page.decode([rng.uniform(-4, 4) for _ in page.tag])
        assert all(kept[p] for i, p in enumerate(page.parent) if i and kept[i])


def test_broken_and_empty_pages(spark):
    deep = "<div>" * 3000 + "x" + "</div>" * 10
    sources = [None, "", "   ", "no markup at all", "<p", "</b></p>text", "<script>if (a < b) {", "<!-- never ends", "<a><a><a>x", deep, "<p>" * 5000,
               "<td>a<td>b<table><tr><td>c</table>", '<p title="a>b">c</p>', "&#x110000;&bogus;&amp"]
    rows = [(i, None if i % 3 else f"u{i}", s, "x") for i, s in enumerate(sources)] + [(0, "u0", None, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(df).collect()
    assert len(got) == len(rows) and all(r.text is not None for r in got)
    assert {r.text for r in got if r.page_id in (0, 1, 2)} == {""}
    assert html_text.extract(df.limit(0)).collect() == []


def test_pages_without_an_end_of_the_head(trees):
    text = "A sentence of the article that has some words in it, and a second part."
    head = "<meta charset=utf-8><title>T</title><style>p {}</style><script>var a;</script><noscript><p>n</p></noscript><template><p>t</p></template><link href=x>"
    body = f"<div class=post><h1>Title</h1><p>{text}</p><p>{text}</p></div>"
    want = f"Title\n{text}\n{text}"
    for source in (
        f"<html><head>{head}</head><body>{body}", f"<html><head>{head}<body>{body}</body></html>", f"<html><head>{head}{body}", f"<head>\n{head}\n</head>{body}",
        f"<head><head>{head}<body>{body}", f"<head><html>{head}<body>{body}", f"<head>{head}<img src=x>{body}</head>", f"<head><!-- c -->{head}</head><head>{body}",
    ):
        assert html_text.main_texts([source], trees)[0] == want, source
    assert html_text.Page(f"<head>{head}{text}").blocks == [(0, text)]
    assert html_text.Page(f"<head>{head}&nbsp;<b>{text}").blocks == [(0, text)]


def test_self_closed_drawings(trees):
    text = "A sentence of the article that has some words in it, and a second part."
    for mark in ("<svg class='i' />", "<svg/>", '<svg width="10"/>', "<math/>", "<svg><title/><path d=''/><style/></svg>", "<svg><title>no</title><g/></svg>"):
        page = f"<html><head><title>T</title></head><body><div class=post>{mark}<h1>Title</h1><p>{text}</p><p>{mark}{text}</p></div></body></html>"
        assert html_text.main_texts([page], trees)[0] == f"Title\n{text}\n{text}", mark
    # a slash does not close other elements
    assert html_text.Page("<script src=x />no</script><p/>yes").blocks == [(1, "yes")]


def test_trees_learn():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = fit(x[:1500], y[:1500], trees=20, depth=3)
    assert ((model.score(x[1500:]) > 0) == y[1500:]).mean() > 0.95


def test_permutations():
    for n in (1, 2, 3, 10, 97, 1000):
        new = [pseudonyms.permute(i, n, b"k", b"t") for i in range(n)]
        assert sorted(new) == list(range(n))
        assert n == 1 or all(i != x for i, x in enumerate(new))
    assert pseudonyms.permute(5, 10**15, b"k", b"t") != pseudonyms.permute(5, 10**15, b"other", b"t")


def test_dates_of_all_spellings_stay_apart():
    """No two spellings share a pseudonym, none stays, and each is read as the spelling that it came from."""
    first, seen = dt.date(1900, 1, 1), {}
    for i in range((dt.date(2099, 12, 31) - first).days + 1):
        day = first + dt.timedelta(i)
        for form in ("%m/%d/%Y", "%d/%m/%Y", *(("%Y-%m-%d", "%d.%m.%Y") if i % 9 == 0 else ())):
            value = day.strftime(form)
            if value in seen:
                continue
            new = seen[value] = pseudonyms._date(value, b"k")
            assert new != value
    assert len(set(seen.values())) == len(seen)
    assert all(new in seen for value, new in seen.items() if "/" in value)


def test_short_names_do_not_stay():
    for c in "abcdefghijklmnopqrstuvwxyz0123456789":
        assert pseudonyms._email(f"{c}@x.org", b"k") != f"{c}@x.org"


@pytest.mark.parametrize("part, n", [("<x>", 1), ("<a ", 1), ("<a", 1), ("<a '\"", 1), ("<!\"", 1), ("<a><b>", 1), ("<a><li>", 1), ("<div>", 2)])
def test_pages_are_read_in_linear_time(part, n):
    """A megabyte of what took time in the square of its length."""
    page = part * ((1 << 20) // len(part) // n) + ("</y></span>" * 40_000 if n > 1 else ">")
    begin = time.monotonic()
    html_text.Page(page)
    assert time.monotonic() - begin < 30


def test_what_is_found_and_how_it_looks():
    key = b"k"
    text = ("Mail a.B-c@Ex.com or +1 (017) 555-7713, card 4111 1111 1111 1111, not 4111111111111112; 4111111111111111 from 10.1.2.3 (not 10.1.2.300, "
            "1.2.3.4.5, v2.0.1) on 2024-02-29, 31/12/1999, 30.02.2001 and 123-45-6789; DE89 3704 0044 0532 0130 00. 9807915762804490 é")
    found = pseudonyms.find(text, key)
    assert [(k, text[s:e]) for s, e, k, _ in found] == [
        ("email", "a.B-c@Ex.com"), ("phone", "+1 (017) 555-7713"), ("card", "4111 1111 1111 1111"), ("card", "4111111111111111"), ("ip", "10.1.2.3"),
        ("date", "2024-02-29"), ("date", "31/12/1999"), ("ssn", "123-45-6789"), ("iban", "DE89 3704 0044 0532 0130 00")]
    for s, e, kind, new in found:
        if kind != "ip":
            assert re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "0", new))) == re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "0", text[s:e])))
        # a pseudonym is a value of its kind, and validates
        again = pseudonyms.find(f" {new} ", key)
        assert [k for _, _, k, _ in again] == [kind] and new != text[s:e]
    cards = [n.replace(" ", "") for _, _, k, n in found if k == "card"]
    assert cards[0] == cards[1] and pseudonyms.luhn(cards[0]) == 0


def test_values_beside_other_numbers_and_words():
    iban = "DE89370400440532013000"
    for text, kind, value in (
        ("12 4111 1111 1111 1111", "card", "4111 1111 1111 1111"), ("4111 1111 1111 1111 123", "card", "4111 1111 1111 1111"),
        (f"{iban} BIC COBADEFFXXX", "iban", iban), (f"{iban} 2024", "iban", iban), (f"AB12 {iban} EUR", "iban", iban),
        ("2024-02-29T10:00:00Z", "date", "2024-02-29"), ("a..b@x.org@y.com", "email", "x.org@y.com"),
    ):
        assert (kind, value) in [(k, text[s:e]) for s, e, k, _ in pseudonyms.find(text, b"k")], text
    assert pseudonyms.find("2024-02-29Tuesday 2024-02-29_1", b"k") == []


def _all_substrings(text, key):
    """The values in a text, with every substring tried."""
    from functools import cache

    new, found = cache(lambda kind, value: kind.new(value, key)), []
    for i in range(len(text)):
        for rank, kind in enumerate(pseudonyms.KINDS):
            ends = []
            for j in range(i + 1, len(text) + 1):
                if kind.pattern.fullmatch(text, i, j) and kind.after.match(text, j) and (x := new(kind, text[i:j])) is not None:
                    ends.append((not (kind.likely and kind.likely(text[i:j])), -j, x))
            if ends:
                _, end, x = min(ends)
                found.append((i, end, rank, x))
    out, at = [], 0
    for i, end, rank, x in sorted(found):
        if i >= at:
            out.append((i, -end, pseudonyms.KINDS[rank].name, x))
            at = -end
    return out


def test_find_equals_a_search_of_all_substrings():
    rng, kinds = random.Random(11), set()
    values = ["4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82WEST12345698765432",
              "10.1.2.3", "123-45-6789", "2024-02-29", "31/12/1999", "+1 (017) 555-7713", "+49 30 1234 5678", "212-555-0199", "a.b@x.org", "a..b@x.org"]
    for _ in range(500):
        parts = []
        for _ in range(rng.randint(1, 5)):
            r = rng.random()
            parts.append(rng.choice(values) if r < 0.5 else "".join(rng.choice("0123456789") for _ in range(rng.randint(1, 6))) if r < 0.8 else rng.choice(
                ["BIC", "X", "T10:00", "AB12", "é", "+", "(", "a@b", "word"]))
            parts.append(rng.choice([" ", " ", " ", "-", ".", ",", "@", "T", "", "/"]))
        text = "".join(parts)
        got = pseudonyms.find(text, b"k")
        assert got == _all_substrings(text, b"k"), text
        kinds |= {k for _, _, k, _ in got}
    assert len(kinds) == len(pseudonyms.KINDS)


def test_values_stay_linked_across_documents(spark):
    rows = [(1, "to x@y.org now"), (2, "X@y.org"), (3, None), (4, ""), (4, ""), (None, "x@y.org z@y.org"), (5, "1" * 60 + " ١٢٣٤٥٦٧٨٩٠١٢٣٤٥٦")]
    df = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pseudonyms.pseudonymise(df, b"key").collect()}
    name = got[1].text.split()[1]
    assert got[2].text.lower() == name and got[None].text.split()[0] == name and got[None].text.split()[1] != name
    assert got[None].n_email == 2 and got[1].spans == "email:3:10" and got[3].text == got[4].text == "" and got[5].text == rows[-1][1]
    assert pseudonyms.pseudonymise(df, b"other").where("doc_id = 2").first().text != got[2].text
    assert pseudonyms.pseudonymise(df.limit(0), b"key").collect() == []
