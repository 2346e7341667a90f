"""Main text of web pages: gradient-boosted trees over DOM-node features, decoded over the tree.

Each block element is a node with features of its subtree (size, link density, sentence marks), its tag, the tokens of its
attributes, its depth and its siblings. Boosted trees score whether it holds main text. Decoding picks the most probable
labelling of the whole tree in which nothing below a rejected node is kept, so ancestors and descendants never contradict.

No table has labels for nodes: the trees are fit on ``TRAINING_PAGES`` pages that ``training_page`` lays out at random with
labels known by construction, the same for every input.
"""

from __future__ import annotations

import html
import math
import random
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm.boosted_trees import Trees, fit
from matchday.llm.tables import table
from matchday.llm.words import chunks

TRAINING_PAGES = 900
#: A node goes only if the odds against it are so many to one.
ODDS = 4

_QUOTES_AND_ENDS, _NAME_END = re.compile(r"[>\"']"), re.compile(r"[\s/>]")
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")
_SENTENCE = re.compile(r"[.!?;:,]")
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Never text of a page.
_SILENT = set("script style template noscript svg math iframe object head title textarea select button option datalist canvas audio video".split())
_RAW = set("script style textarea title noscript iframe".split())
#: Elements of a head; any other start tag, or text, ends it.
_HEAD = set("base basefont bgsound link meta title noscript noframes style script template".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
#: A start tag of the second kind ends an open element of the first.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
_SCOPE = set("table ul ol dl article section div body main aside nav form blockquote td th".split())
_GROUPS = (
    ("article", "main"), ("section", "hgroup"), ("div", "center"), ("p",), tuple(f"h{i}" for i in range(1, 7)), ("ul", "ol", "dl", "menu"),
    ("li", "dt", "dd"), ("nav",), ("header",), ("footer",), ("aside",), ("form", "fieldset", "legend", "dialog"),
    ("table", "tbody", "thead", "tr", "td", "th", "caption"), ("blockquote", "pre", "figure", "figcaption", "address", "details", "summary"), ("body", "html"),
)
_GROUP = {tag: i for i, tags in enumerate(_GROUPS) for tag in tags}
#: Words in attributes, by what they tell.
_MEANING = (
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs skip",
    "header masthead topbar banner logo site hero",
    "footer foot copyright legal colophon bottom",
    "sidebar side rail aside widget widgets column secondary",
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion dfp adsense adslot adbox outbrain taboola",
    "notice notification alert cookie cookies consent gdpr privacy popup modal overlay toast disclaimer announcement paywall",
    "comment comments commentlist reply replies respond response responses disqus discussion thread feedback reviews",
    "form login signin signup subscribe subscription newsletter search contact register",
    "share sharing social related recommended more tags tagcloud author byline meta recent popular trending",
    "article content post entry story main body text page hentry maincontent articlebody prose",
)
_TELLS = {w: i for i, words in enumerate(_MEANING) for w in words.split()}
N_FEATURES = len(_GROUPS) + 2 * len(_MEANING) + 17


class _Tokens:
    """Comments and tags of a page, found in linear time however broken it is.

    A tag ends at the first ``>`` that no closed pair of quotes holds. What follows a quote outside of quotes does not depend on
    where the tag began, so each quote's answer is found once.
    """

    def __init__(self, source: str):
        self._source = source
        self._marks = [m.start() for m in _QUOTES_AND_ENDS.finditer(source)]
        self._ends: dict[int, int] = {}
        self._name = self._angle = (0, -1)  # no end of a name, and no ``>``, lies between these places

    def _name_end(self, at: int) -> int:
        begin, end = self._name
        if not begin <= at <= end:
            m = _NAME_END.search(self._source, at)
            end = m.start() if m else len(self._source)
            self._name = (at, end)
        return end

    def _tag_end(self, at: int) -> int:
        """The place of the ``>``, -1 if there is none."""
        passed, source, marks = [], self._source, self._marks
        while True:
            i = bisect_left(marks, at)
            if i == len(marks):
                end = -1
                break
            at = marks[i]
            if source[at] == ">":
                end = at
                break
            if at in self._ends:
                end = self._ends[at]
                break
            passed.append(at)
            close = source.find(source[at], at + 1)
            at = (close if close >= 0 else at) + 1
        self._ends.update(dict.fromkeys(passed, end))
        return end

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """The next token: its begin and end, whether it is an end tag, its name (empty for a comment), its attributes."""
        source = self._source
        while (begin := source.find("<", at)) >= 0:
            at = begin + 1
            kind = source[at : at + 1]
            if source.startswith("<!--", begin):
                end = source.find("-->", begin + 4)
                return begin, end + 3 if end >= 0 else len(source), False, "", ""
            if kind in ("!", "?"):
                if not self._angle[0] <= at <= self._angle[1]:
                    found = source.find(">", at + 1)
                    self._angle = (at, found if found >= 0 else len(source))
                if self._angle[1] < len(source):
                    return begin, self._angle[1] + 1, False, "", ""
                continue
            name = at + (kind == "/")
            if not (source[name : name + 1].isascii() and source[name : name + 1].isalpha()):
                continue
            stop = self._name_end(name)
            end = self._tag_end(stop)
            if end >= 0:
                return begin, end + 1, kind == "/", source[name:stop], source[stop:end]
        return None


class Page:
    """The block elements of a page, parents before children, and its text blocks in order."""

    def __init__(self, source: str):
        self.parent, self.tag, self.told, self.depth, self.place = [-1], ["html"], [()], [0], [0]
        self.children: list[list[int]] = [[]]
        self.blocks: list[tuple[int, str]] = []
        self.links: list[int] = [0]  # characters inside links
        self._read(source)

    def _node(self, tag: str, parent: int, attributes: str) -> int:
        told = ()
        if attributes:
            told = tuple(sorted({
                _TELLS[w] for _, v in _ATTRIBUTE.findall(attributes) for w in _PART.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", v).lower()) if w in _TELLS}))
        self.parent.append(parent)
        self.tag.append(tag)
        self.told.append(told)
        self.depth.append(self.depth[parent] + 1)
        self.place.append(len(self.children[parent]))
        self.children[parent].append(len(self.tag) - 1)
        self.children.append([])
        self.links.append(0)
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        # open elements: tag, the node that each belongs to, and the inline elements beside it. An element that was taken out
        # from below others keeps its place without a tag.
        stack: list[list] = [["html", 0, {}]]
        beside: list[dict[str, int]] = [{}]  # for each open block, the inline elements open since
        places: dict[str, list[int]] = defaultdict(list)  # of the open elements, by tag
        scopes: list[int] = []
        pieces: list[str] = []
        anchors = silent = 0

        def flush() -> None:
            nonlocal pieces
            if pieces:
                if text := " ".join("".join(pieces).split()):
                    self.blocks.append((stack[-1][1], text))
                pieces = []

        def say(text: str) -> None:
            if silent and stack[-1][0] == "head" and text.strip():
                close(len(stack) - 1)
            if text and not silent:
                text = html.unescape(text) if "&" in text else text
                pieces.append(text)
                if anchors:
                    self.links[stack[-1][1]] += len("".join(text.split()))

        def open_(tag: str, node: int) -> None:
            nonlocal anchors, silent
            if tag in _SCOPE:
                scopes.append(len(stack))
            places[tag].append(len(stack))
            stack.append([tag, node, beside[-1]])
            if tag in _INLINE:
                beside[-1][tag] = beside[-1].get(tag, 0) + 1
            else:
                beside.append({})
            anchors += tag == "a"
            silent += tag in _SILENT

        def close(until: int) -> None:
            nonlocal anchors, silent
            while len(stack) > until:
                tag, _, inline = stack[-1]
                if tag:
                    if tag not in _INLINE:
                        flush()
                        beside.pop()
                    else:
                        inline[tag] -= 1
                    if tag in _SCOPE:
                        scopes.pop()
                    places[tag].pop()
                    anchors -= tag == "a"
                    silent -= tag in _SILENT
                stack.pop()
            while not stack[-1][0]:
                stack.pop()

        tokens, at = _Tokens(source), 0
        while token := tokens.after(at):
            begin, end, ends, name, attributes = token
            say(source[at:begin])
            at = end
            if not name:
                continue
            tag = name.lower()
            if ends:
                # an inline end tag does not end a block
                if beside[-1].get(tag) if tag in _INLINE else places[tag]:
                    close(places[tag][-1])
                continue
            if stack[-1][0] == "head":
                if tag in ("html", "head"):
                    continue
                if tag not in _HEAD:
                    close(len(stack) - 1)
            if tag == "br":
                pieces.append(" ")
            if tag in _VOID:
                if tag == "hr":
                    flush()
                continue
            if tag in ("html", "body") and places[tag]:
                continue
            if tag not in _INLINE:
                flush()
                ended = _ENDS.get(tag, ())
                last = max((places[x][-1] for x in ("p", *ended) if places[x]), default=0)
                if last and last >= (scopes[-1] if scopes else 0):
                    close(last)
                    while stack[-1][0] in ended:
                        close(len(stack) - 1)
            elif tag == "a" and anchors:
                taken = stack[places["a"].pop()]
                taken[0] = ""
                taken[2]["a"] -= 1
                anchors -= 1
                close(len(stack))
            node = stack[-1][1] if tag in _INLINE or tag in _SILENT else self._node(tag, stack[-1][1], attributes)
            open_(tag, node)
            if attributes.endswith("/") and (places["svg"] or places["math"]):
                close(len(stack) - 1)  # self-closed; elsewhere the slash means nothing
                continue
            if tag in _RAW:
                raw_end = re.compile(f"</{tag}\\b", re.IGNORECASE).search(source, at)
                if not raw_end:
                    break
                at = raw_end.start()
        else:
            say(source[at:])
        close(1)
        flush()

    def features(self) -> list[list[float]]:
        """A row for each node."""
        n = len(self.tag)
        chars, marks, blocks, upper = [0] * n, [0] * n, [0] * n, [0] * n
        first = [math.inf] * n
        links, paragraphs, tags = list(self.links), [0] * n, [1] * n
        total = 0
        for i, text in self.blocks:
            size = len(text) - text.count(" ")
            first[i] = min(first[i], total)
            chars[i] += size
            marks[i] += len(_SENTENCE.findall(text))
            blocks[i] += 1
            upper[i] = max(upper[i], size)
            total += size
        own = list(chars)
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            paragraphs[i] += self.tag[i] == "p"
            for values in (chars, marks, blocks, links, paragraphs, tags):
                values[p] += values[i]
            upper[p] = max(upper[p], upper[i])
            first[p] = min(first[p], first[i])
        out = []
        above: list[set[int]] = [set()] * n
        for i in range(n):
            p = max(self.parent[i], 0)
            above[i] = above[p] | set(self.told[i])
            siblings = self.children[p] if i else [0]
            k = len(siblings)
            around = chars[p] - chars[i]
            group, told, higher = [0.0] * len(_GROUPS), [0.0] * len(_MEANING), [0.0] * len(_MEANING)
            if (g := _GROUP.get(self.tag[i])) is not None:
                group[g] = 1.0
            for t in self.told[i]:
                told[t] = 1.0
            for t in above[p]:
                higher[t] = 1.0
            c = chars[i]
            out.append([
                *group, *told, *higher, self.depth[i], math.log1p(c), links[i] / (c + 1), marks[i] / (c + 1), blocks[i], math.log1p(upper[i]),
                c / (tags[i] + 1), math.log1p(own[i]), paragraphs[i], c / (total + 1), c / (chars[p] + 1), self.place[i] / k, k,
                (links[p] - links[i]) / (around + 1), math.log1p(around / k), min(first[i], total) / (total + 1), len(self.children[i]),
            ])
        return out

    def decode(self, score: Sequence[float]) -> list[bool]:
        """The most probable labels, no node kept below one that is not. ``score``: the log-odds of each node, given that its
        parent is kept; below a node that is not kept nothing is left to decide."""
        n = len(self.tag)
        no = [-math.log1p(math.exp(min(s, 30.0))) for s in score]
        yes = [s + x for s, x in zip(score, no, strict=True)]
        for i in range(n - 1, 0, -1):
            yes[self.parent[i]] += max(yes[i], no[i])
        kept = [True] * n
        for i in range(1, n):
            kept[i] = kept[self.parent[i]] and yes[i] >= no[i]
        return kept

    def text(self, kept: Sequence[bool]) -> str:
        return "\n".join(text for i, text in self.blocks if kept[i])


def training_page(rng: random.Random) -> tuple[str, set[str]]:
    """A page laid out at random, and the tokens (unique in it) of its main text."""
    count, main = [0], set()

    def words(low: int, high: int, keep: bool = False) -> str:
        out = []
        for _ in range(rng.randint(low, high)):
            count[0] += 1
            word = "".join(rng.choice("aeioubcdfglmnprst") for _ in range(rng.randint(1, 9))) + f"q{count[0]}"
            if keep:
                main.add(word)
            out.append(word + (rng.choice(".,;!?") if rng.random() < 0.12 else ""))
        return " ".join(out)

    def box(tags: str, tells: str, inner: str, plain: float = 0.12) -> str:
        tag, tell = rng.choice(tags.split()), rng.choice(tells.split()) if tells else ""
        if not tell or (rng.random() < plain and tag not in ("div", "section", "ul", "span", "ol")):
            return f"<{tag}>{inner}</{tag}>"
        extra = rng.choice(["", "", "-wrap", "-inner", "-1", "_box", "-area"])
        return f'<{tag} {rng.choice(["class", "id", "class"])}="{rng.choice(["", "", "x ", "js-"])}{tell}{extra}">{inner}</{tag}>'

    def menu(n: int) -> str:
        items = "".join(f'<li><a href="/{i}">{words(1, 3)}</a></li>' for i in range(n))
        return rng.choice([f"<ul>{items}</ul>", items.replace("li>", "span>"), f"<ul class=\"list\">{items}</ul>"])

    def prose(n: int, keep: bool, low: int = 3, high: int = 90) -> str:
        out = []
        for _ in range(n):
            r = rng.random()
            if r < 0.72:
                out.append(rng.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<div>{}</div>"]).format(words(low, high, keep)))
            elif r < 0.8:
                out.append("<ul>" + "".join(f"<li>{words(2, 14, keep)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            elif r < 0.88:
                out.append(f"<{(h := rng.choice(['h2', 'h3']))}>{words(2, 8, keep)}</{h}>")
            elif r < 0.94:
                out.append(f"<blockquote><p>{words(low, max(low, high // 2), keep)}</p></blockquote>")
            elif r < 0.97:
                out.append(f'<p>{words(low, max(low, high // 4), keep)} <a href="/x">{words(1, 4, keep)}</a> {words(low, max(low, high // 4), keep)}</p>')
            else:
                out.append("<table>" + "".join(f"<tr><td>{words(1, 4, keep)}</td><td>{words(1, 4, keep)}</td></tr>" for _ in range(3)) + "</table>")
        return "".join(out)

    def advert() -> str:
        return box("div div ins section aside", "ad ads advert advertisement ad-slot sponsored promo banner-ad", rng.choice([words(3, 45), f"<p>{words(3, 40)}</p>", f'<a href="/">{words(2, 12)}</a>']))

    def notice() -> str:
        return box("div div section aside dialog", "cookie-notice notice alert consent gdpr cookie-banner popup announcement disclaimer", rng.choice([
            words(4, 40), f"<p>{words(4, 40)}</p><button>{words(1, 2)}</button>", f'<p>{words(4, 30)} <a href="/">{words(1, 3)}</a></p>']))

    def form() -> str:
        return box("form form div", "newsletter subscribe search login signup contact-form", f'<label>{words(1, 4)}</label><input name="a"><p>{words(2, 14)}</p><button>{words(1, 2)}</button>')

    def sidebar() -> str:
        parts = [f"<h3>{words(1, 4)}</h3>" + rng.choice([menu(rng.randint(2, 6)), f"<p>{words(5, 40)}</p>"]) for _ in range(rng.randint(1, 3))]
        return box("aside aside div section", "sidebar side-bar right-rail widget-area secondary", "".join(box("div section", "widget box module", x) for x in parts))

    def comments() -> str:
        each = "comment reply comment-body response"
        return box("section div div ol", "comments comment-list responses discussion replies disqus", (f"<h2>{words(1, 3)}</h2>" if rng.random() < 0.6 else "") + "".join(
            box("div li article div", each, (f'<a href="/u">{words(1, 2)}</a>' if rng.random() < 0.5 else "") + f"<p>{words(3, 70)}</p>" * rng.randint(1, 2))
            for _ in range(rng.randint(1, 6))))

    def related() -> str:
        return box("div section aside ul", "related recommended share social more-stories tags popular", rng.choice([menu(rng.randint(2, 6)), f"<h4>{words(1, 3)}</h4>{menu(3)}"]))

    def maybe(p: float, *makers) -> str:
        return "".join(m() for m in makers if rng.random() < p)

    title = f"<h1>{words(2, 14, True)}</h1>" if rng.random() < 0.85 else ""
    n = rng.choice([1, 1, 2, 3, 5, 8, 14])
    low, high = rng.choice([(3, 90), (3, 90), (2, 8)])
    inner = prose((n + 1) // 2, True, low, high) + maybe(0.15, advert, related, form, notice) + prose(n // 2, True, low, high) + maybe(0.12, related, advert)
    wrapped = rng.random() < 0.25
    story = title + (box("div section", "content entry-content post-body article-body text", inner) if wrapped else inner)
    story = box("article article article div div section main", "post entry story article main-content content hentry page-content", story, plain=0.6)
    comment = comments() if rng.random() < 0.35 else ""
    if rng.random() < 0.3 and comment:
        story = story.replace("</article>", comment + "</article>") if story.endswith("</article>") else story + comment
    else:
        story += comment
    middle = maybe(0.2, advert, notice) + story + maybe(0.25, related, form, sidebar, advert)
    if rng.random() < 0.5:
        middle = box("main div div section", "container wrapper content main layout page row", middle, plain=0.5)
    top = [lambda: box("header header div", "header masthead site-header topbar", rng.choice([words(1, 6), f"<h1>{words(1, 4)}</h1>", f"<p>{words(2, 9)}</p>" + menu(3)])),
           lambda: box("nav nav div ul", "nav menu navbar navigation main-menu", menu(rng.randint(2, 9))), notice, advert]
    rng.shuffle(top)
    foot = box("footer footer footer div", "footer site-footer copyright bottom", rng.choice([
        f"&copy; {words(2, 30)}", f"<p>{words(3, 60)}</p>", menu(5) + f"<p>{words(3, 30)}</p>", prose(2, False)]))
    body = maybe(0.55, *top) + middle + maybe(0.25, sidebar, related, advert, notice) + (foot if rng.random() < 0.9 else "")
    return f"<!DOCTYPE html><html><head><title>{words(1, 4)}</title></head><body>{body}" + ("</body></html>" if rng.random() < 0.9 else ""), main


@lru_cache(1)
def train(pages: int = TRAINING_PAGES, seed: int = 7) -> Trees:
    """Trees fit on generated pages. A node's label: it holds main text. Nodes below one without any are left out, as decoding
    never gets there."""
    rng, x, y = random.Random(seed), [], []
    for _ in range(pages):
        source, main = training_page(rng)
        page = Page(source)
        holds = [False] * len(page.tag)
        for i, text in page.blocks:
            if any(w.strip(".,;!?") in main for w in text.split()):
                while i >= 0 and not holds[i]:
                    holds[i] = True
                    i = page.parent[i]
        for i, row in enumerate(page.features()):
            if i and holds[page.parent[i]]:
                x.append(row)
                y.append(holds[i])
    return fit(np.array(x), np.array(y, float), trees=80, rate=0.35, leaf=0.3)


def main_texts(sources: Sequence[str], trees: Trees) -> list[str]:
    pages = [Page(s) for s in sources]
    rows = [p.features() for p in pages]
    score = (trees.score(np.array([r for x in rows for r in x]).reshape(-1, N_FEATURES)) + math.log(ODDS)).tolist()
    out, at = [], 0
    for p, x in zip(pages, rows, strict=True):
        out.append(p.text(p.decode(score[at : at + len(x)])))
        at += len(x)
    return out


def _rows(batches, trees: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches, "html", most=4 << 20):
        out = main_texts(texts.to_pylist(), trees.value)
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html", trees: Trees | None = None) -> DataFrame:
    """One row for each page: page_id, url, text (blocks in page order, joined by a line feed; empty if none).

    A null source is empty. Broken markup is read leniently: open elements end with the page, unknown tags are blocks. Repeated
    rows and null ids stay; an empty table gives an empty result; other columns are not looked at.
    """
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (page_id, url)}
    known = pages.sparkSession.sparkContext.broadcast(trees or train())
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("html"))
    return rows.mapInArrow(lambda b: _rows(b, known), f"page_id {kinds[page_id]}, url {kinds[url]}, text string")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
