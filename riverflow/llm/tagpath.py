"""HTML extraction by tag-path ratios.

A page is read as text nodes, each with its path of open tags from the root.
Per path: ratio = characters per node, and marks = punctuation per node; the
two are fused as ratio * log2(2 + marks).  The fused values are smoothed over
the page's sequence of nodes (Gaussian, ``RADIUS`` nodes to each side) and
averaged per path; paths at or above the threshold, a share of the page's
spread, are content, also inside an article or main element, whose paths (but
not links) count ``BOOST``-fold.  Since whole paths are chosen, a short
paragraph stays with its long siblings, and inline parts stay with their block.
All articles and mains with content text bound the result if they hold at least
half of it; otherwise nothing chosen is left out.  Headings inside the innermost
element around all chosen text stay with it.  So does other text of paths below
the threshold (tables, short lists, code, captions) inside the bounding articles
or, without these, between chosen nodes of that element, but for elements of
several links and hardly any other text.

Boilerplate by name (fixed lists below) is cut while reading: navigation,
footers, asides, forms, scripts; and elements of which a whole class, id or role
token is listed, or starts with one of a few words.  Such an element stays if an
article or main is in it or, on a page without one, most of the good text; and,
if only a weak word names it, as prose inside an article or main.

Defined cases: NULL, empty or textless html gives the empty text.  Unclosed
tags close with their parents, a paragraph with the next one.  Rows are read
one by one; extra columns are ignored.
"""

from __future__ import annotations

import html as H
import math
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverflow.llm.common import ready, table

RADIUS = 2
SIGMA = 1.0
SHARE = 0.35       # of the standard deviation of the smoothed values
BOOST = 4.0        # of paths below an article or main, links excepted
LINKED = 0.8       # of an element's characters, from which on it is a list of links

# Elements by name.
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "textarea", "title", "annotation", "object", "canvas")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
          "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u",
          "var", "wbr", "math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext", "mspace", "msup", "msub", "msubsup",
          "mfrac", "msqrt", "mroot", "mover", "munder", "munderover", "mstyle", "mpadded", "menclose"}
CUT = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "head", "fieldset", "header"}
MAIN = {"article", "main"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSED_BY = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
CUT_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs",
             "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "login",
             "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo",
             "related", "replies", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor",
             "sponsored", "subscribe", "toolbar", "widget"}
# words that name boilerplate as the first part of a token, too
CUT_PREFIXES = {"ad", "ads", "advert", "advertisement", "cookie", "disqus", "gdpr", "newsletter", "sponsored"}
# words that also name a topic: not enough for prose in an article
WEAK_WORDS = {"header", "related", "search", "share", "sharing", "social"}
NOT_ADVERTS = {"ad-hoc", "ad-hominem", "ad-infinitum", "ad-interim", "ad-lib", "ad-nauseam"}
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/)?(?P<name2>[a-zA-Z][^\s/>]*)[^>]*>", re.S | re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_FIRST = re.compile(r"([a-z]+)[-_]")


class Page:
    """A page as elements, numbered in page order below a root 0, each with its
    parent, tag and the numbers of its path and of its path without inline
    tags; and text nodes in page order: (element, block number, text).  Text in
    boilerplate tags is left out.  Room and time grow with the page, however
    deep it is."""

    def __init__(self):
        self.tag, self.parent, self.path, self.block = [""], [-1], [0], [0]
        self.inside, self.linked, self.named = [False], [False], [None]
        self.tags = [("", False, False, False)]      # per path: last tag, below a main, below a link, below a heading
        self.nodes: list[tuple[int, int, str]] = []
        self._number: dict[tuple[int, str], int] = {}

    def _path(self, above: int, name: str) -> int:
        k = self._number.setdefault((above, name), len(self.tags))
        if k == len(self.tags):
            _, main, link, head = self.tags[above]
            self.tags.append((name, main or name in MAIN, link or name == "a", head or name in HEADING))
        return k

    def add(self, above: int, name: str) -> int:
        self.tag.append(name)
        self.parent.append(above)
        self.path.append(self._path(self.path[above], name))
        self.block.append(self.block[above] if name in INLINE else self._path(self.block[above], name))
        self.inside.append(self.inside[above] or name in MAIN)
        self.linked.append(self.linked[above] or name == "a")
        self.named.append(None)
        return len(self.tag) - 1

    def up(self, values: list) -> list:
        """Sums over each element and all below it."""
        out = list(values)
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] += out[e]
        return out

    def down(self, flags: list) -> list:
        """Whether an element or one above it is flagged."""
        out = list(flags)
        for e in range(1, len(out)):
            out[e] = out[e] or out[self.parent[e]]
        return out

    def sums(self, found, weigh) -> list:
        """Sums of weigh(node) over the nodes in each element."""
        out = [0] * len(self.tag)
        for n in found:
            out[n[0]] += weigh(n)
        return self.up(out)


def _size(node) -> int:
    return len(node[2].strip())


def _read(html: str) -> Page:
    page = Page()
    stack: list[tuple[int, bool]] = [(0, False)]     # element, cut
    opened: dict[str, int] = defaultdict(int)        # open elements by tag
    block, at = 0, 0

    def text(raw):
        if raw and not stack[-1][1]:
            page.nodes.append((stack[-1][0], block, H.unescape(raw)))

    def close(i):
        for e, _ in stack[i:]:
            opened[page.tag[e]] -= 1
        del stack[i:]

    for m in _TAG.finditer(html):
        text(html[at:m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            continue
        name = name.lower()
        if name not in INLINE:
            block += 1
        elif name == "br":
            text(" ")
        if m["end"] or m["end2"]:
            if opened[name]:
                i = len(stack) - 1
                while page.tag[stack[i][0]] != name:
                    i -= 1
                close(i)
            continue
        if name in VOID:
            continue
        closes = CLOSED_BY.get(name)
        if closes is None and name not in INLINE:
            closes = {"p"}        # a block ends an open paragraph
        if closes and any(opened[c] for c in closes):
            for i in range(len(stack) - 1, 0, -1):
                tag = page.tag[stack[i][0]]
                if tag in closes:
                    close(i)
                    break
                if tag not in INLINE:
                    break
        above, cut = stack[-1]
        attrs = m["attrs"] or ""
        inside = page.inside[above]
        e = page.add(above, name)
        if not cut:
            cut = name in CUT and not (name == "header" and inside)
            if not cut and name not in MAIN and name not in ("html", "body") and attrs:
                found = {w for g in _NAMES.finditer(attrs)
                         for token in (g[1] or g[2] or g[3] or "").lower().split() for w in [_boilerplate(token)] if w}
                if found and not (found <= {"header"} and inside):
                    page.named[e] = "weak" if found <= WEAK_WORDS else "strong"
        if not attrs.rstrip().endswith("/") or name in INLINE or name in MAIN:
            stack.append((e, cut))
            opened[name] += 1
    text(html[at:])
    return page


def _boilerplate(token: str) -> str | None:
    """The listed word that a whole class token is, or starts with."""
    if token in CUT_WORDS:
        return token
    first = _FIRST.match(token)
    return first[1] if first and first[1] in CUT_PREFIXES and token.replace("_", "-") not in NOT_ADVERTS else None


def nodes(page: Page):
    """The page's text nodes without boilerplate.  An element named as
    boilerplate stays if it has an article or main in it or, on a page without
    one, most good text; one named by a weak word also if it lies in an article
    or main and holds good text, less than half of it in links."""
    if not any(page.named):
        return page.nodes
    mains = page.up([int(t in MAIN) for t in page.tag])
    real = [n for n in page.nodes if n[2].strip()]
    good, _ = _good(page, real)
    mass = page.sums(real, lambda n: _size(n) if page.path[n[0]] in good else 0)
    size, links = page.sums(real, _size), page.sums(real, lambda n: _size(n) if page.linked[n[0]] else 0)
    has_main = any(page.inside[n[0]] for n in page.nodes)

    def out(e):
        if not page.named[e] or mains[e] or (not has_main and 2 * mass[e] > mass[0]):
            return False
        return not (page.named[e] == "weak" and page.inside[e] and mass[e] and 2 * links[e] < size[e])

    gone = page.down([out(e) for e in range(len(page.tag))])
    return [n for n in page.nodes if not gone[n[0]]]


def _good(page: Page, real):
    """The paths whose smoothed, fused ratios pass the threshold, and the paths
    without inline tags of their elements."""
    path = [page.path[n[0]] for n in real]
    size, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for k, n in zip(path, real):
        size[k] += _size(n)
        marks[k] += len(PUNCTUATION.findall(n[2]))
        count[k] += 1
    fused = {k: size[k] / count[k] * math.log2(2 + marks[k] / count[k]) for k in count}
    value = [fused[k] for k in path]
    kernel = [math.exp(-d * d / (2 * SIGMA * SIGMA)) for d in range(-RADIUS, RADIUS + 1)]
    smooth = []
    for i in range(len(value)):
        near = [(kernel[d + RADIUS], value[i + d]) for d in range(-RADIUS, RADIUS + 1) if 0 <= i + d < len(value)]
        smooth.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    mean = sum(smooth) / len(smooth) if smooth else 0
    spread = math.sqrt(sum((s - mean) ** 2 for s in smooth) / len(smooth)) if smooth else 0
    total = defaultdict(float)
    for k, s in zip(path, smooth):
        total[k] += s
    good = set()
    for k in total:
        _, main, link, _ = page.tags[k]
        if (BOOST if main and not link else 1) * min(total[k] / count[k], fused[k]) >= SHARE * spread:
            good.add(k)
    return good, {page.block[n[0]] for n, k in zip(real, path) if k in good}


def content_nodes(page: Page, found):
    """The nodes chosen by their paths' smoothed, fused ratios, and what lies
    among them without being a list of links."""
    real = [n for n in found if n[2].strip()]
    if not real:
        return []
    good, blocks = _good(page, real)
    everywhere = range(len(page.tag))
    # articles and mains with good text bound the result if they hold most of it
    mass = page.sums(real, lambda n: _size(n) if page.path[n[0]] in good else 0)
    within = page.sums(real, lambda n: _size(n) if page.path[n[0]] in good and page.inside[n[0]] else 0)[0]
    bounded = 2 * within >= mass[0] and within > 0
    region = page.down([not bounded or (page.tag[e] in MAIN and mass[e] > 0) for e in everywhere])
    chosen = [page.block[n[0]] in blocks and region[n[0]] for n in real]
    # the innermost element around all chosen text, above one long paragraph
    count = page.up(_marked(page, real, chosen))
    common = max((e for e in everywhere if count[e] == count[0]), default=0) if count[0] else 0
    while common and page.tag[common] in INLINE | {"p", "li", "td", "tr"}:
        common = page.parent[common]
    around = page.down([e == common for e in everywhere])
    # elements of several links and hardly any other text
    size, linked = page.sums(real, _size), page.sums(real, lambda n: _size(n) if page.linked[n[0]] else 0)
    links = page.up([int(t == "a") for t in page.tag])
    menu = page.down([links[e] > 1 and linked[e] >= LINKED * size[e] and page.tag[e] not in INLINE for e in everywhere])
    first = chosen.index(True) if count[0] else len(real)
    last = len(real) - 1 - chosen[::-1].index(True) if count[0] else -1

    def stays(i, e):
        if not region[e]:
            return False
        if page.tags[page.path[e]][3] and around[e]:
            return True
        return not menu[e] and (bounded or (around[e] and first < i < last))

    return [n for i, (n, c) in enumerate(zip(real, chosen)) if c or stays(i, n[0])]


def _marked(page: Page, real, chosen) -> list:
    out = [0] * len(page.tag)
    for n, c in zip(real, chosen):
        out[n[0]] += c
    return out


def main_text(html: str | None) -> str:
    page = _read(html or "")
    found = nodes(page)
    chosen = {n[:2] for n in content_nodes(page, found)}
    blocks: dict[int, list[str]] = {}
    for e, b, t in found:
        if (e, b) in chosen or (b in blocks and not t.strip()):
            blocks.setdefault(b, []).append(t)
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(x for x in joined if x)


def _extract(batches):
    for batch in batches:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    ready(pages.sparkSession)
    cols = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return cols.mapInArrow(_extract, f"page_id {pages.schema[id_col].dataType.simpleString()}, url string, "
                                     "text string, n_chars long")


def op9_tagpath(spark, sf_dir):
    """The main text of all pages."""
    return extract(table(spark, sf_dir, "pages"))
