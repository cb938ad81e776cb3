"""Main text of web pages by tree scoring.

Every paragraph passes points for its length and commas to its ancestors, halved with each level; a container's points are discounted by
its share of link text.  The best container is kept together with siblings that score well, and the text blocks of what is kept are
returned in page order.  On a page without article or main the best container may be one section of it, so beside it and beside the containers
around it single paragraphs, headings, lists and tables with few links stay, and containers of few links that hold a heading or have ``LEAST_POINTS``.  Menus, adverts, notices, forms, comments and the like take no part.  Classes and ids that name such parts do not
count on a wrapper of the article, on an element that is named content as well, nor where the page would end empty.

Pages are rows of a DataFrame and parsed where they lie; nothing is shuffled.  Defined results: a null or empty page, or one without
text, gives an empty string; text outside any element counts as a block of its own; unclosed or cut-off markup ends with the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homelake.llm.common import table

# Element names of the HTML standard, and names that sites give to what is not the article.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
DROPPED = frozenset(
    "script style textarea title noscript iframe xmp noembed noframes head nav footer aside form button select option input"
    " menu dialog template svg math object audio video canvas map datalist label fieldset".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAVES = frozenset("p pre blockquote li td th dd dt figcaption h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl table".split())
SEMANTIC = frozenset(("article", "main"))
NEVER_DROPPED = frozenset(("html", "body", "article", "main"))
# Ids of these are link targets made from a heading's words, not names of page parts.
ANCHORED = HEADINGS | frozenset("p section dt dd".split())
# An element of such a name, from its first to its last word part, is the article's.
CONTENT = frozenset("content article post entry".split())
ENDS_PARAGRAPH = BLOCKS - frozenset("body html tbody td tfoot th thead tr legend option optgroup".split())
CLOSED_BY = {
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "option": frozenset(("option",)),
    "tr": frozenset(("tr", "td", "th")), "td": frozenset(("td", "th")), "th": frozenset(("td", "th")),
}
SCOPES = {
    "li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)), "option": frozenset(("select",)),
    "tr": frozenset(("table",)), "td": frozenset(("table", "tr")), "th": frozenset(("table", "tr")),
}
NOT_ARTICLE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner comment comments disqus respond"
    " replies reply cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall breadcrumb breadcrumbs pagination"
    " pager menu menus nav navbar navigation sidebar aside rail footer foot masthead topbar toolbar share sharing social related recommended"
    " recommendations newsletter subscribe subscription signup login widget widgets skip search copyright disclaimer".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar menuitem toolbar tablist".split()
)

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NAME_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")
_COMMA = re.compile("[,،、，]")
# A sibling stays if it scores this share of the best container.
SIBLING_SHARE = 0.2
# Beside the best container and around it, a container stays from so many points on: one paragraph of 30 characters, or a comma, or two paragraphs.
LEAST_POINTS = 1.3
# Text with a smaller share of link text is prose.
LINK_DENSITY = 0.25


def _is_hidden(tag: str, attributes: str) -> bool:
    """Whether an element's role or visibility marks it as no part of the article."""
    if not attributes.strip() or tag in NEVER_DROPPED:
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape(value.strip("\"'"))
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def _is_named_noise(tag: str, attributes: str) -> bool:
    """Whether an element's class or id names something else than the article; a name of content anywhere in them prevails."""
    if not attributes.strip() or tag in NEVER_DROPPED:
        return False
    noise = False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape(value.strip("\"'"))
        if name != "class" and (name != "id" or tag in ANCHORED):
            continue
        for word in value.split():
            parts = [part.lower() for part in _NAME_PART.findall(word)]
            if not parts:
                continue
            if parts[0] in CONTENT and parts[-1] in CONTENT:
                return False
            if parts[0] not in ("has", "with", "no", "without", "is") and not NOT_ARTICLE.isdisjoint(parts):
                noise = True
            if "header" in parts and NOT_TITLE.isdisjoint(parts):
                noise = True
    return noise


NOT_TITLE = frozenset("article entry post story content section title".split())


class _Tree:
    """Elements of a page as parallel lists, and its text as (block element, pieces); a piece is (element, text, whether in a link).

    ``noise`` is passed on to all below an element, ``named`` is the element's own: what its name drops is decided on the whole page.
    """

    def __init__(self) -> None:
        self.tag, self.parent, self.noise, self.named = ["#root"], [0], [False], [False]
        self._pieces: list[tuple[int, list[tuple[int, str, bool]]]] = []
        self._open = [0]
        self._text: list[tuple[int, str, bool]] = []
        self._in_link = 0

    def flush(self) -> None:
        if self._text:
            self._pieces.append((self._block(), self._text))
        self._text = []

    def blocks(self) -> list[tuple[int, str, int]]:
        """(element, text, length of link text) of the blocks; names drop nothing where nothing would be left."""
        dropped = self._dropped_by_name()
        return self._joined(dropped) or (self._joined([False] * len(dropped)) if True in dropped else [])

    def _joined(self, dropped: list[bool]) -> list[tuple[int, str, int]]:
        found = []
        for block, pieces in self._pieces:
            own = [piece for piece in pieces if not dropped[piece[0]]]
            text = " ".join("".join(content for _, content, _ in own).split())
            if text:
                found.append((block, text, min(sum(len(content.strip()) for _, content, linked in own if linked), len(text))))
        return found

    def _dropped_by_name(self) -> list[bool]:
        """Named elements and all below them, but for wrappers: those that hold more of an article or main than there is outside of them."""
        count = len(self.tag)
        if True not in self.named:
            return [False] * count
        size, last = [0] * count, list(range(count))
        for _, pieces in self._pieces:
            for at, content, linked in pieces:
                size[at] += 0 if linked else len(content.strip())
        for at in range(count - 1, 0, -1):  # parents come before what they hold
            size[self.parent[at]] += size[at]
            last[self.parent[at]] = max(last[self.parent[at]], last[at])
        articles = sorted((at for at in range(count) if self.tag[at] in SEMANTIC and not self.noise[at]), key=lambda at: -size[at])
        dropped = [False] * count
        for at in range(1, count):
            dropped[at] = dropped[self.parent[at]] or (self.named[at] and not self._wraps_article(at, last[at], size, last, articles))
        return dropped

    @staticmethod
    def _wraps_article(at: int, end: int, size: list[int], last: list[int], articles: list[int]) -> bool:
        inside = next((size[x] for x in articles if at < x <= end), None)
        if inside is None:
            return False
        around = [size[x] - size[at] for x in articles if x < at and end <= last[x]]
        beside = next((size[x] for x in articles if x > end or last[x] < at), -1)
        return inside > max([beside, *around])

    def _block(self) -> int:
        return next((at for at in reversed(self._open) if self.tag[at] in BLOCKS), 0)

    def text(self, raw: str) -> None:
        if raw and not self.noise[self._open[-1]]:
            self._text.append((self._open[-1], html.unescape(raw) if "&" in raw else raw, self._in_link > 0))

    def _pop_to(self, at: int) -> None:
        for gone in self._open[at:]:
            if self.tag[gone] == "a":
                self._in_link -= 1
        del self._open[at:]

    def _close(self, names: frozenset[str], scope: frozenset[str] = frozenset()) -> None:
        for at in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[at]]
            if tag in names:
                return self._pop_to(at)
            if tag in scope:
                return None
        return None

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            return self.text(" ")
        if tag in BLOCKS:
            self.flush()
            if tag in ENDS_PARAGRAPH:
                self._close(frozenset(("p",)), frozenset(("table", "button", "td", "th", "object", "html", "template")))
            if tag in HEADINGS and self.tag[self._open[-1]] in HEADINGS:
                self._pop_to(len(self._open) - 1)
            if tag in CLOSED_BY:
                self._close(CLOSED_BY[tag], SCOPES[tag])
        if tag in VOID:
            return None
        up = self._open[-1]
        noise = self.noise[up] or tag in DROPPED or _is_hidden(tag, attributes)
        if tag == "header" and not noise:
            noise = not any(self.tag[at] in SEMANTIC for at in self._open)
        self.tag.append(tag)
        self.parent.append(up)
        self.noise.append(noise)
        self.named.append(not noise and _is_named_noise(tag, attributes))
        self._open.append(len(self.tag) - 1)
        self._in_link += tag == "a"
        return None

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if tag not in ("html", "body"):
            # An inline end tag closes nothing beyond the block it stands in.
            self._close(frozenset((tag,)), frozenset() if tag in BLOCKS else BLOCKS)


def _parse(page: str) -> _Tree:
    tree, at = _Tree(), 0
    while found := _TAG.search(page, at):
        tree.text(page[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag or found.end() == len(page) and page[-1] != ">":
            continue
        if found[1] or found[4]:
            tree.end(tag)
            continue
        attributes = found[3] or found[6] or ""
        tree.start(tag, attributes)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = close.start() if close else len(page)
    tree.text(page[at:])
    tree.flush()
    return tree


def paragraph_points(text: str) -> float:
    """One for being a paragraph, one per comma, and up to three for its length."""
    return 1 + len(_COMMA.findall(text)) + min(len(text) / 100, 3.0)


def main_text(page: str | None) -> str:
    """Text blocks of the best container and its good siblings, one per line."""
    if not page:
        return ""
    tree = _parse(page)
    blocks, count = tree.blocks(), len(tree.tag)
    points, size, links, titled = [0.0] * count, [0] * count, [0] * count, [False] * count
    for node, text, linked in blocks:
        worth = 0.0 if tree.tag[node] in HEADINGS else paragraph_points(text)
        share, at, first = 1.0, node, True
        while True:
            size[at] += len(text)
            links[at] += linked
            titled[at] = titled[at] or tree.tag[node] in HEADINGS
            if not (first and tree.tag[node] in LEAVES):
                points[at] += worth * share
                share /= 2
            if not at:
                break
            at, first = tree.parent[at], False
    if not blocks:
        return ""
    worth = [points[at] * (1 - links[at] / size[at]) if size[at] else 0.0 for at in range(count)]
    best = max(range(count), key=lambda at: (worth[at], size[at], -at))
    whole = best
    while whole and tree.tag[whole] not in SEMANTIC:
        whole = tree.parent[whole]
    best = whole or best
    kept, around = {best}, set()
    if not whole:
        at = best
        while at:
            at = tree.parent[at]
            around.add(at)
    if best:
        for at in range(1, count):
            up = tree.parent[at]
            if not size[at] or at in around or up != tree.parent[best] and up not in around:
                continue
            density = links[at] / size[at]
            if up in around and density < LINK_DENSITY and (tree.tag[at] in LEAVES | LISTS or titled[at] or worth[at] >= LEAST_POINTS):
                kept.add(at)
            if up != tree.parent[best]:
                continue
            leaf = tree.tag[at] in LEAVES and tree.tag[at] not in HEADINGS
            prose = leaf and size[at] > 80 and density < LINK_DENSITY
            if prose or worth[at] >= max(SIBLING_SHARE * worth[best], 1.0) or tree.tag[at] == "h1":
                kept.add(at)
    lines = []
    for node, text, linked in blocks:
        own = node in around and linked < LINK_DENSITY * len(text)
        while node not in kept and node:
            node = tree.parent[node]
        if own or node in kept:
            lines.append(text)
    return "\n".join(lines)


def extract_main_text(pages: DataFrame, page: str = "html", output: str = "text") -> DataFrame:
    """``pages`` with the main text in ``output``; the pages themselves are left out of the result."""
    rest = [F.col(name) for name in pages.columns if name not in (page, output)]
    source = pages.select(*rest, F.col(page).alias("__page"))
    schema = source.drop("__page").withColumn(output, F.lit("")).schema

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            content = batch.pop("__page")
            batch[output] = [main_text(value) for value in content]
            yield batch

    return source.mapInPandas(extract, schema)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).withColumn("n_chars", F.length("text").cast("long"))
