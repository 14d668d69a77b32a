"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one per block element. What belongs to menus,
headers, footers, sidebars, notices, adverts, forms, comments and the like, by
tag, role or class name, is left out, as is a line that is mostly link text.
The block length at a line left is the summed length of the ``WIDTH`` lines from
there on. A surge is where it rises to ``SURGE`` characters or more, the
following dive where it falls under ``DIVE``; the text between is kept. Lying in
an ``article`` or ``main`` element is a weight in these sums: it lengthens a
line by ``LEAN`` characters where articles hold much of the page's text, and
shortens it where they hold little.

Character references are decoded; white space inside a line becomes one space;
lines are joined in page order by one space.

Defined results: a null or empty page has an empty text. A page in which no
block length reaches ``SURGE`` keeps all lines left that have a weight.
Unclosed elements end with their parent. Rows are handled one by one, so
repeated rows, null ids and empty tables need no special case; other columns
are not carried along.
"""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame

from citystream.llm.common import map_rows

#: Lines in a block, characters at which text surges and dives, what an article's lines are moved by,
#: share of link text that makes a line a menu.
WIDTH, SURGE, DIVE, LEAN, LINKS = 3, 80, 24, 120, 0.6

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>|</?[a-zA-Z][^<>]*(?:>|\Z)|[^<]+|<""",
                    re.S)
_NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

#: Elements whose content is no text at all.
RAW = frozenset("script style noscript template textarea title iframe svg math object select option button canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that run on within a line.
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp
small span strike strong sub sup time tt u var wbr img""".split())
BOILERPLATE_TAGS = frozenset("nav aside footer form dialog menu head".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
BOILERPLATE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising aside banner breadcrumb breadcrumbs
colophon comment comments consent cookie cookies copyright disclaimer discussion disqus footer form gdpr header login masthead menu
menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion related
replies reply respond responses search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar
topbar widget widgets""".split())
ARTICLE_NAMES = frozenset("article post entry story content".split())
_CAMEL = re.compile(r"[A-Z]?[a-z]+")


def _is_boilerplate(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in BOILERPLATE_TAGS or tag == "header" and not in_article:
        return True
    for name, *values in _NAMES.findall(attrs) if attrs else ():
        name, given = name.lower(), "".join(values)
        value = given.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in BOILERPLATE_ROLES:
            return True
        if name in ("class", "id") and tag not in ("body", "html", "main"):
            for word in given.split():
                parts = {word.lower(), *re.split(r"[-_]+", word.lower()), *map(str.lower, _CAMEL.findall(word))}
                junk = parts & BOILERPLATE_NAMES
                # The heading of an article is often in its own header block.
                if junk and (junk != {"header"} or not (in_article or parts & ARTICLE_NAMES)):
                    return True
    return False


class Lines:
    """(text, link characters, in an article, boilerplate) for each line of a page."""

    def __init__(self, page: str):
        self.lines: list[tuple[str, int, bool, bool]] = []
        self.parts: list[str] = []
        self.linked, self.links = 0, 0
        self.stack: list[tuple[str, bool, bool]] = []  # tag, opens an article, opens boilerplate
        self.opened: Counter[str] = Counter()
        self.articles = self.boilerplate = 0
        pos, size = 0, len(page)
        while pos < size:
            m = _TOKEN.match(page, pos)
            pos = m.end()
            tag = m[2]
            if tag is None:
                if not m[0].startswith("<") or m[0] == "<":  # else a comment, a declaration or a broken tag
                    self.parts.append(m[0])
                    self.linked += len(m[0].strip()) if self.links else 0
                continue
            tag = tag.lower()
            if tag in RAW:
                if not m[1] and not m[3].endswith("/"):
                    end = re.compile(rf"</{tag}\b[^>]*>|\Z", re.I).search(page, pos)
                    pos = end.end()
            elif tag == "a":
                self.links = 0 if m[1] else 1
            elif tag not in INLINE:
                self.end_line()
                if tag not in VOID and tag != "p":
                    if m[1]:
                        self.close(tag)
                    else:
                        self.open(tag, m[3])
                elif tag == "p" and not m[1]:
                    self.drop("p")
                    self.open(tag, m[3])
                elif tag == "p":
                    self.drop("p")
        self.end_line()

    def open(self, tag: str, attrs: str) -> None:
        article = tag in ("article", "main")
        junk = _is_boilerplate(tag, attrs, self.articles > 0)
        self.stack.append((tag, article, junk))
        self.opened[tag] += 1
        self.articles += article
        self.boilerplate += junk

    def drop(self, tag: str) -> None:
        """Closes an open paragraph, which any block may leave open."""
        if self.stack and self.stack[-1][0] == tag:
            self.pop()

    def close(self, tag: str) -> None:
        if self.opened[tag]:
            while self.pop() != tag:
                pass

    def pop(self) -> str:
        tag, article, junk = self.stack.pop()
        self.opened[tag] -= 1
        self.articles -= article
        self.boilerplate -= junk
        self.links = 0
        return tag

    def end_line(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            self.lines.append((text, self.linked, self.articles > 0, self.boilerplate > 0))
        self.parts, self.linked = [], 0


def weights(lines: list[tuple[str, int, bool]]) -> list[int]:
    """The text length of every line (text, its link characters, in an article),
    moved by ``LEAN``: where articles hold a third of the text or more, up for
    their lines and down for all others; where they hold less, as teasers do,
    down for theirs."""
    inside = sum(len(t) for t, _, article in lines if article)
    outside = sum(len(t) for t, _, article in lines if not article)
    if not inside:
        return [len(t) for t, *_ in lines]
    if 2 * inside >= outside:
        return [len(t) + (LEAN if article else -LEAN) for t, _, article in lines]
    return [len(t) - LEAN * article for t, _, article in lines]


def surges(weight: list[int]) -> list[bool]:
    """Which lines lie between a surge and its dive, by the sums of ``weight``
    over the ``WIDTH`` lines from each on. A page that never surges is kept."""
    blocks = [sum(weight[i:i + WIDTH]) for i in range(len(weight))]
    if max(blocks, default=0) < SURGE:
        return [w > 0 for w in weight]
    on, kept = False, []
    for w, block in zip(weight, blocks):
        on = block >= (DIVE if on else SURGE)
        kept.append(on and w > 0)
    return kept


def main_text(page: str | None) -> str:
    lines = [(text, linked, article) for text, linked, article, junk in (Lines(page).lines if page else [])
             if not junk and (article or linked <= LINKS * len(text))]
    return " ".join(text for (text, *_), kept in zip(lines, surges(weights(lines))) if kept)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""

    def make():
        def rows(pages: list[str | None]) -> dict:
            texts = [main_text(p) for p in pages]
            return {"text": texts, "n_chars": [len(t) for t in texts]}

        return rows

    return map_rows(df, [id_col, url_col], html_col, make, "text string, n_chars long")
