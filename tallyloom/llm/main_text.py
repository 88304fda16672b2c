"""Main text of web pages by composite text density.

A page becomes a flat list of nodes in page order (parent, own text, links); broken and cut-off markup is
read as browsers read it, without recursion. Each node's density is its characters per tag, weighed down
by the share of links in it and on the page. The node whose children's densities add up to most is the
core, widened to the article or main element around it; the lowest density on the path from it to the body
is the threshold that the parts beside the path must reach to belong to it too. A page without links has no
threshold, since characters per tag alone only tell long parts from short ones. Parts of the same tag and
class as the part of the path beside them belong to it unless they are lists of links; so do, on a page without
article and main around the core, parts with paragraphs or list items. Beside an article or main, only such parts and titles do.

Menus, headers, footers, sidebars, notices, adverts, forms and comments count in the densities, but are left
out of the text. Their names in class and id are matched by whole tokens: ``site-footer`` and
``sidebar-left`` name chrome, ``no-sidebar`` and ``cookie-recipe`` do not. A name never takes out an element that holds
an article or main, nor most of a page's text unless it stands beside an article or main with text; then, and
for ambiguous names inside an article, the density decides. Scripts, styles, graphics and hidden elements are
no part of the tree. Forms, asides and elements with a role of theirs that hold most of the text are looked into, and only
their controls are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyloom.llm.session import lean

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noframes noembed xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PHRASES = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
#: Elements without text to read, no part of the tree.
UNSEEN = frozenset("head svg math canvas object audio video map".split())
#: Elements that are never part of an article, and those that are not unless they stand inside one.
DROPPED = frozenset("nav footer button select label datalist".split())
#: Elements, and those of the roles below, that are none either unless they hold most of a page's text.
DROPPED_SMALL = frozenset("aside form dialog".split())
DROPPED_OUTSIDE = frozenset({"header", "menu"})
ARTICLE = frozenset({"article", "main"})
#: Elements of running text.
RUNNING = frozenset("p pre blockquote li dd td".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Words of class and id that name what is no part of an article; the ambiguous ones may name parts of one when inside it.
HINTS_COMMENTS = frozenset("comment comments commentlist discussion disqus reactions replies reply respond responses".split())
HINTS_AMBIGUOUS = frozenset(
    "alert announcement banner comment consent cookie cookies discussion gdpr leaderboard menu modal notice notices notification overlay promoted promotion "
    "rail reactions recommended related replies reply respond responses skip social subscription teaser widget".split()
)
HINTS = HINTS_COMMENTS | HINTS_AMBIGUOUS | frozenset(
    "ad ads adsense adunit adv advert adverts advertisement advertising adbox breadcrumb breadcrumbs footer interstitial login menubar nav navbar navigation "
    "newsletter pager pagination paywall popup popover promo share sharing sidebar signup skyscraper sponsor sponsored subnav subscribe toolbar topnav".split()
)
HINTS_OUTSIDE = frozenset("header masthead topbar foot bottom legal copyright disclaimer privacy".split())
#: Words that turn a name around, and words behind a name that leave it what it is.
NEGATIONS = frozenset("no not non without with has have had free hide hidden".split())
NEUTRAL = frozenset(
    "area articles bar block blocks body box button buttons col column container content first form group heading holder icons inner item items "
    "last left link links list main media news outer panel placeholder posts primary right row secondary section slot stories text title top unit widgets wrap wrapper zone".split()
)
#: How an element is marked.
PLAIN, OUT, NAMED, AMBIGUOUS, SMALL = range(5)
#: What may stand in a head; anything else that is seen ends it.
IN_HEAD = frozenset("base basefont bgsound link meta".split())
FOREIGN = frozenset({"svg", "math"})

TAG = re.compile(r"<(?:!--(?:.*?--!?>|.*\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>|[!?/][^>]*(?:>|\Z)|/?[a-zA-Z][^>]*\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _named(token: str) -> str | None:
    """The hint word that a whole token of a class or id comes to."""
    words = WORDS.findall(CAMEL.sub(" ", token).lower())
    if not NEGATIONS.isdisjoint(words):
        return None
    outside = None
    for word in reversed(words):
        if word in HINTS:
            return word
        if word in HINTS_OUTSIDE:
            outside = outside or word
        elif word not in NEUTRAL:
            break
    return outside


def _mark(tag: str, attributes: str, in_article: bool) -> tuple[int | None, str]:
    """How an element is marked, None if it cannot be seen, and its class."""
    if tag in UNSEEN:
        return None, ""
    mark, kind = PLAIN, ""
    if tag in DROPPED or (tag in DROPPED_OUTSIDE and not in_article):
        mark = OUT
    elif tag in DROPPED_SMALL:
        mark = SMALL
    for m in ATTRIBUTE.finditer(attributes) if attributes else ():
        name, value = m[1].lower(), unescape(m[2] or m[3] or m[4] or "")
        if name == "class":
            kind = value
        if tag in ARTICLE:  # never left out; one that is named as a comment does not count as the article of a page
            if name == "class" and not HINTS_COMMENTS.isdisjoint(map(_named, value.split())):
                mark = NAMED
            continue
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (name == "style" and HIDDEN.search(value)):
            return None, kind
        if name == "role" and value.strip().lower() in DROPPED_ROLES and mark != OUT:
            mark = SMALL
        if name in ("class", "id") and mark not in (OUT, SMALL):
            for word in filter(None, map(_named, value.split())):
                if in_article and word in HINTS_AMBIGUOUS:
                    mark = mark or AMBIGUOUS
                elif word in HINTS or not in_article:
                    mark = NAMED
    return mark, kind


class Page:
    """Nodes of a page in page order, and its text as (node, text) pieces; None as text is a block's edge."""

    def __init__(self, html: str):
        self.tags, self.parents, self.pieces = ["body"], [0], []
        self.marks, self.kinds, self.in_article = [PLAIN], [""], [False]
        self._stack: list[tuple[str, int]] = [("body", 0)]  # node -1: inside something unseen
        self._articles = 0
        at = 0
        while at < len(html):
            m = TAG.search(html, at)
            self._text(html[at : m.start() if m else len(html)])
            if not m:
                break
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name = name.lower()
            if m[1] or m[4]:
                self._end(name)
            elif name in RAW:
                close = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = close.end() if close else len(html)
            else:
                self._start(name, m[3] or m[6] or "")

    def _text(self, raw: str) -> None:
        if self._stack[-1][0] == "head" and raw.strip():
            self._pop_to(len(self._stack) - 1)
        node = self._stack[-1][1]
        if node >= 0 and raw:
            self.pieces.append((node, unescape(raw) if "&" in raw else raw))

    def _pop_to(self, depth: int) -> None:
        for tag, node in self._stack[depth:]:
            if tag in ARTICLE:
                self._articles -= 1
            if tag in BLOCKS and node >= 0:
                self.pieces.append((node, None))
        del self._stack[depth:]

    def _start(self, name: str, attributes: str) -> None:
        if name == "body" or (self._stack[-1][0] == "head" and name not in IN_HEAD):  # a head may lack its end
            self._close({"head"}, set())
        if name in ("html", "body"):
            return
        if name in FOREIGN and attributes.rstrip().endswith("/"):
            return
        if name in BLOCKS:
            self._close({"p"}, {"table", "td", "th", "button", "div", "article", "section", "main", "li"})
        if name in CLOSED_BY:
            self._close(CLOSED_BY[name], LIMITS[name])
        above = self._stack[-1][1]
        if name == "br":
            if above >= 0:
                self.pieces.append((above, " "))
                self._node(name, above)
            return
        mark, kind = _mark(name, attributes, self._articles > 0)
        if above >= 0 and name in BLOCKS:
            self.pieces.append((above, None))
        node = -1 if above < 0 or mark is None else self._node(name, above, mark, kind)
        if name not in VOID:
            self._articles += name in ARTICLE
            self._stack.append((name, node))

    def _node(self, name: str, above: int, mark: int = PLAIN, kind: str = "") -> int:
        self.tags.append(name)
        self.parents.append(above)
        self.marks.append(mark)
        self.kinds.append(kind)
        self.in_article.append(self._articles > 0)
        return len(self.tags) - 1

    def _close(self, names: set[str], limits: set[str]) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            if self._stack[depth][0] in names:
                self._pop_to(depth)
                return
            if self._stack[depth][0] in limits:
                return

    def _end(self, name: str) -> None:
        if name in ("html", "body"):
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            if self._stack[depth][0] == name:
                self._pop_to(depth)
                return
            if name not in BLOCKS and self._stack[depth][0] in BLOCKS and self._stack[depth][0] != "p":
                return

    def densities(self) -> tuple[list[float], list[int], list[int]]:
        """Composite text density, characters and link characters of each node."""
        n = len(self.tags)
        chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = self.tags[i] == "a" or in_link[self.parents[i]]
            link_tags[i] = self.tags[i] == "a"
        for node, text in self.pieces:
            if text:
                size = len(" ".join(text.split()))
                chars[node] += size
                if in_link[node]:
                    links[node] += size
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            chars[p] += chars[i]
            links[p] += links[i]
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i]
        page_share = links[0] / max(chars[0], 1)
        out = []
        for c, lc, t, lt in zip(chars, links, tags, link_tags):
            t = max(t, 1)
            value = c / t
            if value and links[0]:
                base = log(c * lc / max(c - lc, 1) + page_share * c + e)
                value *= max(log(c * t / (max(lc, 1) * max(lt, 1))), 0) / log(base)
            out.append(value)
        return out, chars, links

    def left_out(self, chars: list[int]) -> tuple[list[bool], list[bool]]:
        """Whether each node is left out by what it is, and whether its density decides on it."""
        n = len(self.tags)
        size, holds = list(chars), [False] * n
        for i in range(1, n):
            size[self.parents[i]] -= chars[i]
        for i in range(n - 1, 0, -1):
            if self.marks[i] != OUT:
                p = self.parents[i]
                size[p] += size[i]
                holds[p] |= holds[i] or (self.tags[i] in ARTICLE and self.marks[i] == PLAIN and size[i] > 0)
        gone, unsure = [False] * n, [False] * n
        for i in range(1, n):
            mark = self.marks[i]
            gone[i] = gone[self.parents[i]] or mark == OUT
            if mark in (PLAIN, OUT) or gone[i] or self.tags[i] in ARTICLE:
                continue
            most = 2 * size[i] > size[0]
            if mark == SMALL:
                unsure[i] = most and (holds[i] or not holds[0])
            else:
                unsure[i] = mark == AMBIGUOUS or holds[i] or (most and (self.in_article[i] or not holds[0]))
            gone[i] = not unsure[i]
        return gone, unsure

    def content(self) -> tuple[list[bool], list[bool]]:
        """Whether each node belongs to the main text, and whether it is left out of it by what it is."""
        density, chars, links = self.densities()
        gone, unsure = self.left_out(chars)
        n = len(self.tags)
        sums, running = [0.0] * n, [False] * n
        inline, inline_links = [0] * n, [0] * n  # text that stands directly in a node, formatting included
        for node, text in self.pieces:
            if text:
                inline[node] += len(" ".join(text.split()))
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            if gone[i]:
                continue
            running[p] |= running[i] or (self.tags[i] in RUNNING and chars[i] > 0)
            if self.tags[i] in PHRASES:  # formatting inside a text is no part of its own
                inline[p] += chars[i]
                inline_links[p] += links[i]
            else:
                sums[p] += density[i]
        core = max((i for i in range(n) if not gone[i]), key=lambda i: (sums[i], -i))
        up = [core]
        while up[-1]:
            up.append(self.parents[up[-1]])
        path = set(up)
        threshold = min(density[i] for i in up) if links[0] else 0.0
        around = [i for i in up if self.tags[i] == "article"] or [i for i in up if self.tags[i] == "main"]
        core = around[-1] if around else core
        above = set(up[up.index(core) + 1 :])
        # parents in which all running text counts: those within main, or all if no article or main is around the core
        mains = [k for k, i in enumerate(up) if self.tags[i] == "main"]
        wide = set(up[: mains[-1] + 1] if mains else [] if around else up)
        beside = {self.parents[i]: i for i in up if i}
        inside = bool(around)
        chosen = [False] * n
        chosen[0] = core == 0 or (0 in wide and 2 * inline_links[0] <= inline[0])
        for i in range(1, n):
            p = self.parents[i]
            text = 2 * links[i] <= chars[i]
            if gone[i]:
                continue
            if i in above:
                chosen[i] = i in wide and 2 * inline_links[i] <= inline[i]
            elif i == core or (i in path and p not in above):
                chosen[i] = True
            elif unsure[i]:
                chosen[i] = text and density[i] >= threshold and (chosen[p] or p in above)
            elif p == core == 0:  # the body itself: all but its lists of links
                chosen[i] = text or (self.tags[i] in PHRASES and 2 * inline_links[0] <= inline[0])
            elif p not in above:
                chosen[i] = chosen[p]
            elif self.tags[i] in PHRASES:
                chosen[i] = chosen[p]
            else:
                like = self.tags[i] == self.tags[beside[p]] and self.kinds[i] == self.kinds[beside[p]]
                title = p > 0 and self.tags[i] in HEADINGS
                if inside:  # beside an article or main: other parts of it, and its title
                    chosen[i] = title or (text and like)
                    continue
                chosen[i] = density[i] >= threshold or title
                chosen[i] |= text and (like or (p in wide and (running[i] or self.tags[i] in RUNNING)))
        return chosen, gone

    def blocks(self) -> Iterator[str]:
        chosen, gone = self.content()
        parts: list[str] = []
        for node, text in self.pieces:
            if text is None:
                if gone[node]:
                    continue
                if parts and (block := " ".join("".join(parts).split())):
                    yield block
                parts = []
            elif chosen[node]:
                parts.append(text)
        if block := " ".join("".join(parts).split()):
            yield block


def main_text(html: str | None) -> str:
    """Main text of a page: its blocks in page order, parted by an empty line."""
    return "\n\n".join(Page(html).blocks()) if html else ""


def extract_text(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the column ``text``: the main text of the whole ``html``, empty if null or without any.

    Rows are read alone, so null ids and repeated rows need no rule; other columns pass through, one named
    ``text`` is replaced. One scan; a batch is worked off in runs of 64 pages.
    """
    pages = pages.drop(text) if text != html else pages

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for lo in range(0, batch.num_rows, 64):
                rows = batch.slice(lo, 64)
                texts = [main_text(h) for h in rows.column(batch.schema.get_field_index(html)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], [*batch.schema.names, text])

    return pages.mapInArrow(lean(batches), T.StructType([*pages.schema.fields, T.StructField(text, T.StringType())]))
