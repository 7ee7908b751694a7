"""Main text of web pages by consensus of their host.

Pass 1 parses each page, scores its containers (characters of the text blocks that
stand directly below, less twice those inside links; half of it for the next
container up; article and main count threefold) and emits one vote: the host, the
generalised path (tags with their classes, digits replaced) of the best container,
and its score.  Spark adds the votes up by host and path, partially before the
shuffle, so a hot host is a few rows per task, and keeps each host's path with the
most votes.  Pass 2 parses again and takes the containers at the winning path; a
page that has none with text falls back to its own best container.  The winners are
broadcast if a count shows them small; else pages are joined to them by host and
Spark splits a hot host's rows.  A page on which the winning path holds less than half
of the text that isn't links is told by its own best container.

The best container grows to the whole article around it: to the next article or main, to
the part that holds the first heading, and over sibling sections.

A container's text leaves out menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments by tag, role or class.  A part of an article
whose id repeats its heading (``related-work``) is none of these unless it is mostly
links, and an article's own header belongs to it.  Character references are decoded,
white space inside a block becomes one space, blocks are joined by one space; images and
other elements inside a line don't end a block.

Memory follows the page's length, however deep it is nested: a node knows its parent, and
paths are built for candidates alone.

Null html counts as empty and gives an empty text; a null url gives the empty host.
Unclosed and stray tags are tolerated.  Ties between paths go to the larger score,
then to the path's order.  Repeated rows give a row each, an empty table an empty
result, extra columns are ignored.
"""

from __future__ import annotations

import html
import re
import sys
from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import if_small, slices, stored
from .url_filter import host_and_path

# Element kinds of HTML, and names of parts that are not main text.
RAW = frozenset("script style textarea title noscript template iframe svg select option object annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LINE_ENDS = frozenset(("br", "hr"))
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle "
                   "merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover mmultiscripts "
                   "mprescripts none mtable mtr mtd semantics picture".split())
BOILER_TAGS = frozenset("nav footer aside form button dialog menu head".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
BOILER_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent "
                         "gdpr notice popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination "
                         "footer masthead comment comments disqus replies respond social share sharing related newsletter "
                         "subscribe login signup widget toolbar".split())
# First and last words of classes that say how a part is set up, not what it is (has-sidebar, comments-open).
STATE_FIRST = frozenset("has have with no not without is hide show".split())
STATE_LAST = frozenset("open closed enabled disabled on off allowed".split())
# What begins topic classes of a post, and what marks one; a page builder's classes for any of its parts.
TOPIC_FIRST = ("category-", "tag-")
POST_CLASSES = frozenset("post hentry type-post".split())
BUILDER_FIRST, BUILDER_WORDS = "elementor-", frozenset(("widget",))
HEADER_CLASSES = frozenset("header site-header page-header top-header topbar".split())
P_CLOSERS = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                      "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME_CLOSERS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table body html article section div td th main".split())
PREFERRED = frozenset(("article", "main"))
#: What an article's parts stand in beside each other, when no element holds them all.
SECTIONS = frozenset("section p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure header hgroup".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(r"""<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"<>]*+"|'[^'<>]*+'|["'])*+)>|<[!?][^>]*+>""", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}
_WORDS = re.compile(r"[^\W_]+")
_DIGITS = re.compile(r"\d+")


def _names_boiler(names: str, tag: str = "") -> bool:
    """Whether one of the (lower-case) classes or ids of a ``tag`` names a part that is not main text."""
    if BOILER_WORDS.isdisjoint(re.split(r"[^a-z0-9]+", names)):
        return False
    post = tag == "article" or not POST_CLASSES.isdisjoint(names.split())
    for name in names.split():
        if post and name.startswith(TOPIC_FIRST):
            continue
        words = re.split(r"[^a-z0-9]+", name)
        if name.startswith(BUILDER_FIRST):
            words = [w for w in words if w not in BUILDER_WORDS]
        if not BOILER_WORDS.isdisjoint(words) and words[0] not in STATE_FIRST and words[-1] not in STATE_LAST:
            return True
    return False


class Page:
    """Blocks and containers of one page."""

    def __init__(self, source: str | None):
        self.parent, self.name, self.tag = array("i", [-1]), [""], [""]
        self.skip = bytearray(1)  # boilerplate by what the element itself says
        self.article = bytearray(1)  # an article or main, or inside one
        self.doubtful: dict[int, str] = {}  # elements that their id alone, of several words, calls boilerplate
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters inside links
        self._open_nodes: Counter = Counter()  # by tag, from the current node up
        self._read(source or "")
        self._settle()

    def _open(self, tag: str, attrs: str, at: int) -> int:
        name, inside = tag, self.article[at]
        skip, doubt, classes = tag in BOILER_TAGS, "", ""
        own_header = tag == "header" and inside
        for key, *values in _ATTR.findall(attrs) if attrs else ():
            value = "".join(values).lower()
            key = key.lower()
            if key == "role":
                skip = skip or value in BOILER_ROLES
                continue
            if key == "id" and tag in HEADINGS:  # an anchor made of the heading's words
                continue
            if not own_header and (_names_boiler(value, tag) or not HEADER_CLASSES.isdisjoint(value.split())):
                if key == "id" and inside and not skip and len(_WORDS.findall(value)) > 1:
                    doubt = value
                else:
                    skip = skip or tag not in ("body", "html", "main")
            if key == "class":
                classes = ".".join(sorted(value.split()))
        if tag == "header" and not inside:
            skip = True
        if classes:
            name += "." + _DIGITS.sub("#", classes)
        node = len(self.parent)
        if doubt and not skip:
            self.doubtful[node] = doubt
        self.parent.append(at)
        self.name.append(sys.intern(name))
        self.tag.append(sys.intern(tag))
        self.skip.append(skip)
        self.article.append(inside or tag in PREFERRED)
        self._open_nodes[tag] += 1
        return node

    def _settle(self) -> None:
        """Leaves the blocks that are in no boilerplate."""
        if self.doubtful:
            inside = array("i", [-1]) * len(self.parent)  # the doubtful element that a node is in
            size, linked, heading = Counter(), Counter(), {}
            for i in range(1, len(self.parent)):  # parents come before their children
                inside[i] = i if i in self.doubtful else inside[self.parent[i]]
            for node, text, links in self.blocks:
                d = inside[node]
                if d >= 0:
                    size[d] += len(text)
                    linked[d] += links
                    if self.tag[node] in HEADINGS:
                        heading.setdefault(d, _WORDS.findall(text.lower()))
            for d, words in self.doubtful.items():
                if heading.get(d) != _WORDS.findall(words) or linked[d] * 3 > size[d]:
                    self.skip[d] = 1
        for i in range(1, len(self.parent)):
            self.skip[i] |= self.skip[self.parent[i]]
        self.blocks = [b for b in self.blocks if not self.skip[b[0]]]

    def _close(self, at: int, tags: tuple[str, ...], within: frozenset = frozenset()) -> int:
        """The node to go on from when the nearest open element of ``tags`` is closed."""
        if not any(self._open_nodes[t] for t in tags):
            return at
        x = at
        while x > 0:
            if self.tag[x] in tags:
                while at != x:
                    self._open_nodes[self.tag[at]] -= 1
                    at = self.parent[at]
                self._open_nodes[self.tag[x]] -= 1
                return self.parent[x]
            if self.tag[x] in within:
                return at
            x = self.parent[x]
        return at

    def path(self, node: int) -> str:
        names = []
        while node > 0:
            names.append(self.name[node])
            node = self.parent[node]
        return "/".join(["", *reversed(names)])

    def _read(self, s: str) -> None:
        at, pos, links, text, linked = 0, 0, 0, [], 0

        def flush():
            nonlocal text, linked
            if text:
                joined = " ".join("".join(text).split())
                if joined:
                    self.blocks.append((at, joined, min(linked, len(joined))))
                text, linked = [], 0

        def say(piece: str):
            nonlocal linked
            if piece:
                if "&" in piece:
                    piece = html.unescape(piece)
                text.append(piece)
                if links:
                    linked += len(piece)

        end = len(s)
        while pos < end:
            m = _TOKEN.search(s, pos)
            if not m:
                say(s[pos:])
                break
            say(s[pos:m.start()])
            pos = m.end()
            if m[2] is None:
                continue
            tag, closing = m[2].lower(), bool(m[1])
            if tag in INLINE:
                if tag == "a":
                    links = 0 if closing else 1
                continue
            if tag in RAW:
                if not closing and not m[3].endswith("/"):
                    e = _RAW_END[tag].search(s, pos)
                    pos = e.end() if e else end
                continue
            if tag in VOID and tag not in LINE_ENDS:
                continue
            flush()
            links = 0
            if tag in VOID:
                continue
            if closing:
                at = self._close(at, (tag,))
                continue
            if tag in P_CLOSERS:
                at = self._close(at, ("p",), SCOPES)
            if tag in SAME_CLOSERS:
                at = self._close(at, SAME_CLOSERS[tag], SCOPES - {"td", "th"} if tag != "tr" else frozenset(("table",)))
            if tag == "body":
                at = self._close(at, ("head",))
            at = self._open(tag, m[3], at)
        flush()

    def best(self) -> tuple[str, float] | None:
        """Path and score of the best container, or None."""
        score: dict[int, float] = {}
        for node, text, linked in self.blocks:
            gain = len(text) - 2.0 * linked
            holder = self.parent[node] if self.tag[node] not in SCOPES and self.parent[node] >= 0 else node
            for share in (1.0, 0.5):
                score[holder] = score.get(holder, 0.0) + share * gain
                if self.parent[holder] < 0:
                    break
                holder = self.parent[holder]
        top = None
        for node, value in score.items():
            value *= 3.0 if self.tag[node] in PREFERRED else 1.0
            if value > 0 and (top is None or value > top[1]):
                top = (node, value)
        return top and (self.path(self._whole(top[0])), top[1])

    def _whole(self, node: int) -> int:
        """The container that holds the article around ``node``: the next article or main, else the next part that
        directly holds a first heading, else the one whose other parts are sections beside it, so that title, lead
        and sibling sections belong to it."""
        titled = {self.parent[x] for x, _, _ in self.blocks if self.tag[x] == "h1"}
        titled |= {self.parent[x] for x in titled if x >= 0 and self.tag[x] in ("header", "hgroup")}
        above, headed = node, None
        while above > 0:
            if self.tag[above] in PREFERRED:
                return above
            if headed is None and above in titled and self.tag[above] not in ("body", "html"):
                headed = above
            above = self.parent[above]
        return self._with_sections(node) if headed is None else headed

    def _with_sections(self, node: int) -> int:
        """``node``, or the container above it while what else stands there is text in sections, not links."""
        parts = self._texts_by_child(node)
        while node > 0 and self.tag[node] not in ("body", "html"):
            beside = parts.get(self.parent[node], {})
            other = [(child, size, linked) for child, (size, linked) in beside.items() if child != node]
            text = sum(size for _, size, _ in other)
            good = sum(size for child, size, linked in other if self.tag[child] in SECTIONS and linked * 3 <= size)
            if not text or good * 5 < text * 4:
                break
            node = self.parent[node]
        return node

    def _texts_by_child(self, node: int) -> dict[int, dict[int, list[int]]]:
        """For each container above ``node``: characters, and those inside links, below each of its children."""
        line, x = set(), self.parent[node]
        while x >= 0:
            line.add(x)
            x = self.parent[x]
        below = array("i", [-1]) * len(self.parent)  # the child of a container above that a node is in
        for i in range(1, len(self.parent)):
            below[i] = i if self.parent[i] in line else below[self.parent[i]]
        out: dict[int, dict[int, list[int]]] = {}
        for at, text, linked in self.blocks:
            if below[at] > 0:
                sums = out.setdefault(self.parent[below[at]], {}).setdefault(below[at], [0, 0])
                sums[0] += len(text)
                sums[1] += linked
        return out

    def text_at(self, path: str) -> str:
        names = path.split("/")[1:]
        depth = array("i", [0]) * len(self.parent)  # how many names a node and those above it have of the path
        inside = bytearray(len(self.parent))
        inside[0] = not names
        for i in range(1, len(self.parent)):  # parents come before their children
            p = self.parent[i]
            inside[i] = inside[p]
            if not inside[p] and depth[p] >= 0 and self.name[i] == names[depth[p]]:
                depth[i] = depth[p] + 1
                inside[i] = depth[i] == len(names)
            else:
                depth[i] = -1
        return " ".join(t for node, t, _ in self.blocks if inside[node])

    def size(self) -> int:
        """Characters of the blocks that aren't mostly links."""
        return sum(len(t) for _, t, linked in self.blocks if linked * 3 <= len(t))


def main_text(source: str | None, winner: str | None = None) -> str:
    page = Page(source)
    found = page.text_at(winner) if winner is not None else ""
    if 2 * len(found) < page.size() or not found:
        own = page.best()
        found = page.text_at(own[0]) if own else found
    return found


def host_paths(pages: DataFrame, url: str = "url", html_col: str = "html") -> DataFrame:
    """``host``, ``winner``, ``votes``: each host's container path with the most votes."""
    rows = pages.select(host_and_path(F.col(url))[0].alias("host"), F.col(html_col).cast("string").alias("html"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            tops = [Page(h).best() for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("host"), pa.array([t and t[0] for t in tops], pa.string()),
                 pa.array([t and t[1] for t in tops], pa.float64())], names=["host", "path", "score"])

    votes = rows.mapInArrow(vote, "host string, path string, score double").where("path is not null")
    votes = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum(F.floor("score")).alias("score"))
    return votes.groupBy("host").agg(F.max_by("path", F.struct("votes", "score", "path")).alias("winner"),
                                     F.max("votes").alias("votes"))


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` for each row."""
    winners = if_small(stored(pages.sparkSession, host_paths(pages, url, html_col), "host-paths"))
    id_type = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"), host_and_path(F.col(url))[0].alias("host"))
    rows = rows.join(winners.select("host", "winner"), "host", "left").select("page_id", "url", "html", "winner")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            texts = [main_text(h, w) for h, w in zip(b.column("html").to_pylist(), b.column("winner").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    out = rows.mapInArrow(read, f"page_id {id_type}, url string, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
