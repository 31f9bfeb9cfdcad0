"""HTML extraction by consensus host paths.

A page is parsed into elements and text blocks. Every element outside menus,
headers, footers, adverts and the like is scored as a container: a block counts
fully for its nearest container, half for the next, and so on, less its share
of link text. The generalised path of a page's best container (tags with
classes, digits stripped) is the page's vote, as a 64-bit number: each element's
is a hash of its parent's and its own step, however long the path is. Votes are
summed per host in Spark, and the host's winning path says which containers each
of its pages is extracted from; a page without such a container falls back to
its own best. So does a page whose own best container has ``OWN`` times the
score, unless the host rejects that one's path: pages also tell which other
paths they hold (``CANDIDATES`` at most), and one that is on several pages but
best on less than half of them is rejected.

The text of a container is that of the article it belongs to: siblings of its
kind (the same tag, and a common class or id or none at all) come with it, and
so do headings before it and lead paragraphs right before it.

All work on a page is linear in its length, however it is malformed: the scanner
only goes forward, elements that are open are found by their tags, and scores
are summed from the leaves up.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernweave.llm.common import Scratch, mapped, table, written

#: Elements without content (fixed by HTML).
VOID = set("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is not markup.
RAW = "script|style|textarea|title|noscript|iframe|xmp|noembed|noframes|template"
#: Elements that begin and end a text block.
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end an open paragraph.
ENDS_P = BLOCK - set("body caption dd dt head html legend optgroup option tbody td tfoot th thead tr".split())
#: Elements that end an open one of the given names, up to the nearest of the bounds.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Elements that hold no part of an article.
ASIDE = set(
    "nav header footer aside script style head title noscript template iframe button select textarea input dialog menu "
    "svg canvas object audio video map datalist search xmp noembed noframes math".split()
)
#: Words of a class, id or role that mark what is no part of an article.
MARKS = set(
    "ad ads adsense advert advertisement adverts advertising banner breadcrumb breadcrumbs byline comment comments complementary "
    "consent contentinfo cookie cookies disqus footer gdpr header infobox login masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices overlay pager pagination popup promo promoted promotion recommended related remark "
    "replies reply responses rail search share sharing shoutbox sidebar signup skip social sponsor sponsored subscribe tags "
    "toc toolbar widget widgets".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Elements whose marks say nothing.
UNMARKED = {"html", "body"} | HEADINGS
#: Elements of running text, and words that stand beside a mark in the name of an aside.
PROSE = set("p li dt dd td th blockquote pre figcaption caption".split())
LAYOUT = set(
    "area bar block body box btn button buttons container content form group icon icons inner item items label link links list "
    "message module msg outer panel section text title top bottom left right wrap wrapper".split()
)
#: Elements in which a class is the part of speech of a program's text.
CODE = {"pre", "code", "samp", "kbd"}
#: Elements and words that mark an article, and the factor of their score.
ARTICLE, ARTICLE_WORDS, FACTOR = {"article", "main"}, {"article", "articlebody", "main", "post", "entry", "story", "content"}, 1.25

#: Attributes up to the end of a tag; quoted values may hold ``>``. Nothing here is tried twice.
REST = r"(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+"
NAME = r"[a-zA-Z][^\s/>]*+"
COMMENT = r"<!--.*?(?:-->|\Z)"
OTHER = r"<[!?/][^>]*(?:>|\Z)"
RAW_START = rf"<(?P<raw>{RAW})(?![^\s/>])"
RAW_END = r"</(?P=raw)(?![^\s/>])[^>]*(?:>|\Z)"
TOKEN = re.compile(
    rf"{COMMENT}|{RAW_START}{REST}>.*?(?:{RAW_END}|\Z)|<(?P<end>/?)(?P<tag>{NAME})(?P<rest>{REST})>|{OTHER}|(?P<open><[a-zA-Z])",
    re.S | re.I,
)
#: The same for what stands behind a tag that does not end.
PLAIN, HEAD, OTHER_TOKEN = re.compile(COMMENT, re.S), re.compile(rf"<(/?)({NAME})"), re.compile(OTHER)
RAW_HEAD, RAW_CLOSE = re.compile(RAW_START, re.I), {t: re.compile(rf"</{t}(?![^\s/>])[^>]*(?:>|\Z)", re.I) for t in RAW.split("|")}
LOOSE = re.compile(r"<[a-zA-Z][^<>]*(?:>|\Z)")
QUOTE = re.compile(r"[>\"']")
#: First and last parts of a name that only tells of what stands elsewhere, as ``has-sidebar`` or ``comments-open``.
BEFORE, BEHIND = set("has no not with without".split()), {"open", "closed"}
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
PART = re.compile(r"[a-z]+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Page:
    """Elements as (parent, tag, step, hash of the path, aside, article-like, mark, kind) and text blocks as (element, text, characters in links)."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: [""])
    step: list[str] = field(default_factory=lambda: [""])
    path: list[int] = field(default_factory=lambda: [0])
    aside: list[bool] = field(default_factory=lambda: [False])
    article: list[bool] = field(default_factory=lambda: [False])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)
    marked: list[int] = field(default_factory=lambda: [0])
    kind: list[frozenset] = field(default_factory=lambda: [frozenset()])
    #: Inline elements whose own text does not count, wherever they stand.
    cut: list[bool] = field(default_factory=lambda: [False])


#: What marks are of a tag without attributes.
UNNAMED = "", frozenset(), frozenset(), False, frozenset()


def marks(rest: str) -> tuple[str, set[str], set[str], bool, frozenset]:
    """Class names with digits stripped, the names of class, id, role and itemprop, their words, whether it is hidden, and its kind.

    The kind of an element is its classes and id with digits stripped.
    """
    if not rest or rest.isspace():
        return UNNAMED
    classes, names, hidden, kind = "", set(), False, set()
    for name, value in ATTRIBUTE.findall(rest):
        value = unescape(value.strip("\"'")).lower()
        if name.lower() == "hidden":
            hidden = hidden or value != "until-found"
            continue
        if name.lower() == "style":
            hidden = hidden or bool(UNSEEN.search(value))
            continue
        names.update(value.split())
        if name.lower() in ("class", "id"):
            own = {re.sub(r"\d+", "#", c) for c in value.split()}
            kind |= own
            if name.lower() == "class":
                classes = ".".join(sorted(own))
    return classes, names, {w for n in names for w in PART.findall(n)}, hidden, frozenset(kind)


def marked(names: set[str], prose: bool = False) -> tuple[set[str], bool]:
    """Words of ``MARKS`` in the names but for modifiers, and whether one is a whole name.

    In the names of ``prose`` (paragraphs, cells, inline elements) every other
    word must be one of ``LAYOUT``: ``share-price`` tells of what the text is about.
    """
    found, whole = set(), False
    for parts in map(PART.findall, names):
        if parts and parts[0] not in BEFORE and parts[-1] not in BEHIND:
            own = MARKS.intersection(parts)
            if prose and not LAYOUT.union(own).issuperset(parts):
                continue
            found |= own
            whole |= bool(own) and len(parts) == 1
    return found, whole


#: What marks say of an element: nothing, a part of a name, a part of a name beside an article's, a whole name.
NONE, PARTLY, NAMED, WHOLLY, FORM = range(5)


def settle(page: Page) -> None:
    """Make the marked elements and all they hold asides, unless a mark stands on the article's own layout.

    A whole name holds but for what holds ``main``. A part of a name does not
    hold for ``main``, for an article that has an article's name too, for what
    holds ``main`` or the page's only article, or for what holds most of the
    unlinked text and one article, or all text of articles. A form is an aside
    but where a page is wrapped in it: it holds ``main`` or an article, or most
    of the page's unlinked text, most of that in paragraphs. If marks leave no
    text, only whole names and forms count, then only forms.
    """
    if not any(page.marked):
        return
    n = len(page.tag)
    mains, heads, size, own, prose = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    out = page.aside[:]
    for at in range(1, n):
        out[at] = out[at] or out[page.parent[at]] or page.marked[at] == WHOLLY
    for at, text, in_link in page.blocks:
        if not out[at]:
            size[at] += max(0, len(text) - in_link)
            own[at] += size[at] > 0 and page.article[at]
            if page.tag[at] in PROSE or page.tag[at] in HEADINGS:
                prose[at] += max(0, len(text) - in_link)
    within = [False] * n
    for at in range(1, n):
        within[at] = within[page.parent[at]] or page.tag[page.parent[at]] == "article"
        mains[at] = int(page.tag[at] == "main" and not page.aside[at])
        heads[at] = int(page.tag[at] == "article" and not within[at] and not out[at])
    for at in range(n - 1, 0, -1):
        for counts in (mains, heads, size, own, prose):
            counts[page.parent[at]] += counts[at]
    bare, page.aside = page.aside, page.aside[:]
    whole = bare[:]
    for at in range(1, n):
        bare[at] = bare[at] or bare[page.parent[at]]
        whole[at] = whole[at] or bare[at]
        mark = page.marked[at]
        if mark == WHOLLY:
            holds = mains[at] == 0
        elif mark == FORM:
            holds = not (mains[at] or heads[at] or (2 * size[at] > size[0] and 2 * prose[at] > size[at]))
            if holds:
                bare[at] = True
        elif mark:
            most = 2 * size[at] > size[0] and (heads[at] == 1 or own[at] == own[0])
            holds = not (mains[at] or (mark == NAMED and page.tag[at] == "article") or heads[at] == heads[0] == 1 or most)
        else:
            holds = False
        page.aside[at] = page.aside[at] or page.aside[page.parent[at]] or holds
        whole[at] = whole[at] or bare[at] or whole[page.parent[at]] or (holds and mark == WHOLLY)
    for fewer in (whole, bare):
        if all(page.aside[at] for at, _, _ in page.blocks):
            page.aside = fewer


#: Start and end of a piece of markup; for a tag, whether it closes, its name and what follows that; else None.
Token = tuple[int, int, bool, str | None, str]


def tokens(html: str) -> Iterator[Token]:
    """The markup of a page; a ``<`` that begins none is text."""
    for m in TOKEN.finditer(html):
        if m["open"]:  # this tag has no end that its quotes allow
            yield from tokens_behind(html, m.start())
            return
        yield m.start(), m.end(), bool(m["end"]), m["tag"], m["rest"]


def ends(html: str, start: int) -> tuple[array, array]:
    """Places of ``>`` and quotes from ``start`` on, and where a tag ends whose attributes go on there (-1: nowhere)."""
    at = array("q", (m.start() for m in QUOTE.finditer(html, start)))
    out = array("q", [-1]) * (len(at) + 1)
    following = {'"': -1, "'": -1}
    for k in range(len(at) - 1, -1, -1):
        c = html[at[k]]
        if c == ">":
            out[k] = at[k]
        else:
            out[k] = out[following[c] + 1] if following[c] >= 0 else -1
            following[c] = k
    return at, out


def tokens_behind(html: str, at: int) -> Iterator[Token]:
    """The tokens from ``at`` on, where some tags have no end: all ends are found in one walk."""
    places, end_of = ends(html, at)
    while (at := html.find("<", at)) >= 0:
        m = PLAIN.match(html, at)
        if m is None and (raw := RAW_HEAD.match(html, at)):
            end = end_of[bisect_left(places, raw.end())]
            if end >= 0:
                close = RAW_CLOSE[raw[1].lower()].search(html, end + 1)
                at, start = close.end() if close else len(html), at
                yield start, at, False, None, ""
                continue
        if m is None and (head := HEAD.match(html, at)):
            end = end_of[bisect_left(places, head.end())]
            if end >= 0:
                yield at, end + 1, bool(head[1]), head[2], html[head.end() : end]
                at = end + 1
                continue
        m = m or OTHER_TOKEN.match(html, at) or LOOSE.match(html, at)
        if m is None:
            at += 1
        else:
            yield at, m.end(), False, None, ""
            at = m.end()


class Stack:
    """The open elements, found by their tags."""

    def __init__(self, page: Page):
        self.page, self.ids = page, [0]
        self.where: defaultdict[str, list[int]] = defaultdict(list)  # tag: its places in the stack
        self.blocks = [0]  # places of block elements
        self.links = 0

    def push(self, element: int) -> None:
        tag, at = self.page.tag[element], len(self.ids)
        self.ids.append(element)
        self.where[tag].append(at)
        if tag in BLOCK:
            self.blocks.append(at)
        self.links += tag == "a"

    def close(self, at: int) -> None:
        """Close the element at a place and all behind it."""
        for element in self.ids[at:]:
            tag = self.page.tag[element]
            self.where[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()
            self.links -= tag == "a"
        del self.ids[at:]

    def last(self, tags: set[str]) -> int:
        """The last place of any of the tags; 0 if none is open."""
        at = 0
        for t in tags:
            own = self.where.get(t)
            if own and own[-1] > at:
                at = own[-1]
        return at

    def close_last(self, tags: set[str], bounds: set[str]) -> None:
        """Close the last of the tags, unless one of the bounds was opened behind it."""
        at = self.last(tags)
        if at and at > self.last(bounds):
            self.close(at)

    def end(self, tag: str) -> None:
        """An end tag; one of an inline element does not reach beyond the block it stands in."""
        own = self.where.get(tag)
        if own and (tag in BLOCK or own[-1] > self.blocks[-1]):
            self.close(own[-1])


#: What bounds the paragraph that a block element ends.
P, P_BOUNDS = {"p"}, {"button", "table", "td", "th", "caption", "object"}


def parse(html: str) -> Page:
    """Elements and blocks of a page; unclosed and crossed elements are closed as browsers roughly do."""
    page = Page()
    stack = Stack(page)
    text: list[str] = []
    link_chars = 0

    def flush() -> None:
        nonlocal link_chars
        if text:
            whole = " ".join("".join(text).split())
            if whole:
                page.blocks.append((stack.ids[-1], whole, link_chars))
            text.clear()
        link_chars = 0

    at = 0
    for start, end, closing, tag, rest in tokens(html):
        if start > at and not page.cut[stack.ids[-1]]:
            piece = unescape(html[at:start])
            text.append(piece)
            if stack.links:
                link_chars += len(piece)
        at = end
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if tag in BLOCK:
                flush()
            if tag == "br":
                text.append(" ")
            stack.end(tag)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                text.append(" ")
            continue
        if tag in BLOCK:
            flush()
        if tag in ENDS_P:
            stack.close_last(P, P_BOUNDS)
        if tag in ENDS:
            stack.close_last(*ENDS[tag])
        classes, names, words, hidden, kind = marks(rest)
        up = stack.ids[-1]
        in_article = page.article[up]
        like = tag in ARTICLE or not words.isdisjoint(ARTICLE_WORDS)
        aside = page.aside[up] or hidden or (tag in ASIDE and not (tag == "header" and in_article))
        mark, inline = NONE, tag not in BLOCK
        if words and not aside and tag not in UNMARKED and words & MARKS and not (inline and stack.last(CODE)):
            found, whole = marked(names, inline or tag in PROSE)
            if found and not (in_article and found <= {"header", "byline"}):
                mark = WHOLLY if whole else NAMED if names & ARTICLE_WORDS else PARTLY
        if tag == "form" and not aside:
            mark = FORM
        step = (f"{tag}.{classes}" if classes else tag) if tag in BLOCK else ""
        page.parent.append(up)
        page.tag.append(tag)
        page.step.append(step)
        page.path.append(further(page.path[up], step) if step else page.path[up])
        page.aside.append(aside)
        page.marked.append(mark)
        page.article.append(in_article or like)
        page.kind.append(kind)
        # Text in an inline aside goes at once; that of block elements inside one by the element.
        page.cut.append(inline and (page.cut[up] or bool(mark) or hidden or tag in ASIDE))
        if not rest.endswith("/") or tag not in ("svg", "path", "g", "circle", "rect", "use"):
            stack.push(len(page.tag) - 1)
    if at < len(html) and not page.cut[stack.ids[-1]]:
        text.append(unescape(html[at:]))
    flush()
    settle(page)
    return page


def further(path: int, step: str) -> int:
    """The hash of a path with one more step, a signed 64-bit number."""
    h = xxhash.xxh3_64_intdigest(f"{path}/{step}")
    return h - (1 << 64) if h >> 63 else h


def named(page: Page, at: int) -> str:
    """The path of an element in words."""
    steps = []
    while at > 0:
        if page.step[at]:
            steps.append(page.step[at])
        at = page.parent[at]
    return "".join(f"/{s}" for s in reversed(steps))


#: Elements that are blocks themselves rather than containers of blocks.
LEAF = HEADINGS | set("p li dt dd td th tr tbody thead tfoot caption pre figcaption ul ol dl option legend summary".split())


def scores(page: Page) -> dict[int, float]:
    """Score of each container: the text of its blocks, halved for each container between, less what links hold."""
    weight: list[float | None] = [None] * len(page.tag)
    for at, text, in_link in page.blocks:
        if not page.aside[at]:
            weight[at] = (weight[at] or 0.0) + max(0, len(text) - 2 * in_link)
    out: dict[int, float] = {}
    for at in range(len(page.tag) - 1, -1, -1):  # an element stands behind its parent
        own = weight[at]
        if own is None:
            continue
        if page.tag[at] not in LEAF and (page.tag[at] in BLOCK or not at):
            out[at] = own * (FACTOR if page.article[at] and not page.article[page.parent[at]] else 1.0)
            own /= 2
        if at:
            weight[page.parent[at]] = (weight[page.parent[at]] or 0.0) + own
    return out


def best(page: Page) -> int | None:
    """The container with the highest score, the first of several; none without text."""
    found = scores(page)
    return min(found, key=lambda at: (-found[at], at)) if found else None


def families(page: Page) -> dict[int, list[int]]:
    """Children of each element that has a container among them, for ``together``."""
    out: dict[int, list[int]] = {}
    for at in range(1, len(page.tag)):
        out.setdefault(page.parent[at], []).append(at)
    return out


def akin(page: Page, one: int, two: int) -> bool:
    """Whether two siblings are parts of one thing: the same tag (no articles), and a common class or id or none at all."""
    kinds = page.kind[one], page.kind[two]
    return page.tag[one] == page.tag[two] != "article" and bool(kinds[0] & kinds[1] or not (kinds[0] or kinds[1]))


def together(page: Page, containers: set[int]) -> set[int]:
    """The containers with what else belongs to their article.

    Siblings of their kind, first headings before them or before what holds
    them, and paragraphs that stand right before them with hardly any links.
    """
    told = scores(page)
    children = families(page)
    linked: dict[int, list[int]] = {}
    for at, text, in_link in page.blocks:
        linked.setdefault(at, []).append(2 * in_link < len(text))
    out, seen = set(containers), set()
    for top in sorted(containers):
        if page.tag[top] in ("", "html", "body"):
            continue
        at = top
        while at > 0 and at not in seen:
            seen.add(at)
            up = page.parent[at]
            lead: list[int] = []
            for other in children[up]:
                if other == at:
                    out.update(lead)
                    lead = []
                elif page.aside[other]:
                    continue
                elif at == top and akin(page, top, other) and told.get(other, 0) > 0:
                    out.add(other)
                    lead = []
                elif other < at and page.tag[other] in HEADINGS and (at == top or page.tag[other] == "h1"):
                    lead.append(other)
                elif other < at and at == top and page.tag[other] == "p" and all(linked.get(other, [False])):
                    lead.append(other)
                elif told.get(other, 0) > 0:
                    lead = [x for x in lead if page.tag[x] == "h1"]
            at = up
    return out


def text_of(page: Page, containers: set[int]) -> str:
    """Blocks inside the containers that are no asides, in page order."""
    inside = [False] * len(page.tag)
    for at in range(len(page.tag)):
        inside[at] = at in containers or (at > 0 and inside[page.parent[at]])
    return "\n\n".join(text for at, text, _ in page.blocks if inside[at] and not page.aside[at])


#: A page's own best container stands against its host's if it has so many times the score and the host does not reject it.
OWN = 2.0
#: Container paths of a page that its host hears of, from this part of the best score on, and how many pages of 100 must hold one that is rejected.
CANDIDATES, CANDIDATE_PART, REJECT_PERCENT = 8, 0.25, 1


def extract(html: str | None, path: int | None, rejected: list[int] | None = None) -> str:
    """The text of the containers with the hashed path, else of the page's best one; null html is empty.

    The best one also stands where it has ``OWN`` times the score of the others and its path is not ``rejected``.
    """
    if not html:
        return ""
    page = parse(html)
    top, text = best(page), ""
    if top is None:
        return ""
    if path is not None:
        own = {at for at in range(1, len(page.tag)) if page.path[at] == path and page.step[at] and not page.aside[at]}
        told = scores(page)
        reached = max((told.get(at, 0.0) for at in own), default=0.0)
        if own and (told[top] <= OWN * reached or page.path[top] in (rejected or ())):
            text = text_of(page, together(page, own))
    return text or text_of(page, together(page, {top}))


def votes(html: str | None) -> list[int]:
    """Hashed paths of the page's container with the best score and of the next ones, each once; none without text or container."""
    page = parse(html or "")
    found, top = scores(page), best(page)
    if not top:
        return []
    paths = {page.path[top]: None}
    for at in sorted(found, key=lambda at: (-found[at], at)):
        if found[at] < CANDIDATE_PART * found[top] or len(paths) == CANDIDATES:
            break
        if page.step[at]:
            paths[page.path[at]] = None
    return list(paths)


def vote(html: str | None) -> int | None:
    """The hashed path of the page's best container; none without text or container."""
    return next(iter(votes(html)), None)


#: Winning and rejected paths of hosts that are broadcast; more are joined by a shuffle.
BROADCAST_HOSTS = 1_000_000

VOTE = T.StructType([T.StructField("paths", T.ArrayType(T.LongType()))])
TEXT = T.StructType([T.StructField("text", T.StringType())])


def path_counts(df: DataFrame, url: str, html: str) -> DataFrame:
    """host and path, both hashed, with the ``votes`` for the path and the ``pages`` that hold it."""

    def run(pages: list) -> Iterator[pa.Array]:
        yield pa.array(map(votes, pages), pa.list_(pa.int64()))

    hosts = df.select(F.xxhash64(canonical_host(F.col(f"`{url}`"))).alias("host"), F.col(f"`{html}`").alias("html"))
    told = mapped(hosts, ["html"], run, VOTE, ["host"]).select("host", F.posexplode("paths").alias("place", "path"))
    return told.groupBy("host", "path").agg(F.count_if(F.col("place") == 0).alias("votes"), F.count("*").alias("pages"))


def winning_paths(counted: DataFrame) -> DataFrame:
    """host (hashed), path and rejected paths of each host, from the counts of its paths.

    The path is that with the most votes of all pages, ties go to the smaller
    hash. Rejected are paths that at least two pages hold, and one in a hundred,
    but for less than half of which they are the best; at most ``CANDIDATES``
    times a hundred a host.
    """
    of_host = counted.groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), "path")).alias("path"), F.sum("votes").alias("all"))
    few = (F.col("pages") >= 2) & (F.col("pages") * 100 >= F.col("all") * REJECT_PERCENT) & (2 * F.col("votes") < F.col("pages"))
    lost = counted.join(of_host.select("host", "all"), "host").where(few).groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("rejected"))
    return of_host.join(lost, "host", "left").select("host", "path", F.coalesce("rejected", F.array().cast("array<long>")).alias("rejected"))


def extract_text(df: DataFrame, url: str = "url", html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Append ``text``, the main text of each page's whole html, by the paths of its host.

    Null and empty pages have an empty text; pages without a host vote and are
    extracted as one host. A page that repeats votes as often as it stands.
    Pages are never cut, and the work on one is linear in its length. An empty
    table gives an empty one; columns named ``text`` give way, other names may
    clash with none. Pages are not shuffled while the hosts' paths are few
    enough for a broadcast, which is checked.
    """
    scratch = Scratch(df.sparkSession)
    counted = scratch.written(path_counts(df, url, html))  # read twice
    winners = written(winning_paths(counted).select(F.col("host").alias("__h"), F.struct("path", "rejected").alias("__paths")))
    scratch.drop()
    size = winners.agg(F.sum(F.size("__paths.rejected") + 1)).first()[0] or 0
    side = F.broadcast(winners) if size <= BROADCAST_HOSTS else winners
    names = [c for c in (df.columns if keep is None else keep) if c.lower() != "text"]
    kept = [F.col(f"`{c}`").alias(f"__keep{i}") for i, c in enumerate(names)]
    pages = df.select(*kept, F.col(f"`{html}`").alias("__page"), F.xxhash64(canonical_host(F.col(f"`{url}`"))).alias("__host"))
    joined = pages.join(side, F.col("__host") == F.col("__h"), "left")

    def run(pages: list, paths: list) -> list[pa.Array]:
        told = ((p or {}) for p in paths)
        return [pa.array([extract(h, p.get("path"), p.get("rejected")) for h, p in zip(pages, told, strict=True)], pa.string())]

    out = mapped(joined, ["__page", "__paths"], run, TEXT, [f"__keep{i}" for i in range(len(names))])
    return out.select(*[F.col(f"__keep{i}").alias(c) for i, c in enumerate(names)], "text")


def canonical_host(url: Column) -> Column:
    """The host of ``url_filter.canonical`` as a column expression; empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).otherwise("")
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def op4_html_extract(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages, "url", "html", ["page_id", "url"]).withColumn("n_chars", F.char_length("text").cast("long"))


QUERIES = {"op4_html_extract": op4_html_extract}
ORACLES: dict[str, str] = {}
