"""HTML extraction by minimum-cut labelling.

A page becomes a list of blocks, the texts between block-level tags. A classifier over the
ancestors, links, length and punctuation of a block gives a log-odds of being content; its
size is the capacity to one of two terminals. Tags, roles and names of the ancestors are
evidence among the rest, about as strong as all the edges of a block together, so that the cut
may overturn them. Names made of several words are read by them: the last word says what a part
is, the others what it belongs to; names of a state (`no-sidebar`, `comments-open`) say nothing
of the part itself. A part that is out by the words of its name, but holds more than half of the
page's text, is not held to be so. Blocks that are neighbours on the page, and consecutive blocks of one parent
or of near ones in the tree, are joined by smoothness edges.
The minimum cut, found by max-flow, separates content from boilerplate; the content blocks in
page order are the text.

Defined results: null and empty pages, and pages without content, give an empty text; broken
markup is read as browsers do in the common cases (unclosed tags, implied ends of paragraphs
and items); repeated rows are extracted each; extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

import re
from collections import deque
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import named, read

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby"
    " s samp small span strike strong sub sup time tt u var wbr"
    " math mfrac mi mn mo mover mroot mrow ms msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder"
    " munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "script style noscript template head title svg iframe object canvas audio video select"
    " textarea button datalist annotation annotation-xml".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dir div dl fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSES_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
               "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol dl table body html article main section div nav aside form".split())

#: Parts that nothing within overrides, and parts that an article within overrides.
ALWAYS_OUT = frozenset("nav footer aside".split())
OUT = frozenset("header form menu dialog".split())
IN = frozenset("article main".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
COMMENT_NAMES = frozenset("comment comments respond disqus replies reply discussion".split())
OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav"
    " navbar navigation menu sidebar footer header masthead cookie cookies consent notice notices alert"
    " share sharing social related recommended breadcrumb breadcrumbs newsletter subscribe popup modal"
    " overlay pagination pager widget widgets copyright disclaimer toolbar login signin signup search"
    " skip tags meta byline hidden".split()
)
IN_NAMES = frozenset("content article post entry story main body text maincontent articlebody".split())
#: Names of a state or a layout, by their first or last word.
STATE_FIRST = frozenset("no not without has have with is hide show hides shows".split())
STATE_LAST = frozenset("open opened close closed enabled disabled fixed sticky active inactive on off allowed".split())
#: Last words that only say that something is kept together.
HOLDERS = frozenset(
    "area bar block body bottom box button buttons column container content footer form group header holder"
    " icons inner item items left link links list main outer panel right row section slot text thread title"
    " top unit wrap wrapper zone".split()
)
NAME_WORDS = re.compile(r"[^\W\d_]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: Evidence of marks; that of parts that are never content outweighs the best text by itself.
MARK = 16
WEAK_MARK = 8
FIRM_MARK = 24
NEAR = 6

# What the names of a part say of it.
NOTHING, COMMENTS, OUTSIDE, LIKELY_OUTSIDE, PERHAPS_OUTSIDE, CONTENT = range(6)


@lru_cache(1 << 16)
def meaning(name: str) -> int:
    """What a class name, an id or an item property says of the part that has it."""
    words = [w.lower() for w in NAME_WORDS.findall(CAMEL.sub("-", name))]
    whole = "".join(words)
    for kind, names in ((COMMENTS, COMMENT_NAMES), (OUTSIDE, OUT_NAMES), (CONTENT, IN_NAMES)):
        if whole in names:
            return kind
    if not words or words[0] in STATE_FIRST or words[-1] in STATE_LAST:
        return NOTHING
    if words[0] in COMMENT_NAMES or words[-1] in COMMENT_NAMES:
        return COMMENTS
    if words[-1] in OUT_NAMES:
        return LIKELY_OUTSIDE
    if any(w in OUT_NAMES or w in COMMENT_NAMES for w in words[:-1]):
        return LIKELY_OUTSIDE if words[-1] in HOLDERS else PERHAPS_OUTSIDE
    return CONTENT if any(w in IN_NAMES for w in words) else NOTHING


@dataclass
class Block:
    text: str
    path: tuple[int, ...]  # the elements around it, the nearest first, as far as edges look
    tag: str
    verdict: int = 0
    hint: int = 0
    linked: int = 0


@dataclass
class _Open:
    tag: str
    number: int
    skipped: bool
    link: bool


@dataclass
class _Element:
    """An element that opened: the one around it, what marks it, and how much text it holds."""

    above: int
    mark: int = 0
    firm: bool = False
    by_words: bool = False
    hint: int = 0
    size: int = 0


@dataclass
class _Reader(HTMLParser):
    """Reads a page into blocks."""

    blocks: list[Block] = field(default_factory=list)

    def __post_init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.elements = [_Open("#page", 0, False, False)], [_Element(0)]
        self.parts, self.linked = [], 0

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            path = list(islice((x for x in reversed(self.stack) if x.tag not in INLINE), NEAR + 2))
            self.blocks.append(Block(text, tuple(x.number for x in path), path[0].tag, linked=self.linked))
            self.elements[path[0].number].size += len(text)
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()
        if tag in CLOSES_P:
            self._end_within({"p"}, HOLDS)
        if tag in CLOSES_LIKE:
            self._end_within(CLOSES_LIKE[tag], HOLDS)
        if tag in VOID:
            return
        self.stack.append(self._opened(tag, dict(attrs)))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in HOLDS and tag != "p":
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "p":
            self.flush()
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag == tag:
                if tag not in INLINE:
                    self.flush()
                del self.stack[at:]
                return
            if tag in INLINE and self.stack[at].tag not in INLINE:
                return

    def handle_data(self, data):
        if not self.stack[-1].skipped:
            self.parts.append(data)
            if self.stack[-1].link:
                self.linked += len(data.strip())

    def _end_within(self, tags, limits):
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag in tags:
                del self.stack[at:]
                return
            if self.stack[at].tag in limits:
                return

    def _opened(self, tag, attrs) -> _Open:
        above = self.stack[-1]
        element = _Element(above.number)
        said = {meaning(x) for key in ("class", "id", "itemprop") for x in (attrs.get(key) or "").split()}
        role = (attrs.get("role") or "").lower()
        if tag not in ("html", "body") and tag not in INLINE:
            if tag in ALWAYS_OUT or COMMENTS in said and tag not in IN:
                element.mark, element.firm = -FIRM_MARK, True
            elif tag in OUT or role in OUT_ROLES:
                element.mark = -MARK
            elif OUTSIDE in said and tag not in IN:
                element.mark = -MARK
            elif LIKELY_OUTSIDE in said and tag not in IN:
                element.mark, element.by_words = -MARK, True
            elif tag in IN or role in ("main", "article"):
                element.mark = MARK
            elif CONTENT in said:
                element.hint = 2
            elif PERHAPS_OUTSIDE in said:
                element.mark, element.by_words = -WEAK_MARK, True
        style = (attrs.get("style") or "").replace(" ", "").lower()
        unseen = "hidden" in attrs or "display:none" in style
        self.elements.append(element)
        skipped = above.skipped or tag in SKIPPED or unseen
        return _Open(tag, len(self.elements) - 1, skipped, above.link or tag == "a")

    def judged(self) -> list[Block]:
        """The blocks with what the elements around them say; the innermost mark counts."""
        elements = self.elements
        for element in reversed(elements[1:]):
            elements[element.above].size += element.size
        verdicts = [(0, False, 0)]
        for element in elements[1:]:
            verdict, firm, hint = verdicts[element.above]
            most = element.by_words and 2 * element.size > elements[0].size
            if not firm and element.mark and not most:
                verdict, firm = element.mark, element.firm
            verdicts.append((verdict, firm, 0 if firm else element.hint or hint))
        for block in self.blocks:
            block.verdict, _, block.hint = verdicts[block.path[0]]
        return self.blocks


def odds(block: Block) -> int:
    """Tenths of log-odds that a block is content."""
    size = len(block.text)
    value = block.verdict + min(size, 200) / 10 - 8 - 40 * min(1.0, block.linked / size) + 10 * block.hint
    value += 5 * (block.text[-1] in ".!?\"'") + 4 * (block.tag in ("p", "pre", "blockquote"))
    value += 6 * (block.tag in ("h1", "h2", "h3")) - 3 * (block.tag in ("li", "td", "th"))
    return round(value)


def edges(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness edges: page neighbours by their distance in the tree, and one parent's blocks."""
    out, last = [], {}
    for k, block in enumerate(blocks):
        parent = block.path[1:2]
        if k:
            steps = {number: up for up, number in enumerate(blocks[k - 1].path)}
            apart = min((up + steps[x] for up, x in enumerate(block.path) if x in steps), default=NEAR)
            out.append((k - 1, k, max(1, NEAR - apart)))
        if last.get(parent, k - 1) != k - 1:
            out.append((last[parent], k, NEAR // 2))
        last[parent] = k
    return out


def min_cut(weights: list[int], links: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay on the source's side; weights are capacities from it (>0) or to the sink.

    Max-flow by shortest paths in levels; every level's paths are followed without recursion.
    """
    source, sink = len(weights), len(weights) + 1
    near: list[list[int]] = [[] for _ in range(sink + 1)]
    ends: list[int] = []
    room: list[int] = []

    def join(a, b, there, back):
        near[a].append(len(ends))
        ends.append(b)
        room.append(there)
        near[b].append(len(ends))
        ends.append(a)
        room.append(back)

    for k, weight in enumerate(weights):
        if weight > 0:
            join(source, k, weight, 0)
        elif weight < 0:
            join(k, sink, -weight, 0)
    for a, b, capacity in links:
        join(a, b, capacity, capacity)
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            a = queue.popleft()
            for e in near[a]:
                if room[e] and ends[e] not in level:
                    level[ends[e]] = level[a] + 1
                    queue.append(ends[e])
        if sink not in level:
            return [k in level for k in range(len(weights))]
        turn, path, a = [0] * (sink + 1), [], source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(i for i, e in enumerate(path) if not room[e])
                a, path = ends[path[cut] ^ 1], path[:cut]
            while turn[a] < len(near[a]):
                e = near[a][turn[a]]
                if room[e] and level.get(ends[e]) == level[a] + 1:
                    break
                turn[a] += 1
            else:
                if a == source:
                    break
                a = ends[path.pop() ^ 1]
                turn[a] += 1
                continue
            path.append(e)
            a = ends[e]


def main_text(html: str | None) -> str:
    """The content blocks of a page, joined by spaces."""
    if not html:
        return ""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    blocks = reader.judged()
    kept = min_cut([odds(b) for b in blocks], edges(blocks))
    return " ".join(b.text for b, keep in zip(blocks, kept) if keep)


@F.pandas_udf(T.StringType())
def extracted(pages: pd.Series) -> pd.Series:
    return pd.Series([main_text(p) for p in pages], dtype="object")


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns `keep` and the text of every page."""
    html: Column = named(pages, html_col)
    return pages.select(*[named(pages, c) for c in keep], extracted(html).alias("text"))


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = extract(read(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
