"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text at block-level tags. Linear costs from what is known of a
block (the elements it stands in, their class names, its length, its links) become the
capacities of its two terminal edges: from the source, what it costs to call it boilerplate; to
the sink, what it costs to call it content. Edges between neighbouring blocks, and between
successive blocks of one container, cost as much as it takes to label them differently. The
maximum flow gives the cheapest labelling of all blocks of the page at once; the blocks on the
source's side are the text.

The weights are set by hand. Evidence of length grows with the text, and so does that of an
element or a whole name that says boilerplate (nav, footer, comments, cookie-notice), only twice
as fast: no length turns a comment or a footer into an article. Parts of names and words that
titles of chapters have as well cost a few units, which a longer text outweighs. A block pays
something for being a block only where something speaks against it: links, names around it, or
an article elsewhere on the page. So a page of a few short lines keeps them. Text in hidden
elements of any kind is not seen.

Nulls: a null or empty page has an empty text. Text is decoded, white space inside a block is
one space, blocks are joined by line feeds. Repeated pages are each extracted; other columns are
not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_of, id_or_null, text_of

# Elements by what they mean for the text in them.
_SKIPPED = frozenset(["script", "style", "noscript", "template", "svg", "iframe", "head", "title", "textarea", "select", "option", "button", "canvas", "object"])
_RAW = r"script|style|textarea|title|noscript|template|svg|iframe"
_BOILERPLATE = frozenset(["nav", "footer", "aside", "form", "menu", "dialog", "fieldset"])
_CONTENT = frozenset(["article", "main"])
_CONTAINERS = _SKIPPED | _BOILERPLATE | _CONTENT | frozenset(["div", "section", "header", "ul", "ol", "dl", "table", "figure", "blockquote", "details", "address", "body", "center"])
_BREAKS = _CONTAINERS | frozenset(["p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "pre", "hr", "caption", "figcaption", "summary", "legend", "label", "input", "html", "thead", "tbody", "tfoot"])
# What may stand in a head; anything else ends it, as it does in a browser.
_HEAD = frozenset(["html", "head", "title", "meta", "link", "base", "basefont", "bgsound", "noframes", "script", "style", "noscript", "template"])
# Elements that end where the next of their kind begins, if nothing ends them before.
_OPEN_ENDED = frozenset(["p", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot"])
_VOID = frozenset(["br", "hr", "img", "input", "wbr", "area", "base", "col", "embed", "link", "meta", "source", "track"])
_HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
# Words of class names, ids and roles.
_BOILERPLATE_WORDS = frozenset(["ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "sidebar", "side", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "foot", "masthead", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "register", "search", "share", "sharing", "social", "related", "recommended", "recommendations", "trending", "popular", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "discussion", "widget", "pagination", "pager", "copyright", "legal", "disclaimer", "toolbar", "skip", "complementary", "contentinfo", "form", "feedback", "survey", "paywall"])
# Of these, words that titles of chapters have as well: by themselves they say little.
_AMBIGUOUS_WORDS = frozenset(["side", "search", "form", "legal", "related", "popular", "notice", "notices", "discussion", "register", "survey", "alert", "alerts", "consent", "feedback", "reply", "replies", "respond", "subscription", "promotion", "trending", "skip", "disclaimer", "foot"])
# What a name may hold beside them and still be one of boilerplate as a whole.
_PLACE_WORDS = frozenset(["site", "page", "box", "bar", "list", "item", "items", "wrap", "wrapper", "container", "section", "area", "block", "inner", "outer", "primary", "secondary", "left", "right", "top", "bottom", "links", "link", "buttons", "button", "slot", "unit", "policy", "global", "header", "title", "body", "row", "col", "js", "is", "the"])
# Together with one of these, a word of the first kind is one of boilerplate as a whole.
_TEASER_WORDS = frozenset(["related", "popular", "trending"])
_TEASED_WORDS = frozenset(["posts", "articles", "stories", "news", "topics", "videos", "products", "reading"])
# A name of these alone is that of a page's header.
_HEADER_WORDS = frozenset(["header", "site", "page", "global", "top"])
_CONTENT_WORDS = frozenset(["article", "content", "main", "post", "entry", "story", "text", "maincontent", "articlebody"])

# Quotes count after an equals sign only, and may hold any character.
_ATTRIBUTES = r"""(?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:{_RAW})(?=[\s/]){_ATTRIBUTES}(?<=/)>"
    rf"|<({_RAW})(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_UNSEEN = re.compile(r"(?:^|[;\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SENTENCE_END = re.compile(r"[.!?…。:;]['\")\]»”]*\Z")


@dataclass(frozen=True)
class Costs:
    """Weights of the linear costs, in the unit of one neighbour edge inside a container."""

    per_char: float = 1 / 60
    sentence: float = 0.5
    heading: float = 0.5
    content_element: float = 5.0
    content_name: float = 2.0
    any_block: float = 1.0  # if anything speaks against it
    links: float = 4.0
    boilerplate: float = 60.0  # elements and whole names,
    boilerplate_per_char: float = 2 / 60  # and for what they hold
    part_of_name: float = 6.0
    ambiguous: float = 3.0
    header: float = 6.0
    neighbour: float = 1.0
    across: float = 0.25
    container: float = 0.5


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    tag: str
    container: int
    content: float = 0.0  # what it costs to call it boilerplate
    boilerplate: float = 0.0
    inside: bool = False  # an article or main


@dataclass(frozen=True)
class Evidence:
    """What elements and names around a text say; ``against`` is that of whole names."""

    content: float = 0.0
    boilerplate: float = 0.0
    against: bool = False
    skipped: bool = False


@dataclass
class _Open:
    tag: str
    number: int
    evidence: Evidence

    @property
    def skipped(self) -> bool:
        return self.evidence.skipped


@dataclass
class _Unseen:
    """A hidden element that is no container, and how many of its name are open inside."""

    tag: str
    depth: int  # of containers around it
    open: int = 1


def _attributes(attributes: str) -> dict[str, str]:
    """Values by name in lower case; the first of several counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), "".join(values))
    return found


def _hidden(attributes: dict[str, str]) -> bool:
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").strip().lower() == "true"
        or bool(_UNSEEN.search(attributes.get("style", "")))
    )


def _names(attributes: dict[str, str]) -> list[set[str]]:
    """The words of each class, id and role."""
    names = (name for key in ("class", "id", "role") for name in attributes.get(key, "").split())
    return [{word.lower() for word in _WORDS.findall(name)} for name in names]


def _name_cost(names: list[set[str]], costs: Costs) -> tuple[float, bool]:
    """What the names say for boilerplate, and whether one of them says it as a whole.

    Names that hold other words, too (side-effects, banner-history), or ambiguous words only
    (discussion) cost a few units.
    """
    most, whole = 0.0, False
    for words in names:
        known = words & _BOILERPLATE_WORDS
        if not known:
            continue
        if known <= _TEASER_WORDS and words & _TEASED_WORDS and words <= known | _TEASED_WORDS | _PLACE_WORDS:
            whole = True
        elif known <= _AMBIGUOUS_WORDS:
            most = max(most, costs.ambiguous)
        elif words <= _BOILERPLATE_WORDS | _PLACE_WORDS | _CONTENT_WORDS:
            whole = True
        else:
            most = max(most, costs.part_of_name)
    return most, whole


@dataclass
class _Page:
    costs: Costs
    blocks: list[Block] = field(default_factory=list)

    def parse(self, page: str) -> list[Block]:
        top = _Open("", 0, Evidence())
        stack, containers = [top], 0
        parts: list[str] = []
        linked, links, tag, own = 0, 0, "", Evidence()
        unseen: _Unseen | None = None
        at = 0

        def flush() -> None:
            nonlocal parts, linked, own
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    self._add(text, linked, tag, stack[-1].number, own)
            parts, linked, own = [], 0, stack[-1].evidence

        for match in _TOKEN.finditer(page):
            if stack[-1].tag == "head" and page[at : match.start()].strip():
                stack.pop()
            if match.start() > at and not stack[-1].skipped and not unseen:
                text = html.unescape(page[at : match.start()])
                parts.append(text)
                if links:
                    linked += len(text.strip())
            at = match.end()
            closing, name, attributes = match.group(2), match.group(3), match.group(4)
            if not name:
                continue  # comments, scripts, declarations
            name = name.lower()
            if stack[-1].tag == "head" and not closing and name not in _HEAD:
                stack.pop()
            if unseen:
                unseen = self._still_unseen(unseen, name, closing, len(stack))
            given = _attributes(attributes) if attributes and not closing else {}
            if name not in _CONTAINERS and name not in _VOID and not unseen and given and _hidden(given):
                if not closing and not attributes.endswith("/"):
                    unseen = _Unseen(name, len(stack))
            if name == "a":
                links = 0 if closing else 1
                continue
            if name not in _BREAKS:
                if name == "br" and not unseen:
                    parts.append(" ")
                continue
            flush()
            links = 0
            if closing:
                if name in _CONTAINERS and any(each.tag == name for each in stack):
                    while stack.pop().tag != name:
                        pass
                    own = stack[-1].evidence
                    if unseen and len(stack) < unseen.depth:
                        unseen = None
                tag = ""
                continue
            tag = name
            evidence = self._evidence(name, given, stack[-1].evidence)
            if unseen:
                evidence = replace(evidence, skipped=True)
            if name in _CONTAINERS:
                containers += 1
                if not attributes.endswith("/"):
                    stack.append(_Open(name, containers, evidence))
                    own = evidence
            else:
                own = evidence
        if stack[-1].tag == "head":
            stack.pop()
        if at < len(page) and not stack[-1].skipped and not unseen:
            parts.append(html.unescape(page[at:]))
        flush()
        return self._charged()

    @staticmethod
    def _still_unseen(unseen: _Unseen, name: str, closing: str, depth: int) -> _Unseen | None:
        """The hidden element after a tag: a paragraph ends at any block, an item at the next one
        of its list, others where they are closed."""
        if unseen.tag == "p" and name in _BREAKS and name not in _VOID:
            return None
        if name == unseen.tag and depth == unseen.depth:
            if not closing and name in _OPEN_ENDED:
                return None
            unseen.open += -1 if closing else 1
            if unseen.open == 0:
                return None
        return unseen

    def _evidence(self, name: str, given: dict[str, str], outer: Evidence) -> Evidence:
        costs, content, boilerplate, against = self.costs, outer.content, outer.boilerplate, outer.against
        inside = outer.content >= costs.content_element
        if name == "main":
            # There is one; names around it are about the page's layout.
            against, content = False, content + costs.content_element
        elif name in _CONTENT:
            content += costs.content_element
        elif name in _BOILERPLATE or (name == "header" and not inside):
            against = True
        if given:
            names = _names(given)
            words = set().union(*names)
            cost, whole = _name_cost(names, costs) if name not in ("main", "body") else (0.0, False)
            boilerplate += cost
            against = against or whole
            if words & _CONTENT_WORDS and name != "body" and not whole and cost <= costs.ambiguous:
                content += costs.content_name
            elif "header" in words and not cost and not whole and not inside and name != "body":
                if any("header" in each and each <= _HEADER_WORDS for each in names):
                    against = True
                else:
                    boilerplate += costs.header
        skipped = outer.skipped or name in _SKIPPED or (bool(given) and _hidden(given))
        return Evidence(content, boilerplate, against, skipped)

    def _add(self, text: str, linked: int, tag: str, container: int, around: Evidence) -> None:
        costs = self.costs
        share = min(1.0, linked / len(text))
        content = len(text) * costs.per_char * (1 - share)
        if _SENTENCE_END.search(text):
            content += costs.sentence
        if tag in _HEADINGS:
            content += costs.heading
        content += min(around.content, costs.content_element + costs.content_name)
        boilerplate = costs.links * share + around.boilerplate
        if around.against:
            boilerplate += costs.boilerplate + len(text) * costs.boilerplate_per_char
        inside = around.content >= costs.content_element
        self.blocks.append(Block(text, linked, tag, container, content, boilerplate, inside))

    def _charged(self) -> list[Block]:
        elsewhere = any(block.inside for block in self.blocks)
        for block in self.blocks:
            if block.boilerplate > 0 or (elsewhere and not block.inside):
                block.boilerplate += self.costs.any_block
        return self.blocks


def source_side(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Nodes on the source's side of a minimum cut: blocking flows on shortest paths."""
    n = len(source)
    s, t = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def add(a: int, b: int, forward: float, back: float) -> None:
        heads[a].append(len(to))
        to.append(b)
        room.append(forward)
        heads[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in range(n):
        # What both terminals have in common flows straight through.
        common = min(source[i], sink[i])
        if source[i] > common:
            add(s, i, source[i] - common, 0.0)
        elif sink[i] > common:
            add(i, t, sink[i] - common, 0.0)
    for a, b, cost in edges:
        add(a, b, cost, cost)

    least = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        waiting = deque([s])
        while waiting:
            a = waiting.popleft()
            for e in heads[a]:
                if room[e] > least and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    waiting.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        at = s
        while True:
            if at == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                full = next(i for i, e in enumerate(path) if room[e] <= least)
                at = to[path[full] ^ 1]
                del path[full:]
                continue
            while tried[at] < len(heads[at]):
                e = heads[at][tried[at]]
                if room[e] > least and level[to[e]] == level[at] + 1:
                    break
                tried[at] += 1
            else:
                if at == s:
                    break
                at = to[path.pop() ^ 1]
                tried[at] += 1
                continue
            path.append(e)
            at = to[e]


def content_blocks(page: str, costs: Costs = Costs()) -> list[str]:
    blocks = _Page(costs).parse(page)
    edges: list[tuple[int, int, float]] = []
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            same = blocks[i - 1].container == block.container
            edges.append((i - 1, i, costs.neighbour if same else costs.across))
        before = last.get(block.container)
        if before is not None and before < i - 1:
            edges.append((before, i, costs.container))
        last[block.container] = i
    kept = source_side([b.content for b in blocks], [b.boilerplate for b in blocks], edges)
    return [block.text for block, keep in zip(blocks, kept, strict=True) if keep]


def extract_text(
    pages: DataFrame, *, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``."""
    rows = pages.select(
        id_of(id_column).alias("page_id"),
        F.col(url_column).alias("url"),
        text_of(html_column).alias("page"),
    )

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = ["\n".join(content_blocks(page)) for page in batch["page"]]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"],
                    "url": batch["url"],
                    "text": texts,
                    "n_chars": [len(text) for text in texts],
                }
            )

    texts = rows.mapInPandas(extract, "page_id long, url string, text string, n_chars long")
    return texts.withColumn("page_id", id_or_null("page_id"))
