"""Main text of web pages by composite text density.

A page becomes a tree of its block elements. For each element: characters and tags below it, and
characters and tags within links. Its density is characters per tag, adjusted by links; the element whose children's
densities have the largest sum holds the article; it is narrowed to an ``article`` (or ``main``) with most of its text outside links. The least density on its path to the body
is the threshold from which blocks outside it count as well.

Elements end where HTML lets their end tags be omitted, left out or not. Elements that by name, role or class are menus, headers, footers, sidebars, notices, adverts, forms or
reader comments are left out before densities are computed, unless they hold the page's only articles or, without any, most of its text outside links. White space is U+0020 and U+0009 to U+000D.

Defined results: a null or empty page, and one without text in its body, gives an empty string; pages cut off
anywhere are read as far as they go; rows repeated give a row each; an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import pieces

# Elements by what they are.
_LEFT_OUT = frozenset("head nav footer aside form button select option textarea input label fieldset script style noscript template iframe object svg canvas dialog menu title".split())
_NO_TEXT = frozenset("head button select option textarea script style noscript template iframe object svg canvas title".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
_BLOCKS = frozenset("html body main article section header div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address details summary hgroup center".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = _BLOCKS - {"html", "body"} | {"nav", "footer", "aside", "form", "fieldset", "menu", "dialog"}
_SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_WITHIN = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
# Class tokens and ids that are made of these words only, with words that say nothing between them.
_MARKS = (
    r"ads?|advert(?:s|isements?|ising)?|adsense|banner|sponsor(?:ed|s)?|promo(?:tion|s)?|cookies?|consent|gdpr|notices?|popup|modal|overlay|"
    r"nav(?:bar|igation)?|menus?|breadcrumbs?|pagination|pager|sidebars?|side|aside|widgets?|footer|foot|masthead|topbar|header|"
    r"comments?|replies|responses?|respond|talkback|discussion|feedback|disqus|share|sharing|social|related|recommend(?:ed|ations)?|newsletter|subscribe|signup|login|search|toolbar|skip|hidden|copyright"
)
_PLAIN = r"site|page|main|top|bottom|left|right|global|primary|secondary|post|article|body|list|items?|box|block|area|section|panel|bar|links?|icons?|buttons?|form|group|inner|reader|user|[0-9]+"
_NAMES = re.compile(rf"(?:(?:{_PLAIN})[_-]+)*(?:{_MARKS})(?:[_-]+(?:{_MARKS}|{_PLAIN}))*", re.IGNORECASE)
_TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)|<svg(?=[\s/])(?:[^>\"'/]++|\"[^\"]*+\"|'[^']*+'|/(?!>))*+/>"
    r"|<(script|style|textarea|title|noscript|template|iframe|svg)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTES = re.compile(r"([^\s\"'<>/=]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


class _Element:
    __slots__ = ("name", "parent", "parts", "left_out", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, name: str, parent: _Element | None, left_out: bool) -> None:
        self.name, self.parent, self.left_out = name, parent, left_out
        self.parts: list = []  # strings and elements, in page order
        self.chars = self.link_chars = self.link_tags = 0
        self.tags = 1
        self.density = self.total = 0.0


def _is_left_out(name: str, attributes: str, inside: bool) -> bool:
    if name in _LEFT_OUT:
        return True
    if name == "header" and not inside:
        return True
    if name in ("html", "body", "main") or not attributes.strip():
        return False
    for key, *values in _ATTRIBUTES.findall(attributes):
        value, key = "".join(values).strip(), key.lower()
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in _ROLES or key in ("class", "id") and any(map(_NAMES.fullmatch, value.split())):
            return not (inside and name.startswith("h"))
    return False


def _tree(page: str) -> _Element:
    root = top = _Element("html", None, False)
    inside, links, at = 0, 0, 0
    left_out = 0  # open elements that are left out
    inline: Counter[str] = Counter()  # open elements that are no blocks: what is left out, and those of its name inside it

    def text(raw: str) -> None:
        if raw:
            value = html.unescape(raw) if "&" in raw else raw
            top.parts.append(value)
            size = len(_SPACE.sub("", value))
            top.chars += size
            if links:
                top.link_chars += size

    def leave(node: _Element) -> None:
        """``node`` and what is open in it ends."""
        nonlocal top, inside, left_out, links
        while True:
            ended, top = top, top.parent
            inside -= ended.name in ("article", "main")
            if ended.left_out:
                left_out -= 1
                links = 0
            if ended.name not in _BLOCKS:
                inline[ended.name] -= 1
            if ended is node:
                return

    def close(name: str) -> None:
        node = top
        while node is not root:
            if node.name == name:
                return leave(node)
            node = node.parent

    for m in _TOKENS.finditer(page):
        text(page[at : m.start()])
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            continue
        closing, attributes = (m[2] or m[5]) == "/", m[4] or m[7] or ""
        if closing:
            if name == "a" and not inline[name]:
                links = max(0, links - 1)
            elif name in ("body", "html"):
                while left_out:
                    leave(top)
            elif name in _BLOCKS or inline[name]:
                close(name)
            continue
        if inline["head"] and (name == "body" or name in _BLOCKS):
            close("head")
        drop = _is_left_out(name, attributes, inside > 0)
        if drop and (name in _VOID or attributes.endswith("/")):
            continue
        if name in _CLOSES_P:
            node = top
            while node is not root and node.name not in _CLOSES_P:
                node = node.parent
            if node.name == "p":
                leave(node)
        if name in _SAME_CLOSES:
            node = top
            while node is not root and node.name not in _WITHIN.get(name, ()):
                if node.name in _SAME_CLOSES[name]:
                    leave(node)
                    break
                node = node.parent
        block = name in _BLOCKS and name not in ("html", "body")
        if block or drop or inline[name] and name not in _VOID:
            child = _Element(name, top, drop)
            top.parts.append(child)
            top = child
            inside += name in ("article", "main")
            left_out += drop
            inline[name] += not block
            links = 0 if block else links
            continue
        top.tags += 1
        if name == "a":
            links += 1
            top.link_tags += 1
        elif name in _VOID:
            top.parts.append(" ")
    text(page[at:])
    return root


def _density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Characters per tag, more the rarer links are; ``share`` is the share of link characters in the body."""
    if not chars:
        return 0.0
    base = math.log(chars / max(1, chars - link_chars) * link_chars + share * chars + math.e)
    rarity = chars / max(1, link_chars) * tags / max(1, link_tags)
    return chars / max(1, tags) * math.log1p(rarity) / math.log1p(base)


def _ordered(root: _Element) -> list[_Element]:
    """All elements but those left out, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(p for p in node.parts if isinstance(p, _Element) and not p.left_out)
    return out


#: A left-out element with most of a page's text is the page only if nearly nothing remains beside it.
STORY_SHARE = 10


def _kept_again(root: _Element) -> None:
    """Nothing left out stays so that holds the only articles, or without any the most of the text outside links and little beside."""
    every, stack = [], [root]
    while stack:
        node = stack.pop()
        every.append(node)
        stack.extend(p for p in node.parts if isinstance(p, _Element) and p.name not in _NO_TEXT)
    out, plain = {}, {id(n): n.chars - n.link_chars for n in every}
    holds = {id(n): n.name in ("article", "main") and not n.left_out for n in every}
    for node in every:
        out[id(node)] = node.left_out or node.parent is not None and out[id(node.parent)]
    for node in reversed(every):
        if node.parent is not None:
            plain[id(node.parent)] += plain[id(node)]
            holds[id(node.parent)] |= holds[id(node)] and plain[id(node)] > 0
    if any(n.name in ("article", "main") and plain[id(n)] and not out[id(n)] for n in every):
        return
    anchored = holds[id(root)]
    remains = sum(n.chars - n.link_chars for n in every if not out[id(n)])
    for node in every:
        most = 2 * plain[id(node)] > plain[id(root)] and remains * STORY_SHARE < plain[id(node)]
        if node.left_out and (holds[id(node)] if anchored else most):
            node.left_out = False


def main_text(page: str | None) -> str:
    """The article of a page, a line for each block."""
    root = _tree(page or "")
    _kept_again(root)
    nodes = _ordered(root)
    for node in reversed(nodes):
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    if not root.chars:
        return ""
    anchors = [n for n in nodes if n.name == "article" and n.chars] or [n for n in nodes if n.name == "main" and n.chars]
    share = root.link_chars / root.chars
    for node in nodes:
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, share)
        if node.parent is not None:
            node.parent.total += node.density
    best = max((n for n in nodes if n.chars), key=lambda n: (n.total, n.density))
    around = best
    units = set(map(id, anchors))
    while around is not None and id(around) not in units:
        around = around.parent
    if around is None:
        most = max((n for n in _ordered(best) if id(n) in units), key=lambda n: n.chars - n.link_chars, default=None)
        # The page's one article, and beside it what is denser. What comes after an article answers it; ``nodes`` has later siblings first.
        if most is None and len(anchors) == 1 and nodes.index(anchors[0]) > nodes.index(best):
            around = best = anchors[0]
        elif most is not None and 2 * (most.chars - most.link_chars) > best.chars - best.link_chars:
            around = best = most
    threshold, node, path = best.density, best, set()
    while node is not None:
        path.add(id(node))
        threshold = min(threshold, node.density)
        node = node.parent
    units = units if around is not None else set()
    # (element, string or end of a block, whether it is taken)
    stack: list[tuple] = [(root, False)]
    lines: list[str] = []
    held: list[str] = []

    def end() -> None:
        line = _SPACE.sub(" ", "".join(held)).strip(" ")
        if line:
            lines.append(line)
        held.clear()

    while stack:
        item, taken = stack.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            if taken:
                held.append(item)
        elif not item.left_out:
            end()
            if not taken and units:
                taken = id(item) in units and (id(item) in path or item.density >= threshold) or item.name == "h1" and id(item.parent) in path
            elif not taken and id(item) in path:
                taken = item is best
            elif not taken:
                taken = item.density >= threshold or item.name == "h1" and id(item.parent) in path
            stack.append((None, taken))
            stack.extend((p, taken) for p in reversed(item.parts))
    end()
    return "\n".join(lines)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "html"):
        texts = [main_text(page) for page in batch.column(2).to_pylist()]
        counts = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), counts], names=["page_id", "url", "text", "n_chars"])


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
