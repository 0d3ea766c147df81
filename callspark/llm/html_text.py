"""Main text of web pages by two passes over text blocks.

The first pass labels a block from its length, its share of stop words and its share of linked
text. Blocks it can't decide (short ones, and long ones without known stop words) take the label of
their nearest decided neighbours in the second pass, inside an <article> or <main> as elsewhere.
Of several articles those without a block that is text by itself are left out, if another has one, and
so are the labels of adverts. Regions that a page marks as something other than its article (menus, footers, asides, forms,
adverts, notices, comments) are left out before; a class or an id does not mark an element that
holds an <article> or a <main>.

Nulls give an empty text. Work is per page and linear in its length; no page is cut.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from callspark.llm.common import sliced

# --- fixed values: elements, hints and stop words ------------------------------------------------

_RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
_DROPPED = frozenset("head nav footer aside form menu dialog select button fieldset datalist object svg math canvas audio video map".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stay open until their end tag; all others only separate blocks.
_NESTED = _DROPPED | frozenset("article main header section div ul ol dl table blockquote details figure center body html".split())
#: Blocks that end where another block begins.
_CLOSED_BY_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_HINTS = frozenset(
    """ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar
    navigation menu submenu breadcrumb breadcrumbs masthead footer sidebar notice notices cookie cookies consent gdpr popup
    modal overlay newsletter subscribe signup login social share sharing comment comments discussion disqus reply replies
    respond related recommended recommendations pagination pager toolbar widget copyright disclaimer""".split()
)
#: Hints that count on an <article> itself; a layout class such as "has-sidebar" does not.
_ARTICLE_HINTS = frozenset("ad ads advert advertisement sponsored promo comment comments reply related teaser".split())
_STOP_WORDS = frozenset(
    """the of and to in is that it was for on with as by at this be are from or an he she they his her not but have had which you we
    der die das und ist von zu den mit dem ein eine im für auf des sich nicht als auch es an wird sind
    le la les de des et est un une du en que qui dans pour sur pas par plus au aux ce il elle avec
    el los las y del que por con para una se no su al lo como más o pero""".split()
)

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HINT_WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
#: What an advert is headed by when nothing else marks it.
_ADVERT_LABELS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising anzeige anzeigen werbung publicité pub publicidad anuncio anuncios sponsored promoted".split()
)
_RIGHTS = re.compile(r"©|\(c\)\s*\d{4}|\ball rights reserved\b", re.I)
_WORD = re.compile(r"\w+")

GOOD, BAD, OPEN = 1, -1, 0


class Block:
    """A run of text between block-level tags, and what the passes need to know of it."""

    __slots__ = ("text", "linked", "scope", "item", "heading", "label")

    def __init__(self, text: str, linked: int, scope: int, item: bool, heading: bool):
        self.text, self.linked, self.scope, self.item, self.heading = text, linked, scope, item, heading
        self.label = OPEN


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(source)}


def _is_dropped(tag: str, source: str, in_article: bool) -> str:
    """Whether an element and all in it are no part of the article: by its "kind", or by a "hint" of its class or id."""
    if tag in _DROPPED or tag == "header" and not in_article:
        return "kind"
    if not source or source.isspace() or tag in ("html", "body", "main"):
        return ""
    attributes = _attributes(source)
    if "hidden" in attributes or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return "kind"
    if attributes.get("role", "").lower() in _ROLES or attributes.get("aria-hidden", "").lower() == "true":
        return "kind"
    words = {w.lower() for w in _HINT_WORD.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")}
    if tag == "article":
        return "" if words.isdisjoint(_ARTICLE_HINTS) else "kind"
    return "" if words.isdisjoint(_HINTS) else "hint"


class Hinted:
    """An element dropped by a hint, unless an article turns out to be in it; ``around`` is the next such element outwards."""

    __slots__ = ("dropped", "around")

    def __init__(self, around: "Hinted | None"):
        self.dropped, self.around = True, around


def blocks(html: str) -> list[Block]:
    """The text blocks of a page outside its dropped regions, in page order."""
    found: list[tuple[Block, Hinted | None]] = []
    pieces: list[str] = []
    stack: list[tuple[str, bool, int, Hinted | None]] = []  # tag, dropped, scope, hinted element around
    opened: Counter[str] = Counter()  # tags on the stack
    linked = links = scopes = 0
    block = link_block = ""  # the paragraph, item, heading or cell that is open, and the one in which the link began
    link_depth = 0
    item = heading = False

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text and not (stack and stack[-1][1]):
                found.append((Block(text, linked, stack[-1][2] if stack else 0, item, heading), stack[-1][3] if stack else None))
            pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = unescape(raw) if "&" in raw else raw
        pieces.append(text)
        if links:
            linked += len("".join(text.split()))

    at, end = 0, len(html)
    while at < end:
        token = _TOKEN.search(html, at)
        if token is None:
            add(html[at:])
            break
        if token.start() > at:
            add(html[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        closing, tag = bool(token[1]), token[2].lower()
        if tag in _RAW and not closing:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = close.end() if close else end
            if tag not in ("noscript", "iframe", "noembed", "textarea"):
                continue
            pieces.append(" ")
            continue
        if tag == "a":
            links, link_block, link_depth = (0, "", 0) if closing else (1, block, len(stack))
            continue
        if tag in _INLINE:
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        flush()
        # A link goes on over the blocks in it, and ends with the block or the element it began in.
        if links and link_block and (tag == link_block or not closing and link_block in _CLOSED_BY_BLOCKS):
            links = 0
        block = "" if closing or tag in _NESTED or tag in _VOID else tag
        if tag == "li":
            item = not closing
        if len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
            heading = not closing
        if tag in _VOID or tag not in _NESTED:
            continue
        if closing:
            if opened[tag]:  # else nothing of that name is open
                while True:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == tag:
                        break
                if len(stack) < link_depth:
                    links = 0
            continue
        dropped, scope, hinted = stack[-1][1:] if stack else (False, 0, None)
        if tag in ("article", "main") and not scope:
            scopes += 1
            scope = scopes
        why = "" if dropped else _is_dropped(tag, token[3], bool(scope) and tag == "header")
        if why == "kind":
            dropped = True
        elif why == "hint":
            hinted = Hinted(hinted)
        if tag in ("article", "main") and not dropped:
            holder = hinted
            while holder and holder.dropped:  # what is around a kept one is kept already
                holder.dropped, holder = False, holder.around
        stack.append((tag, dropped, scope, hinted))
        opened[tag] += 1
    flush()
    return [block for block, hinted in found if not (hinted and hinted.dropped)]


def first_pass(block: Block, short: int, dense: float, link_share: float) -> int:
    """Good, bad or open, from the block alone.

    Inside an article a linked heading, which may be its title, is left to its neighbours.
    """
    size = len("".join(block.text.split()))
    share = block.linked / size
    if share > link_share:
        return OPEN if block.heading and block.scope else BAD
    if len(block.text) < short:
        return BAD if not block.scope and _RIGHTS.search(block.text) else OPEN
    words = _WORD.findall(block.text.lower())
    if words and sum(w in _STOP_WORDS for w in words) / len(words) >= dense:
        return GOOD
    return OPEN


def second_pass(labels: list[int], in_article: bool) -> list[bool]:
    """Open blocks take the label of the nearest decided neighbours of their region.

    Between a good and a bad neighbour the nearer one wins; on a tie the good one inside an article,
    the bad one elsewhere. The ends of an article count as good neighbours. A region without a
    decided block is kept whole.
    """
    n = len(labels)
    before, after = [(OPEN, n + 1)] * n, [(OPEN, n + 1)] * n
    edge = (GOOD, 0) if in_article else (OPEN, n + 1)
    last = edge
    for i in range(n):
        last = (labels[i], 0) if labels[i] else (last[0], last[1] + 1)
        before[i] = last
    last = edge
    for i in range(n - 1, -1, -1):
        last = (labels[i], 0) if labels[i] else (last[0], last[1] + 1)
        after[i] = last
    kept = []
    for own, (left, near), (right, far) in zip(labels, before, after, strict=True):
        if own:
            kept.append(own == GOOD)
        elif left == right or not left or not right:
            kept.append((left or right) != BAD)
        else:
            kept.append((left == GOOD) if near < far else (right == GOOD) if far < near else in_article)
    return kept


def main_text(html: str | None, short: int = 70, dense: float = 0.2, link_share: float = 0.5) -> str:
    """The article of one page: kept blocks in page order, joined by one space; empty for null.

    ``short`` is the length in characters under which a block is not decided by itself, ``dense``
    the share of stop words that makes it text, ``link_share`` the share of linked characters that
    makes it a menu.
    """
    if not html:
        return ""
    found = [b for b in blocks(html) if b.text.strip(" :-–").lower() not in _ADVERT_LABELS]
    scoped = [b for b in found if b.scope]
    if scoped:
        found = scoped  # the page says where its article is
    regions: dict[int, list[Block]] = {}
    for b in found:
        b.label = first_pass(b, short, dense, link_share)
        regions.setdefault(b.scope, []).append(b)
    decided = {scope: members for scope, members in regions.items() if any(b.label == GOOD for b in members)}
    regions = decided or regions  # cards and teasers beside an article have no text of their own
    kept: set[int] = set()
    for scope, members in regions.items():
        for b, keep in zip(members, second_pass([b.label for b in members], bool(scope)), strict=True):
            if keep:
                kept.add(id(b))
    return " ".join(b.text for b in found if id(b) in kept)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page its id, url, main text and the length of that in code points.

    Other columns of ``pages`` are left out, whatever their names. Rows of an empty table, null
    pages and repeated pages each give one row per input row.
    """
    source = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), pages[html].alias("html"))
    kinds = dict(source.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return source.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
