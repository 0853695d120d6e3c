"""Main-text extraction from HTML by two-pass block rules.

A page is cut into blocks at block-level tags. Pass one labels a block by its densities: BAD where most of it is links,
GOOD where it is long, has few links and many stop words. On a page without any long block of many stop words (another
language) long blocks with few links are GOOD whatever their words. All others are undecided: short ones, and
long ones of few stop words, such as code, tables and lists of names. In pass two an undecided block takes the label of
its nearest decided neighbour (the one before on ties, for a heading the one after).

Elements are evidence. Within article or main an undecided block is BAD only between two BAD ones, and if nothing on the
page is GOOD all of it stays; a heading there stays though it is a link. Elsewhere a short block with some links, or with a copyright sign and few stop
words, is BAD. What densities cannot tell from the article goes by its element: text of readers' comments, notices, adverts,
menus and the like inside navigation, headers, footers, asides and forms, or inside elements whose class, id or role says so. Without decided blocks outside
article and main the text there is kept only if the page has nothing better.

Scale: one row in, one row out, no shuffle; a task holds one Arrow batch. Each page is read in
one pass whose work is linear in its length.

Defined cases: null or empty html gives empty text. Markup cut off at the end of the page is
dropped. Unclosed elements end with their container.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namewright.llm.common import by_batch, carried

LONG = 140
LINKS_BAD, LINKS_LOW, STOPS_HIGH = 0.5, 0.25, 0.12

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""\shidden\b|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_DENSE = re.compile(r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af\uf900-\ufaff]")

_RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frame "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
_CHROME = frozenset("nav header footer aside form menu button select fieldset head dialog svg canvas object audio video map search datalist".split())
_MAIN = frozenset("article main".split())
_TRACKED = _CHROME | _MAIN | frozenset("div section ul ol table td figure body span p".split())
_ROLES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead "
    "cookie cookies consent gdpr notice popup modal overlay comment comments disqus replies reply share sharing social related recommended newsletter subscribe subscription signup login "
    "search widget toolbar pagination pager copyright legal contentinfo complementary".split()
)
_STOPS = frozenset(
    "a an and are as at be by for from has have he in is it its not of on or that the their this to was were which with you "
    "auf aus das dass dem den der des die ein eine einen einer er es für ich im ist mit nicht sich sie und von war wie zu zum "
    "au aux avec ce ces dans de des du elle en est et il je la le les ne nous par pas plus pour qui que se sur un une vous "
    "al como con de del el en es ese está la las lo los más no para pero por que se sin su sus un una y".split()
)


class _Block:
    __slots__ = ("parts", "links", "region", "text", "label", "heading")

    def __init__(self, region: str, heading: bool):
        self.parts, self.links, self.region, self.heading = [], 0, region, heading
        self.text, self.label = "", None


def _says_chrome(attrs: str, region: str) -> bool:
    """Whether class, id or role name a part of the page that is no main text; an article's own header is."""
    if not attrs:
        return False
    for m in _ATTR.finditer(attrs):
        if not _ROLES.isdisjoint(w for w in re.split(r"[^a-z]+", m[1].lower()) if region != "main" or w != "header"):
            return True
    return bool(_HIDDEN.search(attrs))


def blocks(page: str) -> list[_Block]:
    """The page's text blocks in order, each with its region: chrome, main or body."""
    out: list[_Block] = []
    stack: list[tuple[str, str]] = []  # tracked open elements with the region inside them
    region, links, at, heading = "body", 0, 0, False
    current = _Block(region, False)

    def text(raw: str) -> None:
        if raw:
            if "&" in raw:
                raw = html.unescape(raw)
            current.parts.append(raw)
            if links:
                current.links += len("".join(raw.split()))

    def end() -> None:
        nonlocal current
        if current.parts:
            current.text = " ".join("".join(current.parts).split())
            if current.text:
                out.append(current)
        current = _Block(region, heading)

    lower = None
    while m := _TOKEN.search(page, at):
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if closing:
            if tag == "a":
                links = max(0, links - 1)
            if tag in _TRACKED:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
                    if stack[k][0] in _MAIN or stack[k][0] in _CHROME and tag not in _MAIN | _CHROME:
                        break  # a stray end tag doesn't close the container around it
                region = stack[-1][1] if stack else "body"
        elif tag in _RAW:
            lower = page.lower() if lower is None or len(lower) != len(page) else lower
            close = lower.find(f"</{tag}", at) if len(lower) == len(page) else -1
            if len(lower) != len(page):  # lower case changed the length
                found = re.compile(f"</{tag}", re.I).search(page, at)
                close = found.start() if found else -1
            at = len(page) if close < 0 else close
            continue
        else:
            attrs = m[3]
            if tag in _BLOCK and stack and stack[-1][0] == "p" and tag != "br":  # ends an open paragraph
                stack.pop()
                region = stack[-1][1] if stack else "body"
            if tag == "a" and not attrs.rstrip().endswith("/"):
                links += 1
            if tag in _TRACKED and tag not in _VOID and (tag not in ("p", "span") or _says_chrome(attrs, region)):
                chrome = region == "chrome" or (tag in _CHROME and not (tag == "header" and region == "main")) or (tag not in ("body", *_MAIN) and _says_chrome(attrs, region))
                region = "chrome" if chrome else "main" if tag in _MAIN else region
                stack.append((tag, region))
        if tag in _BLOCK or region != current.region:
            heading = not closing and len(tag) == 2 and tag[0] == "h" and tag[1] in "123456"
            if tag in _BLOCK:
                links = links if tag == "br" else 0
            end()
    text(page[at:])
    end()
    return out


def _size(b: _Block) -> int:
    """Length in letters of an alphabet: one of Chinese, Japanese or Korean says about as much as three."""
    return len(b.text) + (0 if b.text.isascii() else 2 * len(_DENSE.findall(b.text)))


def _linked(b: _Block) -> float:
    return b.links / max(1, len(b.text) - b.text.count(" "))


def _stops(b: _Block) -> float:
    """The share of stop words."""
    found = _WORD.findall(b.text.lower())
    return sum(w in _STOPS for w in found) / max(1, len(found))


def _first_pass(found: list[_Block]) -> None:
    """Labels from length, link and stop-word density; blocks that these leave open stay None."""
    measured = []
    for b in found:
        size, linked = _size(b), _linked(b)
        if b.region == "chrome" or (linked > LINKS_BAD and not (b.region == "main" and b.heading)):
            b.label = False
        elif b.region == "body" and size < LONG and linked > LINKS_LOW:
            b.label = False
        elif size >= LONG and linked <= LINKS_LOW:
            measured.append((b, _stops(b)))
        elif b.region == "body" and "©" in b.text and size < LONG and _stops(b) < STOPS_HIGH:
            b.label = False
    known = any(stops >= STOPS_HIGH for _, stops in measured)
    for b, stops in measured:
        if stops >= STOPS_HIGH or not known:
            b.label = True


def _inherit(own: list[_Block], main: bool) -> None:
    """Undecided blocks among the ``own`` ones, in page order, take the label of their nearest decided neighbour; within
    an article or main element they are BAD only between two BAD ones."""
    decided = [i for i, b in enumerate(own) if b.label is not None]
    labels = [own[i].label for i in decided]
    for k, (a, b) in enumerate(pairwise([-1, *decided, len(own)])):
        before, after = (labels[k - 1] if k else None), (labels[k] if k < len(labels) else None)
        for i in range(a + 1, b):
            if main:
                own[i].label = not (before is False and after is False)
            elif before is None or after is None:
                own[i].label = after if before is None else before
            else:
                own[i].label = after if b - i < i - a or own[i].heading else before


def _second_pass(found: list[_Block]) -> None:
    main, body = ([b for b in found if b.region == region] for region in ("main", "body"))
    _inherit(main, True)
    if not any(b.label for b in found):
        for b in main:
            b.label = True
    if any(b.label is not None for b in body):
        _inherit(body, False)
    else:
        keep = not any(b.label for b in found)
        for b in body:
            b.label = keep


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    _first_pass(found)
    _second_pass(found)
    return " ".join(b.text for b in found if b.label)


def extract(pages: DataFrame, keep: list[str | Column], markup: str = "html") -> DataFrame:
    """The ``keep`` columns of every row, text and n_chars (code points) of its main text."""
    arrow, schema = carried(pages, keep, "text string, n_chars long")

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = [main_text(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
        yield {f: batch.column(k) for k, (f, _) in enumerate(arrow)} | {"text": texts, "n_chars": [len(t) for t in texts]}

    return pages.select(*keep, F.col(markup).alias("__markup")).mapInArrow(by_batch(rows, [*arrow, ("text", pa.string()), ("n_chars", pa.int64())]), schema)
