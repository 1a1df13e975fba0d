"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  Pass one decides by link
density, length and stop-word density, and by the container a block stands in:
navigation, forms, adverts and the like are boilerplate, article and main are
content.  Short blocks and long ones without stop words stay undecided.  In
pass two an undecided block inherits the label of its nearest decided
neighbours, those in its own container first.  If article and main hold most
of the text found, what stands outside them is dropped; else both stay.

The headings of an article that stand in its own header are its title and belong
to it; the rest of such a header does not.  A class or id marks boilerplate only if
every part of the name says so ("cookie-notice", "site-header"), not one part of a
longer name ("legal-history").  Where less than a quarter of a page's long text is
dense in stop words of the list, its language is none of the list's: then length,
letters and links decide, in any script.

Scripts, styles, comments in markup and hidden text never become blocks.
Every step is linear in the page.

Defined results: null or empty html, or a page without main text, gives the
empty text; markup cut off at the end of a page ends there; repeated rows are
answered each; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices

# fixed values: frequent function words of the four languages
STOP_WORDS = frozenset("""
a an and are as at be but by for from had has have he her his i in is it its not of on or she so that the their
they this to was we were which who will with you
au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas pour que
qui sa se ses son sont sur un une vous y
als am an auch auf aus bei das dass dem den der des die durch ein eine einen einer es für hat ich im in ist mit
nach nicht noch nur oder sich sie sind so über um und von war wie wir zu zum zur
al como con cual del el ella ellos entre era es esta este fue ha hasta hay la las lo los mas me mi muy no nos o
para pero por que se ser si sin sobre su sus tiene todo un una y ya
""".split())

# fixed values: element and attribute names
RAW = {"script", "style", "textarea", "title"}
# skipped up to their end tag; without one they are ordinary tags
SKIPPED = {"noscript", "template", "svg", "iframe", "object", "canvas"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCK = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "div", "section", "article", "main", "nav", "aside", "header",
         "footer", "form", "ul", "ol", "li", "dl", "dt", "dd", "table", "tr", "td", "th", "thead", "tbody", "tfoot",
         "caption", "blockquote", "pre", "figure", "figcaption", "hr", "address", "fieldset", "details", "summary",
         "dialog", "menu", "body", "html", "head", "select", "option", "button", "center"}
CONTAINER = {"div", "section", "article", "main", "nav", "aside", "header", "footer", "form", "ul", "ol", "dl",
             "table", "blockquote", "figure", "fieldset", "details", "dialog", "menu", "body", "html", "head",
             "select", "button", "address", "label", "center"}
BOILER_TAGS = {"nav", "aside", "header", "footer", "form", "fieldset", "dialog", "menu", "head", "select", "button"}
CONTENT_TAGS = {"article", "main"}
BOILER_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
                "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "header",
                "masthead", "banner", "cookie", "cookies", "consent", "notice", "alert", "popup", "modal", "overlay",
                "comment", "comments", "reply", "replies", "disqus", "respond", "share", "sharing", "social",
                "newsletter", "subscribe", "subscription", "signup", "login", "search", "related", "recommended",
                "widget", "toolbar", "pagination", "pager", "copyright", "contentinfo", "complementary", "legal",
                "disclaimer", "teaser", "skip"}
# parts of names that say where or what kind of box something is, not what is in it
NEUTRAL_WORDS = {"site", "page", "top", "bottom", "left", "right", "global", "primary", "secondary", "main", "article",
                 "post", "posts", "story", "entry", "box", "block", "bar", "list", "item", "items", "area", "wrap",
                 "wrapper", "container", "inner", "outer", "section", "content", "button", "buttons", "btn", "link",
                 "links", "icon", "icons", "form", "col", "column", "row", "panel", "slot", "unit", "group", "text",
                 "message", "policy", "js", "the", "mobile", "desktop", "sticky", "fixed", "mini", "small", "large"}
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
ATTRIBUTES = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

LONG, LINKED, DENSE, LISTED = 70, 0.33, 0.2, 0.25
GOOD, BAD, OPEN = 1, -1, 0


def _tag_end(page: str, at: int) -> int:
    """Index after the '>' that closes the tag, quotes respected; page end if none."""
    n = len(page)
    while at < n:
        close = page.find(">", at)
        if close < 0:
            return n
        quote = min((q for q in (page.find('"', at, close), page.find("'", at, close)) if q >= 0), default=-1)
        if quote < 0 or page[quote - 1] != "=" and not page[at:quote].rstrip().endswith("="):
            return close + 1
        end = page.find(page[quote], quote + 1)
        if end < 0:
            return close + 1
        at = end + 1
    return n


def _marked(attributes: str) -> tuple[bool, bool]:
    """(boilerplate by name, hidden)"""
    boiler = hidden = False
    for name, value in ATTRIBUTES.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        else:
            for word in value.split():
                parts = [x.lower() for x in NAME_PARTS.findall(word)]
                boiler |= any(x in BOILER_WORDS for x in parts) and all(x in BOILER_WORDS or x in NEUTRAL_WORDS for x in parts)
    return boiler, hidden


class Block:
    __slots__ = ("text", "linked", "container", "hint")

    def __init__(self, text, linked, container, hint):
        self.text, self.linked, self.container, self.hint = text, linked, container, hint


def blocks(page: str) -> list[Block]:
    """Blocks in page order; hint: boilerplate container, content container, or neither."""
    out, parts, linked, links = [], [], 0, 0
    stack: list[tuple] = []           # (tag, container number, hint, place of titles in an article's header)
    numbers, n, at = 0, len(page), 0
    lowered, own = None, False         # own: the open block itself is marked as boilerplate
    heading, endless = False, set()

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                _, number, hint, title = stack[-1] if stack else ("", 0, OPEN, None)
                if heading and title:
                    number, hint = title
                if own:                    # in no container: its neighbours don't follow it
                    number, hint = -1 - len(out), BAD
                out.append(Block(text, linked / len(text), number, hint))
        linked = 0

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            piece = page[at:lt]
            parts.append(piece)
            if links:
                linked += len(piece.strip())
        if lt == n:
            break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = TAG.match(page, lt)
        if not m:
            parts.append("<")
            at = lt + 1
            continue
        closing, tag = bool(m[1]), m[2].lower()
        at = _tag_end(page, m.end())
        if (tag in RAW or tag in SKIPPED and tag not in endless) and not closing:
            if page[at - 2:at] == "/>":
                continue
            if lowered is None:
                lowered = page.lower() if len(page.lower()) == n else page
            end = lowered.find(f"</{tag}", at)
            if end >= 0 or tag in RAW:
                at = n if end < 0 else _tag_end(page, end)
                continue
            endless.add(tag)
        if tag == "a":
            links = 0 if closing else 1
        if tag == "br":
            parts.append(" ")
        if tag in BLOCK:
            flush()
            links = 0
            own = not closing and tag not in CONTAINER and any(_marked(page[m.end():at]))
            heading = not closing and tag in HEADINGS
        if tag in CONTAINER:
            if closing:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
            else:
                hint = stack[-1][2] if stack else OPEN
                boiler, hidden = (False, False) if tag in ("html", "body") else _marked(page[m.end():at])
                if tag in BOILER_TAGS or boiler or hidden:
                    hint = BAD
                elif tag in CONTENT_TAGS and hint != BAD:
                    hint = GOOD
                inside = stack[-1] if stack else None
                title = None
                if not hidden and hint == BAD and inside:
                    if tag == "header" and inside[2] == GOOD:
                        title = inside[1:3]
                    elif not boiler and tag not in BOILER_TAGS:
                        title = inside[3]
                # lists, tables and quotes in content count as part of it
                if hint == GOOD and inside and inside[2] == GOOD:
                    stack.append((tag, inside[1], hint, None))
                else:
                    numbers += 1
                    stack.append((tag, numbers, hint, title))
    flush()
    return out


def _stop_words(block: Block) -> tuple[int, int]:
    """(stop words, words)"""
    words = block.text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words), len(words)


def listed_language(found: list[Block]) -> bool:
    """Whether enough of the page's long, unlinked text is dense in stop words of the list."""
    dense = whole = 0
    for b in found:
        size = len(b.text.encode())
        if b.hint != BAD and b.linked <= LINKED and size >= LONG:
            stops, words = _stop_words(b)
            dense += size * (stops >= DENSE * words)
            whole += size
    return dense >= LISTED * whole


def first_pass(block: Block, listed: bool = True) -> int:
    if block.hint == BAD or block.linked > LINKED and block.hint != GOOD:
        return BAD
    if not listed:
        letters = sum(c.isalpha() for c in block.text)
        # characters outside ASCII say more than one letter does
        if len(block.text.encode()) >= LONG and 2 * letters >= len(block.text) and block.linked <= LINKED:
            return GOOD
        return OPEN
    stops, words = _stop_words(block)
    if len(block.text) >= LONG and stops >= DENSE * words and block.linked <= LINKED:
        return GOOD
    if block.hint == OPEN and len(block.text) >= LONG and not stops:
        return BAD
    return OPEN


def second_pass(found: list[Block], label: list[int]) -> list[int]:
    """Undecided blocks take the label of the nearest decided neighbours."""
    n = len(found)
    before, after = [None] * n, [None] * n
    for order, out in ((range(n), before), (range(n - 1, -1, -1), after)):
        near = None
        own: dict[int, int] = {}
        for k in order:
            out[k] = (own.get(found[k].container), near)
            if label[k] != OPEN:
                near = own[found[k].container] = k
    final = list(label)
    for k in range(n):
        if label[k] != OPEN:
            continue
        for level in (0, 1):
            sides = [s[k][level] for s in (before, after) if s[k][level] is not None]
            if sides:
                gap = min(abs(s - k) for s in sides)
                near = {label[s] for s in sides if abs(s - k) == gap}
                final[k] = GOOD if GOOD in near else BAD
                break
            if level == 0 and found[k].hint == GOOD:
                final[k] = GOOD          # content container without a decided block
                break
        else:
            final[k] = BAD
    return final


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    listed = listed_language(found)
    label = second_pass(found, [first_pass(b, listed) for b in found])
    size = {True: 0, False: 0}
    for b, x in zip(found, label):
        if x == GOOD:
            size[b.hint == GOOD] += len(b.text)
    if size[True] > size[False] > 0:       # a marked article that holds most of it is the whole of the main text
        for b in found:
            if b.hint == OPEN:
                b.hint = BAD
        label = second_pass(found, [first_pass(b, listed) for b in found])
    return "\n\n".join(b.text for b, x in zip(found, label) if x == GOOD)


def _extract(batches):
    for batch in batches:
        for part in slices(batch, "html", 8 << 20):
            text = [main_text(x) for x in pc.fill_null(part.column(2), "").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(text, pa.string()),
                 pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
