"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines, one for each block element. A line's weight is its number of characters;
lines of menus, headers, footers, sidebars, notices, adverts, forms and reader comments weigh nothing,
nor do those outside the article or main element of a page that has one. The weights are summed over
windows of WINDOW lines. Text surges where the sum rises over the threshold and dives where it falls
to it again; the lines of weight between a surge and its dive are the text. In a page with an article
element the threshold is zero, so short paragraphs stay; else it is THRESHOLD characters outside links.
If no window passes it, the heaviest window does.

Defined cases: a null or empty page gives an empty text; markup that is cut off ends with the page;
a comment, script or style without an end reaches to the end of the page. Any other part that is left out ends with its
element: at its closing tag, at the start of what ends a p, li, dt, dd, option, heading, part of a table or head whose closing
tag is left out, or where an outer element closes.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW = 3
THRESHOLD = 80
#: Elements that hold no text, that are never part of an article, and that are blocks.
SILENT = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "head", "title",
          "select", "textarea", "button", "audio", "video"}
APART = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div",
          "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary",
          "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Words of a class, id or role that mark a part as not the article's.
MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "adbox", "banner", "breadcrumb", "breadcrumbs", "comment",
         "comments", "complementary", "contentinfo", "cookie", "cookies", "consent", "disclaimer", "disqus", "footer",
         "gdpr", "header", "masthead", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
         "popup", "promo", "related", "replies", "search", "share", "sharing", "sidebar", "sponsor", "sponsored",
         "subscribe", "topbar", "widget"}
#: What may be in a head; what starts a row of a table or the like, and what each ends; where the search for an open element stops.
HEAD = {"base", "basefont", "bgsound", "head", "html", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
TABLE = {"caption", "colgroup", "tbody", "thead", "tfoot", "tr", "td", "th"}
ENDS = {"td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th", "caption", "colgroup"},
        **dict.fromkeys(("caption", "colgroup", "tbody", "thead", "tfoot"), TABLE)}
SCOPE = {"html", "table", "td", "th", "caption", "template", "object", "svg", "math", "button"}
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def _marked(attributes: str) -> bool:
    for found in ATTRIBUTE.finditer(attributes):
        value = (found[1] or found[2] or found[3] or "").lower()
        if any(x in MARKS for x in re.split(r"[\s_-]+", value)):
            return True
    return False


def _ended_by_start(stack: list[str], name: str) -> int:
    """How many open elements stay when an element starts: those whose closing tags are left out end."""
    if "head" in stack and name not in HEAD:
        return stack.index("head")
    if name in ENDS:
        keep = len(stack)
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] in ("table", "template"):
                break
            if stack[i] in ENDS[name]:
                keep = i
        return keep
    if name in ("option", "optgroup"):
        keep = len(stack)
        while keep and stack[keep - 1] in (("option",) if name == "option" else ("option", "optgroup")):
            keep -= 1
        return keep
    keep = len(stack)
    if name in ("li", "dt", "dd"):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i] == name or name != "li" and stack[i] in ("dt", "dd"):
                keep = i
                break
            if stack[i] in BLOCKS - {"address", "div", "p"} or stack[i] in SCOPE:
                break
    if name in BLOCKS and name not in ("html", "body", "legend"):
        for i in range(keep - 1, -1, -1):
            if stack[i] == "p":
                keep = i
                break
            if stack[i] in SCOPE:
                break
    if name in HEADINGS and keep and stack[keep - 1] in HEADINGS:
        keep -= 1
    return keep


def _ended_by_close(stack: list[str], name: str) -> int | None:
    """Where in the stack the element is that a closing tag ends, None if it ends none."""
    barrier = {"table"} if name in TABLE else set() if name in SCOPE else SCOPE
    for i in range(len(stack) - 1, -1, -1):
        if stack[i] == name or name in HEADINGS and stack[i] in HEADINGS:
            return i
        if stack[i] in barrier:
            break
    return None


def lines(page: str) -> list[tuple[str, int, bool]]:
    """(text, characters outside links, in the article) of each line; lines of other parts have the text ''."""
    out: list[tuple[str, int, bool]] = []
    text: list[str] = []
    linked = anchors = 0
    stack: list[str] = []  # the open elements
    apart: int | None = None  # the place in the stack of the element that is skipped

    def flush() -> None:
        nonlocal linked
        line = " ".join(entities.unescape("".join(text)).split())
        if line:
            out.append((line, max(0, len(line) - linked), "article" in stack or "main" in stack))
        text.clear()
        linked = 0

    def end(keep: int) -> None:
        """Closes the open elements from a place in the stack on."""
        nonlocal apart
        if apart is None and any(x in BLOCKS for x in stack[keep:]):
            flush()
        elif apart is not None and keep < apart and any(x in BLOCKS for x in stack[keep:apart]):
            flush()
        del stack[keep:]
        if apart is not None and keep <= apart:
            apart = None

    at = 0
    while at < len(page):
        found = TAG.search(page, at)
        piece = page[at:found.start()] if found else page[at:]
        if apart is not None and stack[-1] == "head" and piece.strip():
            end(len(stack) - 1)  # text is never in a head
        if piece and apart is None:
            text.append(piece)
            if anchors:
                linked += len(piece)
        if not found:
            break
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        closing = bool(found[1] or found[4])
        attributes = found[3] or found[6] or ""
        alone = attributes.endswith("/") or name in VOID
        if name in ("script", "style", "textarea", "title"):
            if not closing and not alone:
                close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = close.end() if close else len(page)
            if apart is None:
                text.append(" ")
            continue
        if closing:
            if name in ("html", "body"):
                if apart is None:
                    flush()
                continue
            if name in BLOCKS and apart is None:
                flush()
            place = _ended_by_close(stack, name)
            if name == "a" and (apart is None or place is not None and place < apart):
                anchors = max(0, anchors - 1)
            if place is not None:
                if name not in BLOCKS and name not in SILENT and any(x in BLOCKS for x in stack[place + 1:]) and place != apart:
                    del stack[place]  # blocks that began in an inline element go on after it
                    if apart is not None and place < apart:
                        apart -= 1
                else:
                    end(place)
            if name in SILENT and apart is None:
                text.append(" ")
            continue
        keep = _ended_by_start(stack, name)
        if keep < len(stack):
            end(keep)
        if apart is not None:
            if not alone:
                stack.append(name)
            continue
        if name in SILENT:
            if not alone:
                apart = len(stack)
                stack.append(name)
            text.append(" ")
            continue
        if not alone and name not in ("html", "body", "article", "main") and (name in APART or _marked(attributes)):
            if name in BLOCKS:
                flush()
                out.append(("", 0, False))
            apart = len(stack)
            stack.append(name)
            continue
        if name in BLOCKS:
            flush()
        elif name == "br":
            text.append(" ")
        elif name == "a":
            anchors += 1
        if not alone or name in ("article", "main"):
            stack.append(name)
    flush()
    return out


def main_text(page: str | None) -> str:
    found = lines(page or "")
    inside = any(x[2] for x in found)
    weights = np.array([(len(t) if a else 0) if inside else plain for t, plain, a in found], np.int64)
    if not len(weights) or not weights.any():
        return ""
    sums = np.convolve(weights, np.ones(WINDOW, np.int64))[WINDOW - 1:]  # of a line and those after it
    threshold = 0 if inside else min(THRESHOLD, int(sums.max()) - 1)
    high = sums > threshold
    keep = np.zeros(len(weights), bool)
    for i in np.flatnonzero(high):
        keep[i:i + WINDOW] = True
    return "\n".join(t for (t, _, a), k, w in zip(found, keep, weights, strict=True) if k and t and (w or not inside and len(t)))


def _extracted(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(x) for x in pages.to_pylist()], pa.string())


def extract(html: Column | str) -> Column:
    """The main text of a page."""
    return F.arrow_udf(_extracted, "string")(html)
