"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block of the page. A line weighs as many characters as it shows
outside links; lines of menus, forms, adverts and the like are taken out, unless what looks like one holds
nearly all the text of a page that marks no article. Over sliding windows of lines the weights are summed:
text begins where a window's sum surges over a threshold and ends where it dives to nothing, and all
lines between are kept, short ones too. Inside an article or main element any text is a surge, since the
page itself says where its text is. Text runs on across an advert; only between an article element and
what stands outside it does a line taken out end a stretch. A heading from which lines lead up to a stretch
begins it. The text of a page that never surges is what it shows, unless most of that is links.
"""

import html as entities
import re
from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lines in a window, and the sum from which a window counts as text.
WINDOW, SURGE = 3, 80

# Fixed values of the HTML standard: elements whose content is not text of the page.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
HIDDEN = RAW | {"head", "noscript", "template", "svg", "math", "object", "canvas", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}

# What is not the article: elements, roles, and words of class names and ids.
ASIDE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu"}
CONTAINER = {"article", "main"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert",
               "form", "menu", "menubar", "toolbar"}
READERS = {"comment", "comments", "commentlist", "respond", "disqus", "replies", "discussion"}
ASIDE_WORDS = READERS | {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "adsense", "sponsor", "sponsored", "promo",
    "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "sidebar",
    "aside", "header", "masthead", "footer", "copyright", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
    "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "form",
    "search", "share", "sharing", "social", "related", "recommended", "widget", "toolbar"}
# Names such as "with-sidebar" describe a layout, and "search-result-article" holds what it names last.
LAYOUT_WORDS = {"has", "with", "no", "without", "is"}
TEXT_WORDS = {"article", "story", "content", "body", "text", "entry"}
# Elements that are never the article, however much of the page they hold; others are asides only while
# they hold less than this share of a page without article or main.
NEVER = {"nav", "footer", "button", "select", "dialog", "menu"}
NEARLY_ALL = 0.75

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")
_TAG = re.compile(r"</?[a-zA-Z]")
_RIGHTS = re.compile(r"(©|\(c\)|copyright\b|all rights reserved)", re.I)


def _aside(tag, rest, inside):
    """Why an element is not part of the article: "never", "element", "name", "readers" or nothing."""
    if tag in ("html", "body"):
        return ""
    kind = "never" if tag in NEVER else "element" if tag in ASIDE or tag == "header" and not inside else ""
    if "=" not in rest:
        return kind
    for name, *values in _ATTRIBUTE.findall(rest):
        value, name = next((v for v in values if v), ""), name.lower()
        if name == "role":
            if value.strip().lower() in ASIDE_ROLES:
                kind = kind or "element"
            continue
        for one in value.split():
            words = {w.lower() for w in _NAME_WORDS.findall(one)}
            if words & READERS:
                return "readers"
            if tag not in CONTAINER | HEADING and words & ASIDE_WORDS and not words & (LAYOUT_WORDS | TEXT_WORDS):
                if not (inside and words & {"header"}):
                    kind = kind or "name"
    return kind


def _tokens(page):
    """(kind, tag, rest or text): "open", "close" or "text", in page order."""
    found, raw, at = [], None, 0
    while at < len(page):
        if raw:  # up to the end tag of a script or the like, whatever stands before it
            end = re.compile(rf"</{re.escape(raw)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            found.append(("close", raw, ""))
            at, raw = (end.end() if end else len(page)), None
            continue
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag:
            tag, close = tag.lower(), m["end"] or m["end2"]
            rest = m["rest"] if m["tag"] else m["rest2"]
            found.append(("close" if close else "open", tag, rest or ""))
            if not close and tag in RAW:
                raw = tag
        elif m["text"] or m["cdata"]:
            found.append(("text", "", m["text"] if m["text"] else m["cdata"]))
    return found


def _matched(tokens):
    """Per open tag that has one, the place of its end tag; inner tags left open end with it."""
    ends, open_at = {}, {}
    for i, (kind, tag, _) in enumerate(tokens):
        if kind == "open" and tag not in VOID and tag not in INLINE:
            open_at.setdefault(tag, []).append(i)
        elif kind == "close" and open_at.get(tag):
            ends[open_at[tag].pop()] = i
    return ends


def lines_of(page):
    """[(text, weight, place)] of a page's blocks; weight is None where a line is not of the article.

    The place is "article" inside an article or main element, "heading" in a heading outside it, or nothing.
    """
    tokens = _tokens(page)
    ends, parts, shown = _matched(tokens), _next_parts(tokens), _shown(tokens)
    lines, piece, linked = [], [], 0
    out_until, container_until, hidden_until, heading_until, links = -1, -1, -1, -1, 0
    containers = [i for i, (kind, tag, _) in enumerate(tokens) if kind == "open" and tag in CONTAINER]

    def close_line():
        nonlocal piece, linked
        if piece:
            text = _SPACE.sub(" ", entities.unescape("".join(piece))).strip()
            if text:
                weight = max(0, len(text) - linked)
                if container_until < 0 and _RIGHTS.match(text) and len(text) < 200:
                    weight = 0
                place = "article" if container_until >= 0 else "heading" if heading_until >= 0 else ""
                lines.append((text, None if out_until >= 0 else weight, place))
        piece, linked = [], 0

    for i, (kind, tag, rest) in enumerate(tokens):
        if kind == "text":
            if hidden_until < 0:
                piece.append(rest)
                linked += len(entities.unescape(rest)) if links else 0
            continue
        if tag == "a":
            links = 1 if kind == "open" else 0
        if tag not in INLINE:
            close_line()
            links = 0
        for name in ("out", "container", "hidden"):
            limit = {"out": out_until, "container": container_until, "hidden": hidden_until}[name]
            if limit >= 0 and i >= limit:
                if name == "out":
                    out_until = -1
                elif name == "container":
                    container_until = -1
                else:
                    hidden_until = -1
        if heading_until >= 0 and i >= heading_until and tag not in INLINE:
            heading_until = -1
        if kind == "close" or tag in VOID:
            continue
        if tag in HEADING:
            heading_until = ends.get(i, i)
        if tag in HIDDEN and hidden_until < 0:
            hidden_until = ends.get(i, parts[i])
        elif tag in CONTAINER or tag not in INLINE or "=" in rest:
            why = _aside(tag, rest, container_until >= 0)
            if why and out_until < 0:
                end = ends.get(i, i if tag in INLINE else parts[i])
                # A wrapper named like a menu that holds the article itself is no menu.
                after = bisect_right(containers, i)
                holds = why == "name" and after < len(containers) and containers[after] < end
                held = shown[end] - shown[i]
                if why in ("name", "element") and not containers and held >= max(SURGE, NEARLY_ALL * shown[-1]):
                    holds = True
                if not holds:
                    out_until = end
            elif tag in CONTAINER and not why and container_until < 0 and out_until < 0:
                container_until = ends.get(i, len(tokens))
    close_line()
    return lines


def _next_parts(tokens):
    """Per token, where an element that begins there and is never closed ends: before the next part of the page."""
    found, after = [len(tokens)] * len(tokens), len(tokens)
    for j in range(len(tokens) - 1, -1, -1):
        found[j] = after
        kind, tag, _ = tokens[j]
        if (kind == "open" and (tag in CONTAINER or tag in ASIDE or tag in ("section", "header", "body", "h1"))
                or kind == "close" and tag in ("body", "html", "article", "main")):
            after = j
    return found


def _shown(tokens):
    """How many characters outside links stand before each token."""
    found, total, link = [], 0, False
    for kind, tag, rest in tokens:
        found.append(total)
        if kind == "text":
            total += 0 if link else len(rest.strip())
        elif tag == "a":
            link = kind == "open"
        elif tag not in INLINE:
            link = False
    return [*found, total]


def kept_lines(weights, window=WINDOW, surge=SURGE):
    """Which lines lie between a surge and a dive; `weights` has nan where a stretch must end. The sum that is
    a surge is one number or one per line."""
    weights = np.asarray(weights, dtype=np.float64)
    surge = np.broadcast_to(surge, weights.shape)
    n, kept = len(weights), np.zeros(len(weights), dtype=bool)
    if not n:
        return kept
    barrier = np.isnan(weights)
    start = 0
    for stop in [*np.flatnonzero(barrier), n]:
        if stop > start:
            own = weights[start:stop]
            run = np.concatenate([[0.0], np.cumsum(own)])
            ahead = run[np.minimum(np.arange(len(own)) + window, len(own))] - run[:-1]
            inside = False
            for i in range(len(own)):
                if not inside and own[i] > 0 and ahead[i] >= surge[start + i]:
                    inside = True
                elif inside and ahead[i] == 0:
                    inside = False
                kept[start + i] = inside
            filled = np.flatnonzero(kept[start:stop] & (own > 0))  # a stretch ends on a line that weighs
            last = filled[-1] if len(filled) else -1
            kept[start + last + 1:stop] = False
        start = stop + 1
    return kept


def main_text(page, window=WINDOW, surge=SURGE):
    """The article of one page as text; empty where there is none."""
    if not page:
        return ""
    lines, cut = [], False
    for text, weight, place in lines_of(page):
        if weight is None:
            cut = True
            continue
        if cut and lines and "article" in (lines[-1][2], place):
            lines.append(("", np.nan, ""))
        lines.append((text, weight, place))
        cut = False
    weights = np.array([weight for _, weight, _ in lines], dtype=np.float64)
    kept = kept_lines(weights, window, np.where([place == "article" for *_, place in lines], min(surge, 1), surge))
    if not kept.any() and _TAG.search(page) and 2 * np.nansum(weights) > sum(len(text) for text, *_ in lines):
        kept = kept_lines(weights, window, min(surge, 1))
    start, across = None, False  # the kept line that all lines from here on lead up to
    for i in reversed(range(len(lines))):
        if kept[i]:
            start = i
        elif np.isnan(weights[i]):
            start = start if start == i + 1 else None
        elif lines[i][2] == "heading" and start is not None:
            kept[i:start], start = True, i
        elif across or not weights[i]:
            start = None
        across = np.isnan(weights[i])
    return " ".join(text for (text, *_), keep in zip(lines, kept) if keep and text)


def extract(pages: DataFrame, html_col="html", text_col="text", window=WINDOW, surge=SURGE) -> DataFrame:
    """All columns of `pages` but the html, with its main text and n_chars.

    Null or empty html gives an empty text, as does a page of little text without markup. Columns called like the
    results are replaced. Rows are independent: repeated ones give repeated results.
    """
    @F.pandas_udf("string")
    def texts(column: pd.Series) -> pd.Series:
        return column.map(lambda page: main_text(page, window, surge), na_action=None)

    kept = [c for c in pages.columns if c not in (html_col, text_col, "n_chars")]
    found = pages.select(*kept, texts(F.coalesce(F.col(html_col), F.lit(""))).alias(text_col))
    return found.withColumn("n_chars", F.length(text_col).cast("long"))
