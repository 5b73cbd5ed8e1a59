"""Main-text extraction by tree scoring.

Each page becomes a tree of elements. Every paragraph has points for its length and commas. Elements that are boilerplate
by their tag are cut off. Forms, and elements whose class, id or role has a boilerplate word, are cut off unless they hold
much of the page's points (then the word tells of the page, not of the element); a weaker word that is only a part of a
class, id or role discounts the element's points. Paragraphs pass points to their ancestors, fewer the farther away; a
container's points are discounted by its link density. The best container, widened to the outermost article or main
element around it, its siblings that read like prose, what stands between them, and headings before it are kept.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    # Quotes count only after an equals sign.
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden(?:\s|$|=)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
# HTML element classes.
_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
           "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
           "sup", "time", "tt", "u", "var", "wbr", "br"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"ul", "ol", "dl", "table", "div", "article", "section", "main", "body", "blockquote", "td", "th", "aside", "form"}
_MAIN = {"article", "main"}
_KEPT = {"html", "body"} | _MAIN  # never boilerplate by their attributes
# Boilerplate tags, and the words of class, id and role that mark boilerplate: strong ones also as a part of a
# name, weak ones (which also name parts of articles) only as a whole one; and state words that say what a page has.
_DROP = {"script", "style", "noscript", "template", "textarea", "title", "head", "iframe", "object", "embed", "svg", "canvas",
         "audio", "video", "nav", "aside", "footer", "button", "select", "input", "menu", "dialog", "noembed",
         "noframes", "xmp"}
_STRONG = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
           "comments", "consent", "cookie", "cookies", "disqus", "gdpr", "login", "menu", "menubar", "modal", "nav", "navbar",
           "navigation", "newsletter", "pagination", "popup", "promo", "promoted", "replies", "share", "sharing", "sidebar",
           "signup", "social", "sponsor", "sponsored", "subscribe", "footer"}
_WEAK = {"alert", "complementary", "contentinfo", "disclaimer", "discussion", "form", "header", "masthead", "notice", "notices",
         "related", "respond", "search", "skip", "toolbar", "topbar", "widget"}
_READERS = {"comment", "comments", "disqus", "replies"}  # may be longer than the article
_STATES = {"has", "no", "not", "with", "without", "open", "closed", "enabled", "disabled", "off", "on"}
_FORMS = {"form", "fieldset"}
_FLOW = {"p", "blockquote", "ul", "ol", "dl", "pre", "table", "figure", "h2", "h3", "h4", "h5", "h6"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
MIN_PARAGRAPH = 25
CUT_SHARE = 0.5  # of the page's paragraph points: forms and worded elements that hold no more are cut,
READERS_SHARE = 0.85  # and so are readers' comments up to this share
WORD_DISCOUNT = 0.25
LEVELS = 64  # ancestors that get points of a paragraph; those beyond would get under half a hundredth
PROSE_DENSITY = 0.25  # of link text: more is no prose
MENU_TEXT = 25  # letters of a mean link in a menu


def _is_boilerplate(tag: str, attrs: str, inside_main: bool) -> bool:
    if tag in _DROP or (tag == "header" and not inside_main):
        return True
    return bool(attrs) and tag not in _KEPT and bool(_HIDDEN.search(attrs))


def _word_share(tag: str, attrs: str) -> tuple[float, bool]:
    """(share of the page's points up to which the element is cut for its class, id or role, whether it is discounted)."""
    if not attrs or tag in _KEPT:
        return 0.0, False
    share, discount = 0.0, False
    for token in (t for m in _ATTR.finditer(attrs) for t in (m[1] or m[2] or m[3] or "").split()):
        words = set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())) - {""}
        if words & _STATES:
            discount = discount or bool(words & (_STRONG | _WEAK))
        elif words & _STRONG or token.lower() in _WEAK:
            share = max(share, READERS_SHARE if words & _READERS else CUT_SHARE)
            discount = True
        elif words & _WEAK:
            discount = True
    return share, discount


class _Page:
    """Elements in page order (a child after its parent) and the text pieces that are not boilerplate."""

    def __init__(self, source: str):
        self.tag, self.parent, self.pieces, self.worded = ["#root"], [-1], [], {}
        self._open, self._dropped = [0], 0  # _dropped: depth of the outermost boilerplate element, or 0
        self._count: Counter[str] = Counter()  # open elements by tag
        at = 0
        while m := _TOKEN.search(source, at):
            self._text(source[at:m.start()])
            at = m.end()
            close, tag, attrs = m[1], m[2], m[3]
            if not tag:
                continue
            tag = tag.lower()
            if close:
                self._end(tag)
            else:
                self._start(tag, attrs)
                if tag in _RAW:
                    end = re.compile(rf"</{tag}\b", re.I).search(source, at)
                    at = end.start() if end else len(source)
        self._text(source[at:])

    def _text(self, text: str) -> None:
        if text and not self._dropped:
            self.pieces.append((self._open[-1], html.unescape(text)))

    def _start(self, tag: str, attrs: str) -> None:
        if tag not in _INLINE:
            self._close_until({"p"}, _SCOPE)
        if tag in _CLOSES:
            self._close_until(_CLOSES[tag], {"ul", "ol", "dl", "table", "select", "div"})
        if tag in _VOID:
            if tag == "br":
                self._text(" ")
            elif tag == "hr":
                self._add(tag)
            return
        self._add(tag)
        self._open.append(len(self.tag) - 1)
        self._count[tag] += 1
        word = _word_share(tag, attrs)
        if word != (0.0, False):
            self.worded[len(self.tag) - 1] = word
        if not self._dropped and _is_boilerplate(tag, attrs, any(self._count[m] for m in _MAIN)):
            self._dropped = len(self._open)

    def _add(self, tag: str) -> None:
        self.tag.append(tag)
        self.parent.append(self._open[-1])
        if tag not in _INLINE and not self._dropped:
            self.pieces.append((len(self.tag) - 1, ""))  # a block parts the text around it even if nothing in it is kept

    def _end(self, tag: str) -> None:
        if not self._count[tag]:
            return
        for k in range(len(self._open) - 1, 0, -1):
            if self.tag[self._open[k]] == tag:
                self._cut(k)
                return
            if tag in _INLINE and self.tag[self._open[k]] in _SCOPE:
                return

    def _close_until(self, tags: set[str], scope: set[str]) -> None:
        for k in range(len(self._open) - 1, 0, -1):
            if self.tag[self._open[k]] in tags:
                self._cut(k)
                return
            if self.tag[self._open[k]] in scope:
                return

    def _cut(self, k: int) -> None:
        for node in self._open[k:]:
            self._count[self.tag[node]] -= 1
        del self._open[k:]
        if self._dropped > k:
            self._dropped = 0


def _up(parent: list[int], node: int) -> Iterator[int]:
    while node >= 0:
        yield node
        node = parent[node]


def main_text(source: str | None) -> str:
    """Main text of a page; '' for NULL, an empty page, or one with nothing but boilerplate."""
    if not source:
        return ""
    page = _Page(source)
    n, tag, parent = len(page.tag), page.tag, page.parent
    block = list(range(n))  # nearest non-inline element at or above each element
    linked = [False] * n
    for k in range(1, n):
        block[k] = block[parent[k]] if tag[k] in _INLINE else k
        linked[k] = tag[k] == "a" or linked[parent[k]]
    length, links, anchors = [0] * n, [0] * n, [0] * n
    own_length, own_commas = [0] * n, [0] * n
    for node, text in page.pieces:
        own_length[block[node]] += len("".join(text.split()))
        own_commas[block[node]] += text.count(",") + text.count("，") + text.count("、")
    points = [1 + own_commas[k] + min(own_length[k] / 100, 3) if own_length[k] >= MIN_PARAGRAPH else 0.0 for k in range(n)]
    held = points[:]
    for k in range(n - 1, 0, -1):
        held[parent[k]] += held[k]
    cut = [False] * n
    for k in range(1, n):
        share = max(CUT_SHARE if tag[k] in _FORMS else 0.0, page.worded.get(k, (0.0, False))[0])
        cut[k] = cut[parent[k]] or bool(share) and held[k] <= share * held[0]
    pieces = [(node, "" if cut[node] else text) for node, text in page.pieces]
    for node, text in pieces:
        size = len("".join(text.split()))
        length[node] += size
        links[node] += size if linked[node] else 0
    for k in range(1, n):
        anchors[k] += tag[k] == "a"
    for k in range(n - 1, 0, -1):
        length[parent[k]] += length[k]
        links[parent[k]] += links[k]
        anchors[parent[k]] += anchors[k]

    heads = [0] * n  # letters in headings
    in_head = [False] * n
    for k in range(1, n):
        in_head[k] = tag[k] in _HEADINGS or in_head[parent[k]]
    for node, text in pieces:
        heads[node] += len("".join(text.split())) if in_head[node] else 0
    for k in range(n - 1, 0, -1):
        heads[parent[k]] += heads[k]

    score = [0.0] * n
    for k in range(n):
        if points[k] and not cut[k]:
            first = k if tag[k] in _SCOPE else parent[k]
            for level, up in enumerate(islice(_up(parent, max(first, 0)), LEVELS)):
                score[up] += points[k] * (1 if level == 0 else 0.5 if level == 1 else 1 / (3 * level))
    density = [links[k] / length[k] if length[k] else 0.0 for k in range(n)]
    discount = [WORD_DISCOUNT if page.worded.get(k, (0.0, False))[1] else 1.0 for k in range(n)]
    final = [score[k] * (1 - density[k]) * discount[k] for k in range(n)]
    best = max(range(n), key=lambda k: (final[k], -k))
    if not final[best]:
        best = next((k for k in range(n) if tag[k] in _MAIN and length[k]), 0)
    best = next((k for k in reversed([*_up(parent, best)]) if tag[k] in _MAIN), best)

    siblings = [k for k in range(1, n) if parent[k] == parent[best] and tag[k] not in _INLINE and not cut[k]] if best else []
    prose = {k for k in siblings if density[k] < PROSE_DENSITY and discount[k] == 1}
    named = tag[best] in _MAIN  # the page says what its article is, so lesser blocks beside it are none
    strong = {k for k in siblings if k == best or final[k] >= max(10, 0.2 * final[best]) and density[k] < 0.5
              or k in prose and (tag[k] in _MAIN or not named) and (length[k] >= 80 if tag[k] == "p" else held[k] > 0)}
    at = [i for i, k in enumerate(siblings) if k in strong]
    keep = {best} | strong
    if at:
        low, high = at[0], at[-1]
        # What stands between kept siblings, and short parts of prose that follow.
        keep |= {k for k in siblings[low:high] if k in prose}
        while not named and high + 1 < len(siblings) and siblings[high + 1] in prose and tag[siblings[high + 1]] in _FLOW:
            high += 1
            keep.add(siblings[high])
        # Headings before it, bare or in a container of their own.
        while low and heads[siblings[low - 1]] == length[siblings[low - 1]]:
            low -= 1
            keep.add(siblings[low])
    # Lists of short links are menus; within an article or main element links may be its references.
    in_main = [False] * n
    for k in range(1, n):
        in_main[k] = tag[k] in _MAIN or in_main[parent[k]]
    menus = {k for k in range(1, n) if tag[k] in ("ul", "ol", "div", "table", "dl") and anchors[k] >= 3 and density[k] > 0.8
             and not in_main[k] and links[k] < MENU_TEXT * anchors[k]}

    inside, last = [False] * n, None
    for k in range(n):
        inside[k] = k not in menus and not cut[k] and (k in keep or k > 0 and inside[parent[k]])
    blocks: list[list[str]] = []
    for node, text in pieces:
        if inside[node]:
            if last is None or block[node] != block[last]:
                blocks.append([])
            blocks[-1].append(text)
            last = node
    return " ".join(t for t in (" ".join("".join(b).split()) for b in blocks) if t)


@F.pandas_udf(T.StringType())
def extract(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(main_text, na_action=None)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points) of each whole ``html`` (same-named columns are replaced).

    One output row per input row. NULL and empty html give an empty text. The time grows in proportion to a page's length
    and does not depend on how deep its elements lie.
    """
    return pages.drop("text", "n_chars").withColumn("text", extract("html")).withColumn(
        "n_chars", F.char_length("text").cast("long"))


def op2_html_text(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_pages(pages).select("page_id", "url", "text", "n_chars")
