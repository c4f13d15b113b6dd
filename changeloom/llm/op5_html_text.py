"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into flat blocks at its block-level tags. Each block has its word count and link density, those of its
neighbours and of the element it lies in, whether it is worded like a notice, and what its ancestors say: inside an article,
inside an element or behind a name that marks boilerplate. A decision tree tells content from boilerplate; the content
blocks are the text. It is trained on a small labelled table: the blocks of the page layouts below, with and without an
article, at several lengths. A name marks only as a whole (``related``, ``ad-box``; not ``related-work``), and it is a feature
like others: a page whose only prose is behind a mark keeps it. Scripts, styles and markup never reach a block. One pass
inside the tasks, no shuffle.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .registry import query, table

# Elements of HTML.
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "object", "svg", "canvas", "select", "noframes", "math", "audio", "video"}
CONTAINERS = {"article", "main", "nav", "header", "footer", "aside", "form", "section", "div", "ul", "ol", "dl", "table", "dialog", "fieldset", "figure",
              "details", "blockquote", "menu", "body", "head", "button"}
BLOCKS = CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "caption", "pre", "hr", "html", "address", "figcaption",
                       "summary", "legend", "option", "center", "hgroup", "search", "label"}
MAIN = {"article", "main"}
APART = {"nav", "footer", "aside", "form", "dialog", "fieldset", "menu", "button", "head"}
# Names in class, id and role that mark boilerplate, words that only say how such an element is laid out, and names of the main text.
MARKS = {"ad", "ads", "advert", "advertisement", "adverts", "banner", "sponsor", "sponsored", "promo", "promotion", "sidebar", "menu", "nav", "navbar",
         "navigation", "breadcrumb", "breadcrumbs", "foot", "footer", "header", "masthead", "cookie", "cookies", "consent", "notice", "gdpr", "popup",
         "modal", "newsletter", "subscribe", "signup", "login", "share", "sharing", "social", "related", "recommended", "comment", "comments", "disqus",
         "replies", "widget", "pagination", "pager", "copyright", "legal", "search", "toolbar", "skip", "complementary", "contentinfo", "alert",
         "overlay", "paywall", "tags"}
LAYOUT = {"area", "bar", "block", "body", "bottom", "box", "buttons", "col", "column", "container", "content", "element", "form", "frame", "group", "inner",
          "item", "items", "left", "link", "links", "list", "main", "outer", "page", "panel", "right", "row", "section", "site", "slot", "text", "thread", "top",
          "unit", "wrap", "wrapper"}
MAIN_MARKS = {"articlebody", "article-body", "article-content", "post-content", "entry-content", "main-content", "post-body", "story-body"}
# Wordings of notices.
NOTICES = ["all rights reserved", "\N{COPYRIGHT SIGN}", "copyright", "privacy policy", "terms of use", "use cookies", "sign up", "log in"]

# Features that the text gives come first: of equally good questions the tree asks the first.
FEATURES = ["words", "links", "words_before", "links_before", "words_behind", "links_behind", "words_around", "links_around", "notice", "heading",
            "other_prose", "page_has_main", "in_main", "apart", "marked"]
# Small labelled table, written by hand: page layouts whose blocks are content (+n) or boilerplate (-n) of n words.
LAYOUTS = [
    # An article between everything that a page has besides.
    "<nav><ul><li><a>-1</a><li><a>-2</a><li><a>-1</a></ul></nav><div class=ad>-9</div><article><h1>+8</h1><p>+60</p><p>+3</p><p>+70 <a>+4</a> +20</p>"
    "<p><a>+5</a></p><blockquote><p>+15</p></blockquote><ul><li>+5</li><li><a>+7</a></li></ul><p>+1</p></article><footer>-12 all rights reserved</footer>",
    "<header><h1>-3</h1><p>-9</p></header><div class=cookie-notice>-30</div><main><h1>+6</h1><p>+40</p><p>+2</p><h2>+3</h2><p>+9 copyright</p></main>"
    "<aside><p>-50</p><a>-5</a></aside><form><label>-3</label><p>-20</p></form><div class=sidebar><h2>-2</h2><p>-60</p></div>",
    # Boilerplate inside the article.
    "<p>-40</p><article><h1>+7</h1><p>+50</p><div class=ad>-20</div><p>+30</p><div class=share><a>-1</a></div><section class=comments><h2>-2</h2><p>-40</p>"
    "<p>-6</p></section></article><h2>-3</h2><div><p>-45</p></div><footer>-4</footer>",
    "<article><header><h1>+6</h1><p>+5</p></header><p>+70</p><aside><h2>-3</h2><p>-25</p></aside><p>+4</p><nav><a>-3</a></nav><form>-6</form><footer><p>-8</p></footer></article>",
    "<article><h1>+4</h1></article><footer>-30</footer>", "<footer>-30</footer><article>+2</article>", "<h1>-6</h1><article><p>+9</p><p>+2</p></article><p>-80</p>",
    "<nav><a>-1</a></nav><div class=ad>-6</div><article><h1>+8</h1><p>+9</p></article><footer>-9</footer>", "<article><p>+300</p></article>",
    "<nav><a>-1</a></nav><article><p>+20 all rights reserved</p><p>+3 privacy policy</p></article><div>-5</div>", "<article><p>+6 copyright</p></article><footer>-9</footer>",
    "<div class=ad>-8</div><article><h1>+9</h1><p>+30 all rights reserved</p></article>", "<article><p><a>+3</a></p><p><a>+12</a></p></article><aside>-7</aside>",
    "<article><p>+2</p><ul><li><a>+2</a><li><a>+1</a></ul><p>+4 log in</p><div class=promo><p>-70</p></div><h2>+3</h2></article><div>-40</div>",
    # Pages without an article.
    "<div><a>-2</a> <a>-1</a> <a>-3</a></div><div><h1>+8</h1><p>+40</p><p>+3</p><p>+25</p><p>+60</p></div><div>-9 all rights reserved</div>",
    "<div><h1>+5</h1><p>+30</p><p>+4</p></div><div class=foot>-20</div>", "<div>-2</div><div><h1>+5</h1><p>+60</p><p>+2</p><p>+6</p></div><div>-12 privacy policy</div>",
    "<ul><li><a>-1</a><li><a>-2</a><li><a>-1</a></ul><h1>+7</h1><p>+50</p><p>+4</p><p>+80</p><div class=ad>-30</div><p>+30</p><p>-6 copyright</p>"
    "<ul><li><a>-2</a><li><a>-3</a></ul>",
    "<div><h1>+6</h1><p>+40</p><p>+3</p></div><div>-8 all rights reserved</div>", "<h1>+6</h1><p>+50</p><p>+8</p><p>-9 all rights reserved</p>",
    "<div><h1>+6</h1><p>+60</p><p>+30</p></div>", "<p>+50</p><p>+40</p>", "<div><a>-2</a></div><p>+50</p>", "<h1>+9</h1><p>+70</p>",
    "<h1>+6</h1><p>+50</p><p>+40</p><ul><li><a>-2</a><li><a>-4</a></ul>", "<ul><li><a>-2</a><li><a>-1</a></ul><p>+40</p><p><a>-3</a></p><div>-2</div>",
    "<div><p>+40</p><p>+40</p></div><div class=ad>-40</div>", "<table><tr><td><a>-2</a><td><a>-2</a></td></tr><tr><td>+70</td></tr><tr><td>+90</td></tr><tr><td>-7 privacy policy</td></tr></table>",
    "<div><a>-1</a> <a>-1</a></div><div><div><h2>+6</h2></div><div><p>+45</p></div><div><p>+50</p></div></div><div>-3</div><div><a>-9</a></div>"
    "<div class=comments><h2>-2</h2><p>-40</p><p>-5</p></div>",
    # The whole story behind a name that marks elsewhere.
    "<nav><a>-2</a></nav><div class=legal><h1>+8</h1><p>+80</p><p>+6</p><p>+120</p></div><footer>-4</footer>",
    "<div class=content><div class=promo><h1>+6</h1><p>+60</p><p>+90</p><p>+5</p></div></div><footer>-10</footer>",
    "<div class=legal><h1>+2</h1><p>+40</p><p>+2</p></div><div class=foot>-9 all rights reserved</div>",
    # Nothing but boilerplate.
    "<nav><a>-1</a><a>-2</a></nav><div>-3</div><footer>-10</footer>", "<div><a>-2</a></div><div>-2</div><form><p>-5</p></form><div class=ad>-4</div><div>-6 use cookies</div>",
]
LENGTHS = [0.1, 0.3, 0.6, 1, 2, 5]


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of LAYOUTS, each at all LENGTHS."""
    rows, labels = [], []
    for layout in LAYOUTS:
        for length in LENGTHS:
            page = re.sub(r"([+-])(\d+)", lambda m: " ".join([m[1] + "word"] * max(1, round(int(m[2]) * length))), layout)
            blocks = Page(page).blocks
            rows += features(blocks)
            labels += [b.text.startswith("+") for b in blocks]
    return np.array(rows, float), np.array(labels, int)


class Tree:
    """Binary decision tree by Gini impurity; grown until leaves are pure or ``depth`` is reached."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 12):
        self.root = self._grow(x, y, depth)

    def _grow(self, x, y, depth):
        share = y.mean()
        if depth == 0 or share in (0.0, 1.0):
            return bool(share >= 0.5)
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] < cut
                score = sum(part.sum() * y[part].mean() * (1 - y[part].mean()) for part in (left, ~left))
                if best is None or score < best[0] - 1e-12:
                    best = (score, f, cut, left)
        if best is None:
            return bool(share >= 0.5)
        _, f, cut, left = best
        return f, cut, self._grow(x[left], y[left], depth - 1), self._grow(x[~left], y[~left], depth - 1)

    def __call__(self, row) -> bool:
        node = self.root
        while not isinstance(node, bool):
            f, cut, low, high = node
            node = low if row[f] < cut else high
        return node


class Block:
    __slots__ = ("text", "words", "link_words", "element", "in_main", "apart", "marked", "heading", "notice")

    def __init__(self, text, link_words, element, in_main, apart, marked, heading):
        self.text, self.words, self.link_words, self.element = text, text.count(" ") + 1, link_words, element
        self.in_main, self.apart, self.marked, self.heading = in_main, apart, marked, heading
        # A notice is short; in a long paragraph the wording is about something else.
        low = text.lower() if self.words < 80 else ""
        self.notice = any(n in low for n in NOTICES)

    @property
    def links(self) -> float:
        return 100.0 * self.link_words / self.words


_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


def _is_mark(name: str) -> bool:
    """A mark, or a compound of marks and words of layout."""
    parts = [p for p in _SPLIT.split(name) if p and not p.isdigit()]
    return any(p in MARKS for p in parts) and all(p in MARKS or p in LAYOUT for p in parts)


def _marks(attributes: str) -> tuple[bool, bool]:
    """(marks boilerplate, marks the main text)."""
    bad = main = False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            bad = True
        else:
            good = any(v in MAIN_MARKS for v in value.split())
            main |= good
            bad |= not good and any(map(_is_mark, value.split()))
    return bad, main


_OUTSIDE = ("", 0, False, False, False)


class Page:
    """Cuts one page into blocks, in one pass over its tags."""

    def __init__(self, html: str):
        self.html, self.blocks, self.parts, self.link_parts = html, [], [], []
        self.stack: list[tuple[str, int, bool, bool, bool]] = []     # element, its number, in_main, apart, marked
        self.elements = 0
        self.open_at: dict[str, list[int]] = {}
        self.in_link, self.heading = False, False
        self.no_more: set[str] = set()      # characters not found again
        self._read()

    def _find(self, what: str, start: int) -> int:
        if what in self.no_more:
            return -1
        at = self.html.find(what, start)
        if at < 0:
            self.no_more.add(what)
        return at

    def _tag_end(self, at: int) -> int:
        """Position of the > that ends the tag; quoted values may contain one. -1: the page ends inside the tag."""
        end = self._find(">", at)
        quote = at
        while end >= 0:
            # The next quote that follows an equals sign before the end.
            quotes = [q for q in (self.html.find('"', quote, end), self.html.find("'", quote, end)) if q >= 0]
            if not quotes:
                return end
            first = min(quotes)
            if not self.html[max(at, first - 8):first].rstrip().endswith("="):
                quote = first + 1
                continue
            close = self._find(self.html[first], first + 1)
            if close < 0:
                return end
            quote = close + 1
            if close > end:
                end = self._find(">", close)
        return end

    def _read(self) -> None:
        html, at, size = self.html, 0, len(self.html)
        while at < size:
            lt = html.find("<", at)
            if lt < 0:
                self._text(html[at:])
                break
            if lt > at:
                self._text(html[at:lt])
            after = html[lt + 1:lt + 2]
            if html.startswith("<!--", lt):
                end = self._find("-->", lt + 4)
                at = size if end < 0 else end + 3
            elif after in ("!", "?"):
                end = self._find(">", lt)
                at = size if end < 0 else end + 1
            elif after.isascii() and after.isalpha() or (after == "/" and html[lt + 2:lt + 3].isascii() and html[lt + 2:lt + 3].isalpha()):
                end = self._tag_end(lt + 1)
                if end < 0:
                    break
                at = end + 1
                name = _NAME.match(html, lt + 1 + (after == "/"))
                tag = name[0].lower()
                if after == "/":
                    self._close(tag)
                elif tag in RAW:
                    at = self._skip(tag, at, html[name.end():end])
                else:
                    self._open(tag, html[name.end():end])
            else:
                self._text("<")
                at = lt + 1
        self._flush()

    def _skip(self, tag: str, at: int, attributes: str) -> int:
        """Behind the end tag of an element whose content is no text of the page."""
        if attributes.endswith("/") and tag in ("svg", "math", "canvas", "object", "iframe", "audio", "video"):
            return at
        key = f"</{tag}"
        if key in self.no_more:
            return len(self.html)
        m = re.compile(key + r"(?=[\s/>])", re.I).search(self.html, at)
        if m is None:
            self.no_more.add(key)
            return len(self.html)
        end = self._find(">", m.end())
        return len(self.html) if end < 0 else end + 1

    def _open(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self.in_link = True
        if tag not in BLOCKS:
            if tag in ("br", "img", "input", "wbr") and tag == "br":
                self._text(" ")
            return
        self._flush()
        self.heading = len(tag) == 2 and tag[0] == "h" and tag[1] in "123456"
        if tag in CONTAINERS and not attributes.endswith("/"):
            _, _, main, apart, marked = self.stack[-1] if self.stack else _OUTSIDE
            bad, good = _marks(attributes) if attributes else (False, False)
            apart = apart or tag in APART or (tag == "header" and not main)
            marked = marked or (bad and tag not in ("body", "article", "main"))
            self.open_at.setdefault(tag, []).append(len(self.stack))
            self.elements += 1
            self.stack.append((tag, self.elements, main or tag in MAIN or good, apart, marked))
        elif tag == "li" or tag == "p":
            self.in_link = False

    def _close(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        if tag not in BLOCKS:
            return
        self._flush()
        self.heading = False
        if self.open_at.get(tag):
            depth = self.open_at[tag][-1]
            for name, *_ in self.stack[depth:]:
                self.open_at[name].pop()
            del self.stack[depth:]

    def _text(self, raw: str) -> None:
        self.parts.append(raw)
        if self.in_link:
            self.link_parts.append(raw)

    def _flush(self) -> None:
        if self.parts:
            text = " ".join(references.unescape("".join(self.parts)).split())
            if text:
                _, element, main, apart, marked = self.stack[-1] if self.stack else _OUTSIDE
                link_words = len(references.unescape(" ".join(self.link_parts)).split()) if self.link_parts else 0
                self.blocks.append(Block(text, min(link_words, text.count(" ") + 1), element, main, apart, marked, self.heading))
            self.parts, self.link_parts = [], []


def features(blocks: list[Block]) -> list[tuple]:
    around: dict[int, list[int]] = {}
    prose = 0
    for b in blocks:
        total = around.setdefault(b.element, [0, 0])
        total[0] += b.words
        total[1] += b.link_words
        prose += b.words if not (b.apart or b.marked or b.notice) and b.links < 50 else 0
    has_main = any(b.in_main for b in blocks)
    out = []
    for i, b in enumerate(blocks):
        before, behind = blocks[i - 1] if i else None, blocks[i + 1] if i + 1 < len(blocks) else None
        words, links = around[b.element]
        out.append((b.words, b.links, before.words if before else 0, before.links if before else 0.0, behind.words if behind else 0,
                    behind.links if behind else 0.0, words, 100.0 * links / words, b.notice, b.heading, prose, has_main, b.in_main, b.apart, b.marked))
    return out


def main_text(html: str | None, tree: Tree) -> str:
    blocks = Page(html or "").blocks
    return " ".join(b.text for b, row in zip(blocks, features(blocks)) if tree(row))


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


class _Extract:
    def __init__(self, tree: Tree):
        self.tree = tree

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, 2):
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([main_text(h, self.tree) for h in part.column(2).to_pylist()], pa.string())],
                                             schema=_OUT)


def extract_text(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each page row.

    Null and empty pages, and pages without content, give an empty text. Pages cut off anywhere give what came before.
    Repeated rows give a row each, ids and urls may be null, no pages give no rows, and other columns are not read.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    found = rows.mapInArrow(_Extract(tree or Tree(*labelled())), "page_id bigint, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@query("op5_html_text")
def op5(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))
