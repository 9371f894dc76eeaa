r"""Main text of web pages by line-block distribution.

Markup is stripped to one line per block. A line weighs as much as its text, and
nothing where it stands in navigation, a header, footer, sidebar, form, notice,
advert, script, style or reader comment, or outside the page's article where the
page marks one. Weights are summed over sliding windows of the lines that are not
noise; text surges where a window's sum rises above the threshold and dives where
the window is empty, and the lines that weigh something between the two are kept.

A word of a class or id makes an element noise, but not the element around the
article, nor one with most of the page's text (``pardoned``). Where a page marks
articles, a surge in a marked element keeps the element whole, and marked elements that
the text passes by without a surge (teasers) are left out. Null html is an empty page; a
page without text gives the empty string. Elements left open end with the element
around them. Whatever is left open, a page is read in linear time.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.words import documents
from staylens.session import configure

WINDOW, SURGE = 3, 60

# Fixed element and attribute names.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("aside button canvas dialog footer form head header iframe menu nav noscript object select svg template title".split())
MAIN = frozenset(("article", "main"))
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
NOISE = frozenset("ad ads advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer header masthead menu menus modal nav navbar navigation newsletter notice notices pagination popup promo promoted related respond share sharing sidebar sidebars signup skip social sponsor sponsored subscribe toolbar widget widgets".split())
READERS = frozenset("comment comments consent cookie cookies disqus respond".split())  # may well be longer than the article
QUALIFIERS = frozenset("has hide is no not show with without".split())  # "no-comments" tells about an element, not what it is
NOISE_ROLES = frozenset("banner navigation contentinfo complementary search form dialog alert menu menubar".split())

_OPENING = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
_RAW = re.compile(r"<(?:script|style|textarea|xmp)\b", re.I)  # elements whose content is no markup
_RAW_END = re.compile(r"</(?:script|style|textarea|xmp)\s*+>", re.I)
_ATTRIBUTE = re.compile(r"""(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_ZEROS, _LONG_NUMBER = re.compile(r"&#0+(?=[0-9])"), re.compile(r"&#[0-9]{8,};?")


class TagEnds:
    """Where tags end: the next ``>`` outside quotes, found in linear time for all tags of a page together."""

    def __init__(self, page: str):
        self.page = page
        self.marks = [m.start() for m in re.finditer("[>\"']", page)]
        self.known: dict[int, int] = {}  # end of a tag that meets this opening quote, -1 for none

    def after(self, at: int) -> int:
        """Place of the ``>`` that ends a tag read from ``at`` on, or -1."""
        met, found = [], -1
        while (i := bisect_left(self.marks, at)) < len(self.marks):
            mark = self.marks[i]
            if self.page[mark] == ">":
                found = mark
                break
            if mark in self.known:
                found = self.known[mark]
                break
            met.append(mark)
            at = self.page.find(self.page[mark], mark + 1) + 1
            if not at:
                break
        for mark in met:
            self.known[mark] = found
        return found


def tokens(page: str) -> Iterator[tuple[str, str | None, str, str | None]]:
    """Tags and texts in page order: (slash, tag, attributes, None) or ("", None, "", text); comments, declarations and raw elements are passed over.

    A ``<`` that opens no tag is text. A comment or raw element left open takes the rest of the page.
    """
    ends, size, last = TagEnds(page), len(page), page.rfind(">")
    at = 0
    while at < size:
        if page[at] != "<":
            to = page.find("<", at)
            to = size if to < 0 else to
            yield "", None, "", page[at:to]
            at = to
            continue
        if page.startswith("<!--", at):
            to = page.find("-->", at + 4)
            at = size if to < 0 else to + 3
            continue
        if page.startswith(("<!", "<?"), at) and at < last:
            at = page.find(">", at) + 1
            continue
        raw = _RAW.match(page, at)
        if raw and (to := ends.after(raw.end())) >= 0:
            close = _RAW_END.search(page, to + 1)
            at = close.end() if close else size
            continue
        tag = _OPENING.match(page, at)
        if tag and (to := ends.after(tag.end())) >= 0:
            yield tag[1], tag[2].lower(), page[tag.end() : to], None
            at = to + 1
            continue
        yield "", None, "", "<"
        at += 1


class Open:
    """Open elements, innermost last: tag, certain noise, innermost node. Elements are found by tag, not by a walk."""

    def __init__(self):
        self.stack: list[tuple[str, bool, int]] = []
        self.places: dict[str, list[int]] = {}  # of open elements by tag
        self.blocks: list[int] = []

    @property
    def top(self) -> tuple[str, bool, int]:
        return self.stack[-1] if self.stack else ("", False, -1)

    def push(self, tag: str, noise: bool, node: int) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, noise, node))

    def cut(self, at: int) -> bool:
        """Close the element at place ``at`` and all inside it; whether a block was among them."""
        block = bool(self.blocks) and self.blocks[-1] >= at
        while len(self.stack) > at:
            self.places[self.stack.pop()[0]].pop()
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()
        return block

    def end(self, tag: str) -> bool:
        """Close the innermost ``tag``; whether a block was closed."""
        return self.cut(self.places[tag][-1]) if self.places.get(tag) else False

    def imply(self, tag: str) -> None:
        """Close the innermost block where its end tag is implied by an opening ``tag``."""
        if self.blocks and self.stack[self.blocks[-1]][0] in CLOSES.get(tag, ()):
            self.cut(self.blocks[-1])


def decoded(text: str) -> str:
    """``text`` with character references decoded; numbers beyond all characters are the replacement character."""
    return entities.unescape(_LONG_NUMBER.sub("�", _ZEROS.sub("&#", text)))


CLEAR, COMPOUND, NAMED, READER, HARD = range(5)


def noise_kind(tag: str, attributes: str) -> int:
    """How sure it is that an element holds something other than the article: by part of a name, a whole name, or for certain."""
    if tag in DROPPED:
        return HARD
    if not attributes or tag in ("html", "body"):
        return CLEAR
    kind = CLEAR
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            for token in value.split():
                parts = [x for x in re.split(r"[^a-z]+", token) if x]
                if not NOISE.isdisjoint(parts) and parts[0] not in QUALIFIERS:
                    kind = max(kind, COMPOUND if len(parts) > 1 else READER if parts[0] in READERS else NAMED)
        if name == "role" and value in NOISE_ROLES:
            return HARD
    return HARD if name_hidden(attributes) else kind


def name_hidden(attributes: str) -> bool:
    return bool(re.search(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", attributes, re.I))


def lines(page: str) -> list[tuple[str, bool, int]]:
    """Every block of text in page order: text, whether it is noise, the outermost marked element it stands in or -1."""
    out: list[tuple[str, bool, int]] = []
    held: list[str] = []
    nodes: list[tuple[int, int, str]] = []  # elements that a class names or that mark an article: node around, kind, mark
    stack = Open()
    noise, inside = False, -1

    def flush() -> None:
        if held:
            text = " ".join(decoded("".join(held)).split())
            if text:
                out.append((text, noise, inside))
            held.clear()

    for closing, tag, attributes, text in tokens(page):
        if tag is None:
            held.append(text)
            continue
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            held.append(" ")
        if tag in VOID:
            continue
        if closing:
            if stack.end(tag):
                flush()
        else:
            stack.imply(tag)
            _, hard, node = stack.top
            kind = noise_kind(tag, attributes)
            if kind and not hard:
                flush()
            if not attributes.endswith("/") or tag in BLOCKS:
                mark = tag if tag in MAIN else ""
                if not hard and kind != HARD and (kind or mark):
                    nodes.append((node, kind, mark))
                    node = len(nodes) - 1
                stack.push(tag, hard or kind == HARD, node)
        _, hard, node = stack.top
        if (hard, node) != (noise, inside):
            flush()
        noise, inside = hard, node
    flush()
    return judged(out, nodes)


def judged(found: list[tuple[str, bool, int]], nodes: list[tuple[int, int, str]]) -> list[tuple[str, bool, int]]:
    """The lines with what their nodes make of them."""
    forgiven = pardoned(found, nodes)
    noise, inside = [False] * (len(nodes) + 1), [-1] * (len(nodes) + 1)  # the last one stands around the page
    for i, (around, kind, mark) in enumerate(nodes):
        noise[i] = noise[around] or (kind > CLEAR and not forgiven[i])
        inside[i] = i if inside[around] < 0 and mark and not noise[i] else inside[around]
    return [(text, hard or noise[node], inside[node]) for text, hard, node in found]


def pardoned(found: list[tuple[str, bool, int]], nodes: list[tuple[int, int, str]]) -> list[bool]:
    """Which nodes are no noise though a class or id names some: those around the article or most of the page's text.

    The article is the marked element with the most text, ``main`` before others. What
    stands in an ``article`` alone may be a teaser or a reader's comment: it has to
    outweigh the text that nothing names noise, an element around it whose whole name
    is noise has to hold most of the page, and among readers' comments it counts for nothing.
    """
    size = [0] * (len(nodes) + 1)
    covered, readers = [False] * (len(nodes) + 1), [False] * (len(nodes) + 1)
    for i, (around, kind, _) in enumerate(nodes):
        covered[i] = covered[around] or kind > CLEAR
        readers[i] = readers[around] or kind == READER
    clear = 0
    for text, hard, node in found:
        if not hard:
            size[node] += len(text)
            clear += 0 if covered[node] else len(text)
    for i in range(len(nodes) - 1, -1, -1):
        size[nodes[i][0]] += size[i]
    whole = size[-1]
    marks = [i for i, (_, kind, mark) in enumerate(nodes) if mark and size[i] and (mark == "main" or not (readers[i] or kind == NAMED))]
    article = max(marks, key=lambda i: (nodes[i][2] == "main", size[i], -i), default=-1)
    holds = [False] * (len(nodes) + 1)
    at = article
    while at >= 0:
        holds[at] = True
        at = nodes[at][0]
    out = []
    for i, (_, kind, _) in enumerate(nodes):
        most = 2 * size[i] > whole
        if holds[i]:
            out.append(nodes[article][2] == "main" or (size[article] >= clear and (kind == COMPOUND or most)))
        else:
            out.append(most and (kind == COMPOUND or (kind == NAMED and size[i] > SURGE >= clear)))
    return out


def between(weight: np.ndarray, surge: int, window: int = WINDOW) -> np.ndarray:
    """Flags of the lines from each surge of the window sums to the dive that follows."""
    n = len(weight)
    sums = np.convolve(weight, np.ones(window, np.int64))[window - 1 : window - 1 + n] if n else weight
    kept, running = np.zeros(n, bool), False
    for i in range(n):
        running = sums[i] > 0 and (running or sums[i] > surge)
        kept[i] = running and weight[i] > 0
    return kept


def main_text(page: str | None) -> str:
    """The article of one page, its blocks joined by an empty line."""
    found = lines(page or "")
    marked = any(inside >= 0 and not noise for _, noise, inside in found)
    weight = np.array([0 if noise or (marked and inside < 0) else len(text) for text, noise, inside in found], np.int64)
    # Noise lines are no gap in the text: the windows pass over them.
    kept = np.zeros(len(found), bool)
    text_lines = np.array([not noise for _, noise, _ in found], bool)
    kept[text_lines] = between(weight[text_lines], SURGE)
    if marked:
        surged = {inside for (_, _, inside), keep in zip(found, kept) if keep}
        kept = (weight > 0) & np.array([inside in surged for _, _, inside in found], bool)
    if not kept.any():
        kept = weight > 0
    return "\n\n".join(text for (text, _, _), keep in zip(found, kept) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html)."""

    def read(frames) -> Iterator[pd.DataFrame]:
        for frame in frames:
            text = [main_text(page) for page in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": text})

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInPandas(read, f"page_id {kind}, url string, text string").withColumn("n_chars", F.length("text").cast("long"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return extract(documents(spark, sf_dir, "pages"))
