"""Main text of web pages from flat text blocks.

A page is cut at its block tags into a flat row of text blocks; no tree of
elements is kept, only what the open elements say about where a block stands.
A block is described by its number of words, the share of them in links, the
same of the blocks before and after it, and by its place (a heading; in an
element named as a menu, an advert and so on; in the article).  A decision
tree over these numbers, learnt from a small labelled table of blocks
(``html_labels``), tells main text from the rest.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_labels import MARK, labelled_pages
from .scratch import in_arrow
from .words import pieces

# Element names of the markup language, and names that sites give to parts of their pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
DROPPED = frozenset("audio button canvas datalist math noscript object option select svg template video".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul""".split())
LEAVES = frozenset("h1 h2 h3 h4 h5 h6 p".split())
SIBLINGS = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tr": ("tr td th", "table")}
SIBLINGS = {tag: (frozenset(ends.split()), frozenset(up_to.split())) for tag, (ends, up_to) in SIBLINGS.items()}
NOISE_TAGS = frozenset("aside dialog footer menu nav search".split())
NOISE_NAMES = frozenset("""ad ads advert adverts advertisement advertising advertorial adsense banner billboard breadcrumb breadcrumbs consent cookie cookies copyright disclaimer footer gdpr login
    masthead menu menubar modal nav navbar navigation newsletter notice notification notifications overlay pager pagination popup promo promotion recommendations recommended related search share sharing
    sidebar signup skyscraper social sponsor sponsored subscribe subscription teaser toolbar topbar trending widget""".split())
TALK_NAMES = frozenset("comment comments commentlist disqus replies reply respond discussion".split())
HEADER_NAMES = frozenset(["header", "page-header", "site-header", "top-header"])
TEXT_NAMES = frozenset("articlebody article-body article-content article-text entry-content post-body post-content story-body".split())
NOT_NAMES = frozenset("has no non with without".split())

#: Where a block stands: anywhere, in a form, in an element with a name of noise, in one of those for good.
PLAIN, FORM, NOISE, BANNED = range(4)

_TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|itemprop|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?=[\s/]|\Z))", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I) for name in RAW}
_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(slots=True)
class Block:
    """One text block: its text, its words, those of them in links, and where it stands."""

    text: str
    words: int
    linked: int
    place: int
    article: bool
    main: bool
    heading: bool


def _named(value: str) -> tuple[bool, bool]:
    """Does an attribute value hold a name of noise, and one of readers' comments?"""
    noise = talk = False
    for name in value.split():
        parts = [p.lower() for p in _PART.findall(name)]
        if any(p in NOT_NAMES for p in parts):
            continue
        noise |= any(p in NOISE_NAMES for p in parts)
        talk |= any(p in TALK_NAMES for p in parts)
    return noise, talk


def _place(tag: str, attributes: str, place: int, article: bool, main: bool) -> tuple[int, bool, bool]:
    """Where the inside of an element stands that is opened at a place."""
    found: dict[str, str] = {}
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    if place == BANNED:
        return place, article, main
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(found.get("style", "")):
        return BANNED, article, main
    names = " ".join(found.get(a, "") for a in ("class", "id", "role")) if found else ""
    lower = names.lower().split()
    noise, talk = _named(names) if names and tag not in ("html", "body") else (False, False)
    if talk or tag in NOISE_TAGS or (noise and tag in ("article", "main")):
        return BANNED, article, main
    if tag == "article" or found.get("itemprop", "").lower() == "articlebody" or any(n in TEXT_NAMES for n in lower):
        return PLAIN, True, main
    if tag == "main" or "main" in lower and "role" in found:
        return PLAIN, article, True
    if noise or not (article or main) and (tag == "header" or any(n in HEADER_NAMES for n in lower)) or tag == "form" and (article or main):
        return NOISE, article, main
    return (max(place, FORM) if tag == "form" else place), article, main


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, none of them empty; character references are decoded, white
    space is one space.  Scripts, styles, titles, comments of the markup, buttons and the like are
    no text.  Takes any text: tags that are not closed end with the element around them, one cut
    off at the end of the page is no text."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool, bool]] = []
    count: dict[str, int] = {}
    parts: list[str] = []
    linked: list[str] = []
    in_link = dropped = 0
    here = (PLAIN, False, False)

    def flush() -> None:
        if parts:
            words = "".join(parts).split()
            if words:
                out.append(Block(" ".join(words), len(words), min(len(words), len("".join(linked).split())), *here, any(s[0] in LEAVES and s[0] != "p" for s in stack[-1:])))
            parts.clear()
            linked.clear()

    def close(upto: int) -> None:
        nonlocal here
        for s in stack[upto:]:
            count[s[0]] -= 1
        del stack[upto:]
        here = stack[-1][1:] if stack else (PLAIN, False, False)

    at, end = 0, len(page)
    while at < end:
        tag = _TAG.search(page, at)
        upto = tag.start() if tag else end
        if upto > at and not dropped:
            text = page[at:upto]
            text = references.unescape(text) if "&" in text else text
            parts.append(text)
            if in_link:
                linked.append(text)
        if not tag:
            break
        at, name = tag.end(), tag[2]
        if name is None:
            continue
        name, closing = name.lower(), tag[1] == "/"
        if name in DROPPED:
            dropped = max(0, dropped - 1) if closing else dropped + (not tag[3].endswith("/"))
        elif dropped:
            # what is left open inside of a dropped element ends with the page's next part
            if name in ("article", "main", "body") or closing and name in ("body", "form"):
                dropped = 0
        if name in RAW:
            if not closing:
                over = _RAW_END[name].search(page, at)
                at = over.end() if over else end
        elif name == "a":
            in_link = 0 if closing else 1
            if in_link and linked:
                linked.append(" ")
        elif name == "br" and parts:
            parts.append(" ")
            if in_link:
                linked.append(" ")
        elif name in BLOCKS:
            flush()
            if closing:
                if count.get(name):
                    close(max(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name) if stack[-1][0] != name else len(stack) - 1)
                in_link = 0
            elif name not in VOID:
                if stack and stack[-1][0] in LEAVES:
                    close(len(stack) - 1)
                if name in SIBLINGS:
                    ends, bounds = SIBLINGS[name]
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] in bounds:
                            break
                        if stack[i][0] in ends:
                            close(i)
                            if name != "tr":
                                break
                here = _place(name, tag[3], *here)
                stack.append((name, *here))
                count[name] = count.get(name, 0) + 1
    flush()
    return out


def features(found: list[Block]) -> list[tuple[float, ...]]:
    """Numbers of every block: its words and link density, those of the blocks before and after it,
    heading, place, and whether it is in the article (2), or in a page without one (1)."""
    article, main = any(b.article for b in found), any(b.main for b in found)
    size = [(0, 0.0), *((b.words, b.linked / b.words) for b in found), (0, 0.0)]
    out = []
    for i, b in enumerate(found):
        inside = 2 if (b.article if article else b.main) else 0 if article or main else 1
        out.append((*size[i + 1], *size[i], *size[i + 2], float(b.heading), float(min(b.place, NOISE)), float(inside)))
    return out


def grow(x: np.ndarray, y: np.ndarray, depth: int = 10, least: int = 5):
    """A decision tree by Gini impurity: (feature, threshold, tree at or below, tree above), a leaf is the share of ones."""
    share = float(y.mean()) if len(y) else 0.0
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return share
    best = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(y))
        cut = (v[1:] != v[:-1]) & (n >= least) & (len(y) - n >= least)
        if cut.any():
            left, right = ones[:-1], ones[-1] - ones[:-1]
            impure = left * (n - left) / n + right * (len(y) - n - right) / (len(y) - n)
            i = int(np.flatnonzero(cut)[impure[cut].argmin()])
            if best is None or impure[i] < best[0] - 1e-9:
                best = (impure[i], f, float((v[i] + v[i + 1]) / 2))
    if best is None:
        return share
    _, f, threshold = best
    low = x[:, f] <= threshold
    return f, threshold, grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


def learn(pages: Iterable[str]):
    """The tree of a labelled table: pages in which the words of main text begin with ``MARK``."""
    x, y = [], []
    for page in pages:
        found = blocks(page)
        x += features(found)
        y += [b.text.startswith(MARK) for b in found]
    return grow(np.array(x, np.float64).reshape(len(y), -1), np.array(y, np.int64))


def is_text(tree, numbers: tuple[float, ...]) -> bool:
    while isinstance(tree, tuple):
        tree = tree[2] if numbers[tree[0]] <= tree[1] else tree[3]
    return tree >= 0.5


def extract(tree, page: str | None) -> str:
    """Main text of a page: its blocks of main text, one a line."""
    found = blocks(page or "")
    return "\n".join(b.text for b, numbers in zip(found, features(found)) if is_text(tree, numbers))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", labelled: Iterable[str] | None = None) -> DataFrame:
    """(id, url, text, n_chars) of every row of ``pages``: its main text and the code points of it.

    The tree is learnt on the driver from ``labelled``, pages in which the words of main text
    begin with ``html_labels.MARK`` (by default those of ``html_labels``); it is a few hundred
    numbers.  Null and empty pages, and pages without main text, give an empty text.  Whole pages
    are read, however long; repeated ids and rows, and null ids and URLs, are rows like any
    other; other columns are not read.  An empty table gives an empty result."""
    tree = learn(labelled_pages() if labelled is None else labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "html"):
                texts = [extract(tree, page) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    out = in_arrow(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, url string, text string, n_chars long")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
