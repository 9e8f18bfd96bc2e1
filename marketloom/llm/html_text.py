"""Main text of web pages: flat text blocks, classified with their neighbours by a decision tree.

A page is read from tag to tag into flat blocks: the text between two tags that begin or end a block.  Each block has its
words and the share of them in links, the same of the block before and after it, whether it is a heading, and, as a hint,
the kind of the nearest element around it that tells one: article, or surroundings (navigation, page header, footer,
sidebar, form, or a class, id or role that names such a part, an advert, a notice or reader comments).  A decision tree
(CART, Gini impurity), trained on the labelled table in ``labelled_blocks``, keeps or drops each block; kept blocks are
joined in page order.  The tree is also trained on every page with all hints withheld, so it decides by words and links where
a page gives none.

Pages are independent, so one pass over the table does it, without a shuffle.

Rules: a null html is empty; comments, scripts, styles, the head, what is hidden, and elements that hold no running text
(templates, drawings, objects, selections) are no text; such an element without a closing tag of its own ends at its tag.
Character references are decoded; white space, a line break included, becomes one space; an unclosed comment, script or
style reaches to the end; ``<x/>`` is empty; attributes count by their whole names; a closing tag closes what was opened
inside it, a stray one is ignored; other columns are ignored.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.labelled_blocks import PAGES

DEPTH, LEAST = 7, 6  # of the decision tree, and of rows in a leaf
WITH_HINTS = 4  # times that a page is trained on with its hints, and once without

_ATTRIBUTES = r"(?:[^>\"'=/]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+|[\"']|/(?!>))*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style)\b{_ATTRIBUTES}(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    rf"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9-]*)(?P<attributes>{_ATTRIBUTES})(?P<empty>/?)>"
    r"|<[!?/][^>]*>",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)))?")
_INVISIBLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th "
    "thead tr ul button".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end where another one of these begins.
ENDED_BY = {
    "p": BLOCKS, "li": frozenset(["li"]), "dd": frozenset(["dd", "dt"]), "dt": frozenset(["dd", "dt"]), "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]), "tr": frozenset(["tr"]), "option": frozenset(["option", "optgroup"]),
}
NO_TEXT = frozenset("head title template noscript svg math textarea select option iframe object canvas audio video datalist".split())
OUTSIDE = frozenset("nav header footer aside form menu dialog button fieldset".split())
INSIDE = frozenset("article main".split())
#: Names of surroundings, also as a part of a longer name.
OUTSIDE_PARTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr popup modal overlay "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments disqus newsletter subscribe "
    "subscription signup login widget toolbar pagination pager outbrain taboola".split()
)
#: Words that name surroundings only where they stand alone.
OUTSIDE_NAMES = frozenset(
    "notice notices alert aside reply replies respond share sharing social related recommended search form copyright legal disclaimer skip "
    "contentinfo complementary dialog teaser".split()
)
INSIDE_WORDS = frozenset("article main content post entry story text body".split())


@dataclass
class Block:
    text: str
    words: int
    linked: int
    kind: int
    heading: bool


def _kind(tag: str, attributes: str, inside: bool) -> tuple[int, bool]:
    """1 for an article's container, -1 for one of its surroundings, 0 for neither; and whether it is hidden."""
    parts: set[str] = set()
    names: set[str] = set()
    hidden = False
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id", "role"):
            names.update(value.split())
            parts.update(_PART.findall(value))
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _INVISIBLE.search(html.unescape(value)):
            hidden = True
    outside = parts & OUTSIDE_PARTS
    if names & OUTSIDE_NAMES or outside and not (outside <= {"header", "footer"} and parts & INSIDE_WORDS):
        return -1, hidden
    if tag in INSIDE:
        return 1, hidden
    if tag in OUTSIDE:
        return (0 if tag == "header" and inside else -1), hidden
    return (1 if parts & INSIDE_WORDS and tag in BLOCKS else 0), hidden


def _closed(tokens: list[re.Match]) -> set[int]:
    """The opening tags (by their place) that have a closing tag of their own."""
    found, opened, number = set(), [], Counter()
    for k, token in enumerate(tokens):
        tag = token["tag"]
        if not tag or token["empty"] or tag.lower() in VOID:
            continue
        tag = tag.lower()
        if not token["close"]:
            opened.append((tag, k))
            number[tag] += 1
        elif number[tag]:
            while opened[-1][0] != tag:
                number[opened.pop()[0]] -= 1
            found.add(opened.pop()[1])
            number[tag] -= 1
    return found


def blocks(page: str) -> list[Block]:
    out: list[Block] = []
    opened: list[tuple[str, int, int]] = []  # tag, and the kind and the depth of what is no text around it
    number: Counter = Counter()
    parts: list[str] = []
    kind = linked = silent = 0
    link = heading = False
    at = 0

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            words = text.count(" ") + 1
            out.append(Block(text, words, min(words, linked), kind, heading))
        parts.clear()
        linked = 0

    def leave():
        nonlocal kind, silent
        tag, kind, silent = opened.pop()
        number[tag] -= 1

    tokens = list(_TOKEN.finditer(page))
    closed = _closed(tokens)
    for k, token in enumerate(tokens):
        text = page[at : token.start()]
        at = token.end()
        if text and not silent:
            parts.append(text)
            if link:
                linked += len(text.split())
        tag = token["tag"]
        if not tag:
            if token["raw"] and not silent:
                parts.append(" ")
            continue
        tag = tag.lower()
        block = tag in BLOCKS
        if token["close"]:
            if tag == "a":
                link = False
            if number[tag] or block:
                flush()
                heading = False if block else heading
            if number[tag]:
                while opened[-1][0] != tag:
                    leave()
                leave()
            continue
        if tag == "a":
            link = True
        elif tag == "br" and not silent:
            parts.append(" ")
        if block:
            flush()
            heading = tag[0] == "h" and tag[1:].isdigit()
            link = False
            while opened and tag in ENDED_BY.get(opened[-1][0], ()):
                leave()
        if tag in VOID or token["empty"]:
            continue
        own, hidden = _kind(tag, token["attributes"], kind > 0)
        no_text = (tag in NO_TEXT or hidden) and k in closed
        if block or no_text or own:
            if not block:
                flush()
            opened.append((tag, kind, silent))
            number[tag] += 1
            kind, silent = own or kind, silent + no_text
    if at < len(page) and not silent:
        parts.append(page[at:])
    flush()
    return out


FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "kind", "heading")


def features(found: list[Block]) -> np.ndarray:
    words = np.array([0, *(b.words for b in found), 0], float)
    links = np.array([0, *(b.linked / b.words for b in found), 0], float)
    kind = np.array([b.kind for b in found], float)
    heading = np.array([b.heading for b in found], float)
    return np.stack([words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:], kind, heading], axis=1)


def without_hints(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    x[:, FEATURES.index("kind")] = 0
    return x


@dataclass
class Node:
    """Rows whose feature is at most ``cut`` go left; a leaf has only ``share``, the part of kept rows."""

    share: float
    feature: int = -1
    cut: float = 0.0
    left: Node | None = None
    right: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = DEPTH) -> Node:
    """The tree that splits each node where the summed Gini impurity falls most; ties go to the first feature.  Leaves hold
    ``LEAST`` rows at least, so that no single page makes a rule of its own."""
    node = Node(float(y.mean()))
    if depth == 0 or node.share in (0.0, 1.0):
        return node
    best = len(y) * node.share * (1 - node.share) - 1e-9
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for cut in (values[:-1] + values[1:]) / 2:
            low = x[:, k] <= cut
            if min(low.sum(), (~low).sum()) < LEAST:
                continue
            impurity = sum(len(part) * part.mean() * (1 - part.mean()) for part in (y[low], y[~low]))
            if impurity < best:
                best, node.feature, node.cut = impurity, k, float(cut)
    if node.feature >= 0:
        low = x[:, node.feature] <= node.cut
        node.left, node.right = grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)
    return node


def predict(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(x), node.share >= 0.5)
    low = x[:, node.feature] <= node.cut
    out = np.empty(len(x), bool)
    out[low], out[~low] = predict(node.left, x[low]), predict(node.right, x[~low])
    return out


@functools.cache
def trained() -> Node:
    """The tree of the labelled table."""
    x, y = [], []
    for page in PAGES:
        marks = [mark == "+" for mark, piece in page for _ in blocks(piece)]
        found = blocks("".join(piece for _, piece in page))
        if len(found) != len(marks):
            raise ValueError("a labelled page has blocks that run across its pieces")
        x += [features(found)] * WITH_HINTS + [without_hints(features(found))]
        y += marks * (WITH_HINTS + 1)
    return grow(np.concatenate(x), np.array(y, float))


def main_text(page: str) -> str:
    found = blocks(page)
    if not found:
        return ""
    return " ".join(b.text for b, keep in zip(found, predict(trained(), features(found)), strict=True) if keep)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, len(batch), 500):
            part = batch.slice(low, 500)
            texts = [main_text(page.as_py()) for page in part.column(2)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (``page_id``, ``url``, ``html``): page_id, url, text, n_chars."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")
