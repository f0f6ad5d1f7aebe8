"""HTML main text: flat text blocks classified by a small decision tree.

A page is cut into text blocks at block-level tags. A block is described by its words and link
density, by those of the blocks before and after it, and by whether it stands inside an article
or inside another part (navigation, footer, form, advert, comments), and how sure that is: an
element or comment section is one, a name word in class, id, role or aria-label only speaks for
one, and does not count where the element also names an article or holds the page's.
A decision tree decides which blocks are main text; it is grown here, by Gini impurity, from the
labelled table below.

Defined results: a null or empty page gives an empty text; markup that is never closed reaches to
the end of its parent; a "<" that starts no tag is text; scripts, styles and the like run to
their own end tag or the end of the page; ``<br>`` is white space; repeated rows get equal texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Elements by their part in a page.
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas select noframes".split())
BOILER = frozenset("nav footer aside form button dialog menu fieldset label option datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr br input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FLOWING = frozenset("p dt dd li option tr td th thead tbody tfoot h1 h2 h3 h4 h5 h6".split())
#: Words in class, id, role and aria-label that name a part; how sure each is.
COMMENT_WORDS = "comment|comments|commentlist|disqus|respond|reply|replies"
WEAK_WORDS = ("header|discussion|related|recommended|recommendations|tags|meta|byline|notice|notices|alert|search|form|"
              "legal|copyright|disclaimer|social|share|sharing|promotion|skip")
NAME_WORDS = ("ad|ads|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|sidebar|aside|widget|"
              "menu|menubar|nav|navbar|navigation|breadcrumb|breadcrumbs|footer|masthead|topbar|toolbar|cookie|cookies|"
              "consent|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|pagination|pager|contentinfo|complementary")
WEAK, NAMED, SURE = 0.25, 0.5, 1.0
ARTICLE_WORDS = "article|main|content|post|entry|story|body|articlebody|maincontent|postcontent|entrycontent|text"

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<([a-zA-Z][^\s/>]*)([^>]*)>"
                    r"|</([a-zA-Z][^\s/>]*)[^>]*>|<[!?/][^>]*>|<[a-zA-Z/!?][^>]*\Z", re.S)
_NAMED = re.compile(r"(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SURENESS = {w: sure for words, sure in ((COMMENT_WORDS, SURE), (NAME_WORDS, NAMED), (WEAK_WORDS, WEAK)) for w in words.split("|")}
_ARTICLE = frozenset(ARTICLE_WORDS.split("|"))
_STATE = re.compile(r"(?:has|no|with|without)[_-]", re.I)  # has-sidebar: the page's layout, not this part
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)

#: The labelled table: words, link density, words and link density of the block before and of the
#: block after, inside an article, inside another part; and whether the block is main text.
LABELLED = (
    (120, 0.0, 80, 0.0, 95, 0.0, 1, 0, 1), (45, 0.05, 120, 0.0, 60, 0.0, 1, 0, 1), (8, 0.0, 0, 0.0, 90, 0.0, 1, 0, 1),
    (1, 0.0, 40, 0.0, 70, 0.0, 1, 0, 1), (2, 0.0, 1, 0.0, 1, 0.0, 1, 0, 1), (6, 0.0, 9, 0.8, 30, 0.0, 1, 0, 1),
    (30, 0.4, 50, 0.1, 44, 0.0, 1, 0, 1), (3, 1.0, 55, 0.0, 61, 0.0, 1, 0, 1), (250, 0.02, 4, 0.0, 0, 0.0, 1, 0, 1),
    (12, 0.0, 200, 0.0, 3, 1.0, 1, 0, 1), (1, 0.0, 1, 1.0, 0, 0.0, 1, 0, 1), (20, 0.0, 2, 1.0, 12, 0.0, 1, 0, 1),
    (15, 0.1, 3, 0.0, 0, 0.0, 1, 0, 1), (70, 0.3, 5, 1.0, 8, 1.0, 1, 0, 1), (4, 0.0, 60, 0.0, 14, 0.0, 1, 0, 1),
    (9, 0.0, 3, 0.0, 40, 0.0, 1, 1, 0), (60, 0.0, 90, 0.0, 25, 0.0, 1, 1, 0), (3, 1.0, 100, 0.0, 3, 1.0, 1, 1, 0),
    (25, 0.2, 12, 0.0, 33, 0.1, 1, 1, 0), (1, 0.0, 20, 0.0, 20, 0.0, 1, 1, 0), (140, 0.0, 30, 0.0, 22, 0.0, 1, 1, 0),
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0), (2, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0), (14, 0.0, 60, 0.0, 0, 0.0, 0, 1, 0),
    (9, 0.0, 1, 1.0, 8, 0.0, 0, 1, 0), (35, 0.0, 6, 1.0, 9, 0.0, 0, 1, 0), (80, 0.1, 20, 0.0, 40, 0.0, 0, 1, 0),
    (7, 0.5, 90, 0.0, 5, 0.4, 0, 1, 0), (4, 0.0, 3, 0.0, 2, 0.0, 0, 1, 0), (22, 0.0, 110, 0.0, 31, 0.0, 0, 1, 0),
    (95, 0.0, 60, 0.0, 75, 0.0, 0, 0, 1), (40, 0.02, 8, 0.0, 110, 0.0, 0, 0, 1), (28, 0.1, 50, 0.0, 42, 0.05, 0, 0, 1),
    (7, 0.0, 2, 1.0, 85, 0.0, 0, 0, 1), (9, 0.0, 70, 0.0, 64, 0.0, 0, 0, 1), (3, 0.0, 36, 0.0, 48, 0.0, 0, 0, 1),
    (16, 0.0, 90, 0.0, 4, 0.0, 0, 0, 1), (55, 0.0, 3, 0.9, 0, 0.0, 0, 0, 1), (12, 0.0, 33, 0.0, 21, 0.0, 0, 0, 1),
    (60, 0.15, 0, 0.0, 0, 0.0, 0, 0, 1), (21, 0.0, 4, 1.0, 19, 0.0, 0, 0, 1), (18, 0.05, 22, 0.0, 3, 1.0, 0, 0, 1),
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0), (5, 0.8, 1, 1.0, 60, 0.0, 0, 0, 0), (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0),
    (30, 0.9, 3, 1.0, 4, 1.0, 0, 0, 0), (6, 0.6, 80, 0.0, 2, 1.0, 0, 0, 0), (3, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0),
    (8, 0.5, 40, 0.0, 0, 0.0, 0, 0, 0), (2, 0.0, 3, 0.0, 1, 0.0, 0, 0, 0), (10, 1.0, 70, 0.0, 66, 0.0, 0, 0, 0),
    (45, 0.7, 8, 1.0, 9, 1.0, 0, 0, 0), (1, 1.0, 90, 0.0, 1, 1.0, 0, 0, 0), (5, 0.0, 4, 0.7, 3, 0.6, 0, 0, 0),
)
#: The same for blocks in parts of which only a name speaks: words that main parts have too, then plainer ones.
DOUBTFUL = (
    (6, 0.0, 0, 0.0, 80, 0.0, 0, WEAK, 1), (3, 0.0, 2, 1.0, 60, 0.0, 1, WEAK, 1), (2, 0.0, 70, 0.0, 50, 0.0, 0, WEAK, 1),
    (90, 0.0, 2, 0.0, 70, 0.0, 1, WEAK, 1), (60, 0.05, 80, 0.0, 40, 0.0, 0, WEAK, 1), (30, 0.0, 45, 0.0, 3, 0.0, 1, WEAK, 1),
    (14, 0.0, 80, 0.0, 3, 1.0, 1, WEAK, 1),
    (14, 0.0, 40, 0.0, 55, 0.0, 0, WEAK, 1), (25, 0.1, 30, 0.0, 0, 0.0, 0, WEAK, 1), (160, 0.0, 0, 0.0, 2, 1.0, 0, WEAK, 1),
    (2, 1.0, 3, 1.0, 2, 1.0, 1, WEAK, 0), (5, 0.9, 60, 0.0, 4, 1.0, 1, WEAK, 0), (2, 0.0, 70, 0.0, 4, 1.0, 1, WEAK, 0),
    (4, 1.0, 2, 0.0, 5, 1.0, 0, WEAK, 0), (30, 0.8, 20, 0.0, 25, 0.7, 0, WEAK, 0), (3, 0.0, 2, 1.0, 4, 1.0, 0, WEAK, 0),
    (12, 0.7, 90, 0.0, 70, 0.0, 1, WEAK, 0), (2, 0.0, 4, 0.0, 3, 1.0, 0, WEAK, 0),
    (110, 0.0, 70, 0.0, 90, 0.0, 0, NAMED, 1), (50, 0.05, 4, 0.0, 60, 0.0, 0, NAMED, 1), (70, 0.0, 0, 0.0, 0, 0.0, 0, NAMED, 1),
    (45, 0.0, 80, 0.0, 3, 1.0, 1, NAMED, 1), (200, 0.02, 2, 1.0, 120, 0.0, 1, NAMED, 1), (90, 0.0, 60, 0.0, 2, 1.0, 1, NAMED, 1),
    (9, 0.0, 3, 0.0, 40, 0.0, 0, NAMED, 0), (25, 0.0, 60, 0.0, 80, 0.0, 1, NAMED, 0), (3, 1.0, 2, 1.0, 90, 0.0, 0, NAMED, 0),
    (12, 0.0, 5, 1.0, 6, 0.0, 0, NAMED, 0), (50, 0.8, 70, 0.0, 30, 0.5, 0, NAMED, 0), (2, 0.0, 100, 0.0, 80, 0.0, 0, NAMED, 0),
    (28, 0.0, 1, 1.0, 1, 1.0, 0, NAMED, 0), (60, 0.6, 40, 0.0, 90, 0.0, 1, NAMED, 0), (18, 0.1, 90, 0.0, 70, 0.0, 1, NAMED, 0),
    (1, 0.0, 0, 0.0, 60, 0.0, 0, NAMED, 0), (7, 0.0, 50, 0.0, 0, 0.0, 1, NAMED, 0), (30, 0.0, 90, 0.0, 110, 0.0, 0, NAMED, 0),
)


# -- decision tree -----------------------------------------------------------------------


@dataclass(frozen=True)
class Node:
    """A test ``feature <= cut``, or a leaf with the share of main text."""

    share: float
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 1) -> Node:
    """A binary tree by Gini impurity; the first of equally good splits is taken."""
    share = float(y.mean()) if len(y) else 0.0
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return Node(share)
    impurity = lambda p: 2 * p * (1 - p)
    best = (impurity(share) - 1e-12, -1, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            n = int(low.sum())
            if least <= n <= len(y) - least:
                both = (n * impurity(y[low].mean()) + (len(y) - n) * impurity(y[~low].mean())) / len(y)
                if both < best[0] - 1e-12:
                    best = (both, f, float(cut))
    if best[1] < 0:
        return Node(share)
    low = x[:, best[1]] <= best[2]
    return Node(share, best[1], best[2], grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def decide(tree: Node, row: tuple) -> bool:
    while tree.feature >= 0:
        tree = tree.low if row[tree.feature] <= tree.cut else tree.high
    return tree.share >= 0.5


def trained_tree() -> Node:
    """One tree for blocks in no other part or surely in one, and one for those between."""
    sure, doubtful = (grow(t[:, :-1], t[:, -1]) for t in (np.array(LABELLED, dtype=float), np.array(DOUBTFUL, dtype=float)))
    at = len(LABELLED[0]) - 2
    return Node(sure.share, at, WEAK / 2, sure, Node(sure.share, at, (NAMED + SURE) / 2, doubtful, sure))


# -- blocks --------------------------------------------------------------------------------


@dataclass
class Part:
    """An element that is another part of the page inside ``outer``, how sure that is, and ``articles`` in it.

    ``sure`` becomes that of the surest part around once the page is read.
    """

    sure: float
    outer: Part | None = None
    named: bool = False
    articles: int = 0


@dataclass
class Block:
    text: str
    words: int
    linked: int
    article: bool
    part: Part | None

    @property
    def density(self) -> float:
        return self.linked / self.words

    @property
    def boiler(self) -> float:
        return self.part.sure if self.part else 0.0


def _named(attributes: str) -> tuple[bool, float]:
    """Whether names say that an element starts an article, and how surely another part."""
    article, sure = False, 0.0
    for kind, *values in _NAMED.findall(attributes):
        tokens = [t for t in "".join(values).lower().split() if not _STATE.match(t)]
        label = kind.lower() == "aria-label"  # prose, not a name
        plain = False
        for token in tokens:
            words = [w.rstrip("0123456789") for w in re.split("[_-]", token)]
            found = [_SURENESS[w] for w in words if w in _SURENESS]
            if found:
                sure = max(sure, min(max(found), WEAK) if label else max(found))
            elif not _ARTICLE.isdisjoint(words):
                plain = True
            if found and words[-1] in _SURENESS and _SURENESS[words[-1]] == WEAK and not _ARTICLE.isdisjoint(words):
                plain = True  # entry-header is a part of the article
        article = article or (plain and not (label and sure))
    return article, 0.0 if article else sure


def _part(name: str, attributes: str, in_article: bool) -> tuple[bool, float]:
    """Whether an element starts an article, and how surely it starts another part."""
    if name in BOILER or (name == "header" and not in_article) or (attributes and _HIDDEN.search(attributes)):
        return False, SURE
    article, sure = _named(attributes) if attributes else (False, 0.0)
    if name in ("html", "body", "article", "main"):
        return article or name in ("article", "main"), 0.0
    return article, sure


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order; parts of one paragraph in inline markup stay together."""
    out: list[Block] = []
    stack: list[tuple[str, bool, Part | None]] = []  # open elements: name, inside article, other part around
    opened_by: Counter[str] = Counter()  # open elements by name
    parts: list[Part] = []  # outer ones first
    pieces: list[tuple[str, bool]] = []
    article = link = False
    part: Part | None = None
    at = 0

    def leave() -> str:
        name = stack.pop()[0]
        opened_by[name] -= 1
        return name

    def flush():
        if pieces:
            text = " ".join(unescape("".join(p for p, _ in pieces)).split())
            if text:
                linked = sum(len(p.split()) for p, in_link in pieces if in_link)
                words = text.count(" ") + 1
                out.append(Block(text, words, min(linked, words), article, part))
            pieces.clear()

    while True:
        m = _TOKEN.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            pieces.append((text, link))
        if not m:
            break
        at = m.end()
        opened, closed = m.group(1) or m.group(3), m.group(5)
        if opened:
            name, attributes = opened.lower(), m.group(2) if m.group(1) else m.group(4)
            if name in RAW:
                if not attributes.endswith("/"):
                    end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
                    at = end.end() if end else len(page)
                if name not in INLINE:
                    pieces.append((" ", link))
                continue
            if name == "a":
                link = True
            if name in INLINE:
                if name == "br":
                    pieces.append((" ", link))
                if name in VOID or not attributes:
                    continue
                own = _part(name, attributes, article)
                if not own[1]:
                    continue  # inline markup that names no part of the page is part of its block
            flush()
            if name in VOID:
                continue
            if name in FLOWING:  # their end tags may be missing: a new one ends the last
                while stack and stack[-1][0] in FLOWING:
                    leave()
                article, part = stack[-1][1:] if stack else (False, None)
            link = link and name == "a"
            starts, other = _part(name, attributes, article)
            if name in ("article", "main") and not (attributes and _named(attributes)[1]):
                if part:
                    part.articles += 1 if name == "article" else -len(page)
            if other:
                part = Part(other, part, other < SURE)
                parts.append(part)
            article = article or starts
            stack.append((name, article, part))
            opened_by[name] += 1
        elif closed:
            name = closed.lower()
            if name == "a":
                link = False
            if opened_by[name]:
                if not (name in INLINE and stack[-1][0] != name):
                    flush()
                    while leave() != name:
                        pass
                    article, part = stack[-1][1:] if stack else (False, None)
            elif name not in INLINE:
                flush()
    flush()
    for inner in reversed(parts):
        if inner.outer:
            inner.outer.articles += inner.articles
    for p in parts:
        if p.named and (p.articles == 1 or p.articles < 0):
            p.sure = 0.0  # what holds the main element or the page's one article is no other part
        p.sure = max(p.sure, p.outer.sure if p.outer else 0.0)
    return out


def main_text(page: str, tree: Node) -> str:
    found = blocks(page)
    kept = []
    for k, b in enumerate(found):
        before = (found[k - 1].words, found[k - 1].density) if k else (0, 0.0)
        after = (found[k + 1].words, found[k + 1].density) if k + 1 < len(found) else (0, 0.0)
        if decide(tree, (b.words, b.density, *before, *after, int(b.article), b.boiler)):
            kept.append(b.text)
    if not kept:  # a few short words that stand in no other part are what the page has to say
        kept = [b.text for b in found if not b.boiler and b.density < 0.5]
    return "\n".join(kept)


def extract_pages(pages: DataFrame, keep: list[Column | str], html: str = "html") -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` (code points)."""
    rows = pages.select(*keep, pages[html].alias("_html"))
    tree = trained_tree()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p or "", tree) for p in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*batch.schema.names[:-1], "text", "n_chars"])

    fields = [StructField("text", StringType()), StructField("n_chars", LongType())]
    return rows.mapInArrow(extracted, StructType([*pages.select(*keep).schema.fields, *fields]))
