"""Main-text extraction from flat HTML blocks with a learned decision tree.

A page becomes a flat list of text blocks in page order.  Each block has its
word count and link density, the same of its neighbours, and where it stands
(article, boilerplate element, class hints).  A small decision tree, trained
on the blocks of a few labelled pages (``labelled_pages``), says which blocks
are main text.  Pages are independent, so Spark maps over them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled_pages import PAGES

# fixed values: HTML element names
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button canvas center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section select summary table "
    "tbody td tfoot th thead tr ul video audio".split()
)
RAW_TAGS = ("script", "style", "noscript", "template", "iframe", "svg", "math", "object", "textarea", "title", "head")
SWALLOW_TAGS = frozenset("script style textarea title".split())  # without an end tag, they reach to the page's end
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form menu dialog button select fieldset".split())
ARTICLE_TAGS = frozenset(("article", "main"))
#: words in class, id or role that mark an element as not main text, or as main text
BAD_HINTS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup "
    "modal overlay newsletter subscribe signup share sharing social related recommended sidebar side widget menu nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager footer foot header masthead topbar toolbar comment comments respond "
    "reply replies discussion disqus copyright legal login search tags toc skip complementary contentinfo".split()
)
GOOD_HINTS = frozenset("article content post story entry body main text maincontent articlebody postbody".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_HINT = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_CLOSED = re.compile(r"""(?:^|[\s"'])/\s*\Z""")  # not the end of an unquoted value
_WORDS = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW_TAGS}
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\S+")

FEATURES = ("words", "links", "prev_words", "prev_links", "next_words", "next_links", "article", "bad", "good", "list", "heading")


@dataclass
class Block:
    text: str
    words: int
    links: float  # share of words inside links
    article: int = 0  # inside article or main
    bad: int = 0  # inside a boilerplate element or under a bad hint
    good: int = 0
    list: int = 0
    heading: int = 0
    marks: list = field(default_factory=list)  # data-main marks of labelled pages


def _hints(attributes: str) -> tuple[int, int]:
    """(bad, good) by class, id and role; what follows has or with in a name ('has-sidebar') is said of another element."""
    words = set()
    for m in _HINT.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").split():
            for w in _WORDS.split(name):
                if w.lower() in ("has", "with"):
                    break
                words.add(w.lower())
    return int(bool(words & BAD_HINTS)), int(bool(words & GOOD_HINTS))


def blocks(page: str) -> list[Block]:
    """Flat text blocks of a page; character references decoded, white space single."""
    out: list[Block] = []
    open_tags: list[tuple[str, int, int, int, int, int, int, int]] = []
    parts: list[str] = []
    linked: list[str] = []
    state = [0] * 7  # article, bad, good, list, heading, link, mark

    def flush() -> None:
        if not parts:
            return
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            n = len(_WORD.findall(text))
            in_links = len(_WORD.findall(html.unescape(" ".join(linked))))
            article, bad, good, listed, heading, _, mark = (min(1, s) for s in state)
            out.append(Block(text, n, min(1.0, in_links / n), article, bad, good, listed, heading, [mark]))
        parts.clear()
        linked.clear()

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        start = token.start() if token else size
        if start > at:
            parts.append(page[at:start])
            if state[5]:
                linked.append(page[at:start])
        if not token:
            break
        at = token.end()
        if token[2] is None:  # comment, CDATA or declaration
            continue
        name, closing = token[2].lower(), bool(token[1])
        if name in BLOCK_TAGS:
            flush()
        if closing:
            if any(t[0] == name for t in open_tags):
                while open_tags:
                    top = open_tags.pop()
                    for i, n in enumerate(top[1:]):
                        state[i] -= n
                    if top[0] == name:
                        break
            continue
        if name in RAW_TAGS:
            if name != "head" and parts:
                parts.append(" ")
            if not _CLOSED.search(token[3]):
                end = _RAW_END[name].search(page, at)
                at = end.end() if end else size if name in SWALLOW_TAGS else at
            continue
        if name in VOID_TAGS or token[3].rstrip().endswith("/"):
            continue
        bad, good = (0, 0) if name in ("html", "body") else _hints(token[3])
        gain = (
            int(name in ARTICLE_TAGS), int(name in BOILERPLATE_TAGS or bad), int(good and not bad),
            int(name == "li"), int(len(name) == 2 and name[0] == "h" and name[1].isdigit()), int(name == "a"),
            int("data-main" in token[3]),
        )
        open_tags.append((name, *gain))
        for i, n in enumerate(gain):
            state[i] += n
    flush()
    return out


def block_features(found: list[Block]) -> np.ndarray:
    """One row per block; beyond the page's ends a neighbour has no words and no links."""
    own = np.array([[b.words, b.links] for b in found], dtype=float).reshape(-1, 2)
    none = np.zeros((1, 2))
    place = np.array([[b.article, b.bad, b.good, b.list, b.heading] for b in found], dtype=float).reshape(-1, 5)
    return np.hstack([own, np.vstack([none, own[:-1]]), np.vstack([own[1:], none]), place]) if found else np.zeros((0, len(FEATURES)))


@dataclass
class Tree:
    """Binary decision tree: ``feature`` -1 marks a leaf with ``value``."""

    feature: int
    cut: float = 0.0
    value: bool = False
    low: Tree | None = None
    high: Tree | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.value)
        below = x[:, self.feature] <= self.cut
        out = np.empty(len(x), dtype=bool)
        out[below], out[~below] = self.low.predict(x[below]), self.high.predict(x[~below])
        return out

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, depth: int = 6) -> Tree:
        """Greedy Gini splits at midpoints; equal gains go to the feature that stands last (structure before size)."""

        def impurity(part: np.ndarray) -> float:
            p = part.mean() if len(part) else 0.0
            return len(part) * p * (1 - p)

        best = (1e-9, -1, 0.0)
        if depth and 0 < y.mean() < 1:
            for f in reversed(range(x.shape[1])):
                values = np.unique(x[:, f])
                for cut in (values[:-1] + values[1:]) / 2:
                    below = x[:, f] <= cut
                    gain = impurity(y) - impurity(y[below]) - impurity(y[~below])
                    if gain > best[0] + 1e-9:
                        best = (gain, f, float(cut))
        if best[1] < 0:
            return cls(-1, value=bool(y.mean() >= 0.5))
        below = x[:, best[1]] <= best[2]
        return cls(best[1], best[2], low=cls.fit(x[below], y[below], depth - 1), high=cls.fit(x[~below], y[~below], depth - 1))


@lru_cache(maxsize=1)
def trained_tree() -> Tree:
    """Tree of the labelled pages: their blocks under a ``data-main`` element are main text."""
    pages = [blocks(p) for p in PAGES]
    x = np.vstack([block_features(p) for p in pages])
    y = np.array([bool(b.marks[0]) for p in pages for b in p])
    return Tree.fit(x, y)


def main_text(page: str | None, tree: Tree | None = None) -> str:
    """Main text of one page: kept blocks in page order, joined by one space."""
    found = blocks(page or "")
    if not found:
        return ""
    kept = (tree or trained_tree()).predict(block_features(found))
    return " ".join(b.text for b, k in zip(found, kept) if k)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Null and empty pages, and pages without main text, give an empty text.
    Rows that repeat an id are extracted each.  Other columns are not read; an
    empty table gives no rows.  The whole page is read, whatever its length.
    """
    tree = trained_tree()
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py(), tree) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
