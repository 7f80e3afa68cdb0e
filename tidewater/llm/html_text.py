"""Main text of web pages from flat text blocks.

A page is cut into blocks at block-level tags.  A block is described by its word count and
link density, those of its two neighbours, and by where it stands (inside an article; inside
a navigation, footer or the like).  A decision tree trained on a small labelled table says
which blocks belong to the main text.  A neighbour that stands elsewhere doesn't count, so
the end of an article reads the same whatever menu follows; within a marked article blocks
are kept however short or linked they are.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
HINT = re.compile(r"(?:\b(?:class|id|role)\s*=\s*)(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
# Element names of the markup language
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "audio", "video", "annotation", "annotation-xml"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
    "object", "canvas", "math", "mi", "mn", "mo", "ms", "mtext", "mrow", "mfrac", "msqrt", "mroot", "msub", "msup", "msubsup",
    "munder", "mover", "munderover", "mstyle", "mpadded", "mphantom", "menclose", "merror", "mspace", "semantics",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
MAIN = {"article", "main"}
ASIDE = {"nav", "footer", "aside", "form", "menu", "button", "head", "title"}
# parts of an article that stand around it elsewhere
PARTS = {"header", "dialog", "select", "fieldset", "legend", "figcaption"}
AROUND = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer "
    "header masthead menu menus modal nav navbar navigation newsletter notice notices popup promo related replies share sharing "
    "sidebar social sponsor sponsored subscribe toolbar widget respond contentinfo complementary search alert".split()
)
# of these also compound names count inside an article, by their first or last part
COMPOUND = frozenset(
    "ad ads advert adverts advertisement comment comments newsletter popup promo related replies respond share sharing sidebar "
    "sponsor sponsored subscribe".split()
)
# what readers wrote, and teasers of other articles; an article element that is called so is none
TALK = frozenset("comment comments replies reply respond discussion related".split())
HEADS = frozenset(("header", "masthead", "banner"))
# beginnings of class names that tell of the page, not of what is inside; and of an article's own header
ABOUT, OWN = {"no", "has", "with", "without", "is", "not", "hide", "show"}, {"entry", "post", "article", "content", "story"}


def stands_around(hints: str, inside: bool) -> bool:
    """Whether class, id or role name something around an article; inside of one only whole
    names count, and compound ones that begin or end with a word that is told apart there."""
    for name in hints.lower().split():
        words = re.split("[_-]+", name)
        if words[0] in ABOUT:
            continue
        if inside:
            if (name in AROUND and name not in HEADS) or not COMPOUND.isdisjoint((words[0], words[-1])):
                return True
            continue
        found = AROUND.intersection(words)
        if found and not (found <= HEADS and words[0] in OWN):
            return True
    return False


def is_talk(hints: str) -> bool:
    """Whether class, id or role name comments or teasers, by their first or last part."""
    parts = (re.split("[_-]+", name) for name in hints.lower().split())
    return any(words[0] not in ABOUT and not TALK.isdisjoint((words[0], words[-1])) for words in parts)


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    main: bool
    around: bool

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "main", "around")

# The labelled table: blocks of made-up pages, in the order of FEATURES, 1 for main text.
LABELLED = [
    # paragraphs and headings of an article
    (42, 0.0, 8, 0.0, 37, 0.0, 1, 0, 1), (37, 0.0, 42, 0.0, 3, 0.0, 1, 0, 1), (3, 0.0, 37, 0.0, 55, 0.0, 1, 0, 1),
    (8, 0.0, 12, 0.0, 42, 0.0, 1, 0, 1), (1, 0.0, 30, 0.0, 9, 0.0, 1, 0, 1), (2, 0.0, 1, 0.0, 1, 0.0, 1, 0, 1),
    (60, 0.1, 4, 0.0, 18, 0.0, 1, 0, 1), (6, 0.3, 22, 0.0, 48, 0.1, 1, 0, 1), (5, 0.0, 1, 1.0, 15, 0.0, 1, 0, 1),
    (11, 0.0, 6, 0.0, 9, 0.0, 1, 0, 1), (90, 0.02, 70, 0.0, 6, 0.2, 1, 0, 1), (4, 1.0, 33, 0.0, 41, 0.0, 1, 0, 1),
    # its last and its linked blocks: lists of sources, cross references, a single paragraph
    (11, 0.0, 11, 0.0, 0, 0.0, 1, 0, 1), (1, 0.0, 40, 0.0, 0, 0.0, 1, 0, 1), (20, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1),
    (3, 1.0, 0, 0.0, 0, 0.0, 1, 0, 1), (5, 1.0, 2, 0.0, 6, 1.0, 1, 0, 1), (6, 1.0, 5, 1.0, 4, 1.0, 1, 0, 1),
    (4, 1.0, 6, 1.0, 0, 0.0, 1, 0, 1), (2, 0.0, 30, 0.0, 5, 1.0, 1, 0, 1), (9, 1.0, 12, 0.0, 10, 0.0, 1, 0, 1),
    (10, 0.0, 9, 1.0, 0, 0.0, 1, 0, 1), (25, 0.8, 14, 0.0, 3, 1.0, 1, 0, 1), (14, 0.0, 20, 0.0, 25, 0.8, 1, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 1), (2, 1.0, 0, 0.0, 1, 1.0, 1, 0, 1), (12, 1.0, 0, 0.0, 1, 1.0, 1, 0, 1),
    (7, 0.5, 8, 0.4, 7, 0.6, 1, 0, 1), (3, 0.7, 1, 1.0, 18, 0.0, 1, 0, 1), (30, 0.6, 2, 1.0, 2, 1.0, 1, 0, 1),
    # articles on pages that mark none
    (48, 0.0, 30, 0.0, 52, 0.05, 0, 0, 1), (25, 0.0, 60, 0.0, 33, 0.0, 0, 0, 1), (35, 0.1, 2, 0.0, 44, 0.0, 0, 0, 1),
    (18, 0.0, 41, 0.0, 38, 0.0, 0, 0, 1), (70, 0.2, 55, 0.0, 5, 1.0, 0, 0, 1), (22, 0.05, 0, 0.0, 0, 0.0, 0, 0, 1),
    (14, 0.0, 45, 0.0, 36, 0.0, 0, 0, 1), (55, 0.0, 1, 1.0, 3, 1.0, 0, 0, 1), (12, 0.0, 50, 0.0, 40, 0.0, 0, 0, 1),
    # and their headings
    (4, 0.0, 1, 1.0, 40, 0.0, 0, 0, 1), (6, 0.0, 30, 0.0, 52, 0.0, 0, 0, 1), (2, 0.0, 55, 0.0, 38, 0.0, 0, 0, 1),
    (5, 0.0, 0, 0.0, 44, 0.0, 0, 0, 1), (1, 0.0, 42, 0.0, 26, 0.05, 0, 0, 1), (3, 0.0, 2, 1.0, 24, 0.0, 0, 0, 1),
    # and their last paragraphs
    (9, 0.0, 44, 0.0, 0, 0.0, 0, 0, 1), (3, 0.0, 30, 0.0, 0, 0.0, 0, 0, 1), (16, 0.0, 12, 0.0, 0, 0.0, 0, 0, 1),
    # short and linked blocks outside of one
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0), (1, 1.0, 1, 1.0, 0, 0.0, 0, 0, 0), (12, 1.0, 0, 0.0, 0, 0.0, 0, 0, 0),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0), (2, 1.0, 1, 1.0, 3, 1.0, 0, 0, 0), (4, 0.75, 2, 1.0, 40, 0.0, 0, 0, 0),
    (5, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0), (3, 0.0, 60, 0.0, 4, 0.5, 0, 0, 0), (20, 0.8, 15, 0.9, 12, 1.0, 0, 0, 0),
    (7, 0.4, 3, 1.0, 5, 1.0, 0, 0, 0), (30, 0.7, 2, 1.0, 2, 1.0, 0, 0, 0), (6, 0.0, 4, 0.0, 5, 0.5, 0, 0, 0),
    # navigation, footers, adverts, forms, comments
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0), (14, 0.0, 1, 1.0, 8, 0.0, 0, 1, 0), (9, 0.0, 44, 0.0, 0, 0.0, 0, 1, 0),
    (33, 0.0, 21, 0.0, 18, 0.0, 0, 1, 0), (60, 0.0, 33, 0.0, 28, 0.0, 0, 1, 0), (25, 0.3, 40, 0.0, 2, 1.0, 0, 1, 0),
    (40, 0.0, 35, 0.0, 50, 0.0, 1, 1, 0), (3, 0.0, 45, 0.0, 47, 0.0, 1, 1, 0), (12, 0.0, 30, 0.0, 44, 0.1, 1, 1, 0),
    (70, 0.1, 12, 0.0, 50, 0.0, 1, 1, 0), (5, 1.0, 22, 0.0, 30, 0.0, 1, 1, 0), (18, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0),
]


class DecisionTree:
    """Binary splits by the decrease of Gini impurity."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, depth: int = 6):
        self.label, self.split = int(2 * labels.sum() >= len(labels)), None
        if depth == 0 or labels.min() == labels.max():
            return
        best = (1e-9, None)
        whole = self._impurity(labels)
        for j in range(rows.shape[1]):
            levels = np.unique(rows[:, j])
            for at in (levels[1:] + levels[:-1]) / 2:
                left = rows[:, j] < at
                gain = whole - self._impurity(labels[left]) - self._impurity(labels[~left])
                if gain > best[0] + 1e-12:
                    best = (gain, (j, float(at), left))
        if best[1]:
            j, at, left = best[1]
            self.split = (j, at, DecisionTree(rows[left], labels[left], depth - 1), DecisionTree(rows[~left], labels[~left], depth - 1))

    @staticmethod
    def _impurity(labels: np.ndarray) -> float:
        p = labels.mean()
        return 2 * p * (1 - p) * len(labels)

    def __call__(self, row: tuple) -> int:
        node = self
        while node.split:
            j, at, low, high = node.split
            node = low if row[j] < at else high
        return node.label


def trained(table: list[tuple] = LABELLED) -> DecisionTree:
    data = np.array(table, dtype=float)
    return DecisionTree(data[:, :-1], data[:, -1])


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order; references decoded, white space made single spaces."""
    out: list[Block] = []
    open_tags: list[tuple[str, int, int, int, int]] = []  # name, what it adds to main, around, hinted and talk
    hinted = 0  # of around, what only class, id or role say
    talk = 0  # open elements that are called comments or the like
    closed_main = False  # a marked article has ended
    text: list[str] = []
    links: list[str] = []
    in_link, main, around = False, 0, 0

    def add(raw: str) -> None:
        if raw:
            raw = html.unescape(raw)
            text.append(raw)
            if in_link:
                links.append(raw)
            elif links:
                links.append(" ")

    def leave() -> str:
        nonlocal main, around, hinted, talk, closed_main
        name, *added = open_tags.pop()
        main, around, hinted, talk = main - added[0], around - added[1], hinted - added[2], talk - added[3]
        closed_main = closed_main or bool(added[0] and not main and name == "article")
        return name

    def flush() -> None:
        words = "".join(text).split()
        if words:
            out.append(Block(" ".join(words), len(words), min(len(words), len("".join(links).split())), main > 0, around > 0))
        text.clear()
        links.clear()

    at, end = 0, len(page)
    while at < end:
        m = TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if not (name := (m["name"] or "").lower()):
            continue
        closing = m["close"] == "/"
        if name in INLINE:
            if name == "a":
                in_link = not closing
            continue
        flush()
        if name in VOID:
            continue
        if name in RAW:
            if not closing and not m["rest"].endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
                at = stop.start() if stop else end
            continue
        if closing:
            in_link = False
            if any(t[0] == name for t in open_tags):
                while leave() != name:
                    pass
            continue
        if name == "body":
            while open_tags:
                leave()
        if name in ("p", "li", "dt", "dd", "option") and open_tags and open_tags[-1][0] == name:
            leave()
        hints = " ".join(h.strip("\"'") for h in HINT.findall(m["rest"]))
        if m["rest"].endswith("/") and any(t[0] == "svg" for t in open_tags):
            continue
        aside = name in ASIDE or (name in PARTS and not main) or HIDDEN.search(m["rest"]) is not None
        talks = name not in ("html", "body", "main") and is_talk(hints)
        named = (name not in ("html", "body", *MAIN) and stands_around(hints, main > 0)) or (name == "article" and talks)
        adds, hint = int(aside or named), int(named and not aside)
        marked = (name in MAIN or "articlebody" in hints.lower()) and not talks
        if name in MAIN and marked and not main and not talk and not closed_main and not stands_around(hints, False):
            # what a wrapper is called doesn't count within the article
            adds, hint = adds - hinted, -hinted
        mine = (name, int(marked), adds, hint, int(talks))
        open_tags.append(mine)
        main, around, hinted, talk = main + mine[1], around + mine[2], hinted + mine[3], talk + mine[4]
    flush()
    return out


def features(found: list[Block]) -> list[tuple]:
    none = Block("", 0, 0, False, False)

    def beside(block: Block, other: Block) -> Block:
        return other if (other.main, other.around) == (block.main, block.around) else none

    rows = []
    for before, b, after in zip([none, *found], found, [*found[1:], none]):
        a, c = beside(b, before), beside(b, after)
        rows.append((b.words, b.density, a.words, a.density, c.words, c.density, int(b.main), int(b.around)))
    return rows


def main_text(page: str | None, tree: DecisionTree) -> str:
    found = blocks(page) if page else []
    return " ".join(b.text for b, row in zip(found, features(found)) if tree(row))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (page_id, url, html).

    Null or empty html, and pages without main text, give an empty text.  Rows are
    independent; null ids and urls are kept.  Cut-off tags, comments, scripts and references
    at the end of a page do no harm.
    """
    tree = trained()
    schema = T.StructType(
        [
            T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
            T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page, tree) for page in batch["html"]]
            yield pd.DataFrame(
                {"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInPandas(run, schema)
