"""Main text of HTML pages: flat text blocks classified by a decision tree.

A page is cut into flat blocks of text at block-level tags.  A block is described by its words, its link density (percent
of words inside links), the same of its neighbours, where it stands (inside an article, inside something that is no
article, a form, or neither) and whether it is a heading.  A decision tree, trained on the small labelled table below, tells
main text from the rest.  What is plainly set apart (a menu, a reader's comment, a hidden element) may read like an article,
so there the place decides; everywhere else words and link densities of the block and its neighbours do.  A class, a role or a container's id sets a
block apart only if the whole name is made of such words: names of what a text is about, and ids of headings and sections, do not.

Definitions.  A null or empty page has the empty text.  Character references are decoded, white space inside a block is
one space, blocks are joined in page order by an empty line, and nothing is dropped or capped beside what is classified.
Not read are scripts, styles, titles and text areas, to their end tag or the end of the page, and embedded elements and forms' controls, to
their end tag or the end of the block around them; a head without end tag ends with the first tag or text that is none of a head's.
A line break within a block is white space.  Pages are judged one by one, so repeated rows are judged alike.  Only the
columns named are read.  An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML elements by what they do to the flow of text.
BLOCKS = set(
    "address article aside blockquote body canvas caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
RAW = "script style textarea title".split()
UNREAD = set("noscript template svg iframe select button head".split())
IN_HEAD = set("base basefont bgsound head html link meta noframes noscript script style template title".split())
DRAWN = set("svg math".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = "h1 h2 h3 h4 h5 h6".split()
APART = set("nav footer aside menu dialog".split())
MAIN = set("article main".split())
# Whole words in names of classes, ids and roles that mark something beside the article.
MARKS = set(
    "ad ads adv advert adverts advertisement advertisements advertising alert alerts banner banners breadcrumb breadcrumbs carousel comment commentlist comments "
    "complementary consent contentinfo cookie cookies copyright disclaimer discussion disqus footer gdpr header login masthead menu menus modal nav navbar "
    "navigation newsletter notice notices notification notifications paywall popup promo promos promoted promotion recommendation recommendations recommended "
    "related replies reply respond search searchbox searchform share sharebar sharing side sidebar sidebars signup skip skiplink social sponsor sponsored sponsors subscribe subscription "
    "tagcloud tags teaser teasers toc toolbar topbar trending widget widgets".split()
)
# Words that only say what kind of a box a mark is on; a name of nothing but marks and these is furniture, any other is about something.
BOXES = set(
    "area bar block body bottom box btn button buttons col container content count form head heading icon icons inner item items js left link links list main outer page panel "
    "post posts right row section site slot story text thread title top unit wrap wrapper".split()
)
#: Marks that may be what an article is about: within one, a long text under them that is not mostly links is judged as
#: if it stood nowhere, by its words and its neighbours, and the rest stays apart.
MILD = set("copyright search share sharing side social".split())
DOUBTFUL, LONG = 2, 20
#: Elements whose id is a mark; that of others, such as headings and sections, is a slug of what they say.
NAMED = set("div ol span table ul".split())

#: words before, words, words after, link density before, own, after, place (-2 apart, -1 form, 0 neither, 1 article), heading, main text?
LABELLED = [
    tuple(map(int, row.split()))
    for row in """
    40 200 45 0 0 0 -2 0 0
    30 40 2 0 10 0 -2 0 0
    0 90 0 0 0 0 -2 0 0
    150 70 60 0 0 0 -2 0 0
    80 120 90 0 0 0 -2 0 0
    70 15 8 0 0 0 -2 0 0
    3 30 2 0 0 0 -2 0 0
    8 4 40 0 0 0 -2 0 0
    1 9 40 100 0 0 -2 0 0
    3 45 6 0 10 0 -2 0 0
    20 80 30 0 0 0 -2 0 0
    2 25 70 0 0 0 -2 0 0
    4 6 2 0 0 0 -2 0 0
    60 9 55 0 0 0 -2 0 0
    2 3 1 100 100 100 -2 0 0
    200 11 0 0 0 0 -2 0 0
    90 12 0 0 0 0 -2 0 0
    1 1 1 100 100 100 -2 0 0
    9 9 9 0 0 0 -2 0 0
    1 14 9 100 0 0 -2 0 0
    0 1 1 0 100 100 -2 0 0
    12 22 90 0 0 0 -2 0 0
    2 55 60 100 0 0 -2 0 0
    60 33 0 0 0 0 -2 0 0
    100 60 20 0 0 0 -2 0 0
    6 30 12 0 0 0 -2 0 0
    35 5 4 0 0 0 -2 1 0
    25 18 0 5 60 0 -2 0 0
    60 25 25 0 4 0 -2 0 0
    40 60 35 0 0 0 -2 0 0
    1 25 3 0 0 0 -1 0 0
    2 2 3 0 0 0 -1 0 0
    0 8 2 0 0 0 -1 0 0
    2 4 2 100 50 0 -1 0 0
    3 6 2 0 0 0 -1 0 0
    2 12 1 0 0 0 -1 0 0
    4 5 40 0 0 0 -1 1 0
    50 110 6 0 2 0 -1 0 1
    70 30 60 0 0 0 -1 0 1
    40 60 55 0 0 0 -1 0 1
    60 4 80 0 0 0 -1 1 1
    8 90 45 0 4 0 -1 0 1
    2 4 3 100 100 100 0 0 0
    1 6 25 100 0 0 0 0 0
    40 5 1 0 0 100 0 0 0
    1 20 9 100 0 0 0 0 0
    4 16 0 0 0 0 0 0 0
    65 6 3 0 20 100 0 0 0
    9 13 0 0 0 0 0 0 0
    2 15 12 100 0 0 0 0 0
    60 9 4 0 0 100 0 0 0
    30 4 6 0 0 100 0 1 0
    1 14 60 100 0 0 0 0 0
    60 6 4 0 100 100 0 0 0
    3 8 8 100 0 0 0 0 0
    9 2 0 100 100 0 0 0 0
    80 6 0 0 0 0 0 0 0
    150 11 0 0 0 0 0 0 0
    1 7 9 100 0 0 0 0 0
    4 3 0 0 0 0 0 0 0
    3 1 1 0 100 100 0 0 0
    1 1 1 100 100 100 0 0 0
    1 10 4 100 0 0 0 0 0
    70 9 0 0 0 0 0 0 0
    2 8 2 100 0 100 0 0 0
    1 9 9 100 0 0 0 0 0
    20 15 0 0 0 0 0 0 0
    0 3 4 0 0 0 0 0 0
    8 20 15 100 70 90 0 0 0
    80 5 9 0 100 0 0 0 0
    10 7 0 0 0 0 0 0 0
    1 12 10 100 0 0 0 0 0
    1 1 9 100 100 0 0 0 0
    1 4 11 100 0 0 0 0 0
    3 4 2 100 0 100 0 0 0
    4 12 55 100 80 0 0 0 0
    2 3 3 100 100 100 0 0 0
    45 12 0 0 0 0 0 0 0
    2 8 3 100 0 100 0 0 0
    4 7 0 0 0 0 0 0 0
    0 1 2 0 100 100 0 0 0
    1 2 1 100 100 100 0 0 0
    2 3 2 100 0 100 0 1 0
    2 6 30 100 0 0 0 0 0
    3 5 60 100 100 0 0 0 0
    30 8 0 0 0 0 0 0 0
    4 30 9 0 0 0 0 0 1
    9 9 4 0 0 0 0 0 1
    9 5 30 0 0 0 0 1 1
    3 35 8 100 0 0 0 0 1
    30 15 22 0 0 0 0 0 1
    12 1 9 0 0 0 0 0 1
    55 13 4 0 0 0 0 0 1
    2 2 2 0 0 0 0 0 1
    1 31 1 0 0 0 0 0 1
    0 14 0 0 0 0 0 0 1
    70 60 2 0 0 100 0 0 1
    12 30 9 0 0 0 0 0 1
    8 9 25 0 0 0 0 1 1
    90 35 9 0 0 0 0 0 1
    8 41 5 0 0 0 0 0 1
    0 25 0 0 0 0 0 0 1
    30 9 45 0 0 0 0 1 1
    30 32 4 0 0 100 0 0 1
    6 4 8 0 0 0 0 0 1
    8 45 2 0 0 0 0 0 1
    1 48 24 0 0 0 0 0 1
    2 5 48 0 0 0 0 0 1
    20 7 12 0 0 0 0 0 1
    40 9 55 0 100 0 0 0 1
    1 9 25 100 0 0 0 1 1
    10 20 3 0 0 100 0 0 1
    45 18 50 0 0 0 0 0 1
    9 18 40 0 0 0 0 1 1
    20 15 9 0 20 0 0 0 1
    60 2 10 0 0 0 0 0 1
    20 3 40 0 0 0 0 1 1
    60 5 70 0 0 0 0 1 1
    3 9 14 0 0 0 0 0 1
    17 23 6 0 0 0 0 0 1
    64 2 5 0 0 0 0 0 1
    60 6 25 0 0 0 0 1 1
    10 26 1 0 0 0 0 0 1
    60 28 5 0 5 80 0 0 1
    3 40 55 100 0 0 0 0 1
    1 60 40 100 0 0 0 0 1
    0 80 0 0 0 0 0 0 1
    90 60 0 0 0 0 0 0 1
    11 6 3 0 0 0 0 1 1
    1 5 60 100 0 0 0 1 1
    12 45 0 0 0 0 0 0 1
    40 60 80 0 3 0 0 0 1
    2 40 4 100 0 100 0 0 1
    35 34 4 0 0 0 0 0 1
    1 1 48 0 0 0 0 0 1
    3 110 2 100 5 100 0 0 1
    4 7 50 100 0 0 0 1 1
    45 3 50 0 0 0 0 0 1
    60 22 30 0 10 0 0 0 1
    70 8 60 0 0 0 0 0 1
    7 4 20 0 0 0 0 0 1
    2 7 86 0 0 0 0 0 1
    8 50 45 0 12 0 0 0 1
    80 5 0 0 100 0 1 0 0
    4 3 5 100 100 0 1 0 0
    6 4 3 100 100 100 1 0 0
    80 6 1 0 100 100 1 0 0
    60 2 2 0 100 100 1 0 0
    1 70 2 0 0 0 1 0 1
    6 6 80 0 0 0 1 0 1
    12 25 30 0 0 0 1 0 1
    4 16 0 0 0 0 1 0 1
    55 12 80 0 50 0 1 0 1
    1 5 9 100 0 0 1 0 1
    60 8 70 0 100 0 1 0 1
    55 13 4 0 0 0 1 0 1
    60 40 5 0 30 0 1 0 1
    4 30 9 0 0 0 1 0 1
    25 90 40 0 5 0 1 0 1
    3 9 4 100 0 100 1 0 1
    120 16 14 0 0 0 1 0 1
    5 35 60 100 0 0 1 0 1
    90 3 11 0 0 100 1 0 1
    17 23 6 0 0 0 1 0 1
    9 13 0 0 0 0 1 0 1
    70 1 25 0 0 0 1 0 1
    0 200 0 0 0 0 1 0 1
    1 1 48 0 0 0 1 0 1
    60 2 3 0 0 0 1 0 1
    90 60 0 0 0 0 1 0 1
    7 4 20 0 0 0 1 0 1
    2 2 2 0 0 0 1 0 1
    64 2 5 0 0 0 1 0 1
    30 2 70 0 0 0 1 0 1
    120 8 12 0 0 0 1 0 1
    14 4 60 0 0 0 1 1 1
    150 11 0 0 0 0 1 0 1
    9 12 30 0 0 0 1 1 1
    1 12 60 100 0 0 1 0 1
    20 5 45 0 0 0 1 1 1
    20 15 9 0 20 0 1 0 1
    10 7 7 0 0 0 1 0 1
    5 3 1 0 0 0 1 0 1
    3 6 0 0 0 0 1 0 1
    10 7 3 0 0 0 1 0 1
    8 45 2 0 0 0 1 0 1
    2 7 86 0 0 0 1 0 1
    40 150 0 0 0 0 1 0 1
    30 8 0 0 0 0 1 0 1
    """.strip().splitlines()
]
DEPTH = 10


class Tree:
    """A binary classification tree grown by Gini impurity until leaves are pure."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = DEPTH):
        self.root = self._grow(x, y, depth)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int):
        share = float(y.mean())
        if depth == 0 or share in (0.0, 1.0):
            return share
        best = None
        for k in range(x.shape[1]):
            values = np.unique(x[:, k])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, k] <= cut
                a, b = y[left], y[~left]
                impurity = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, k, float(cut))
        if best is None:
            return share
        _, k, cut = best
        left = x[:, k] <= cut
        return k, cut, self._grow(x[left], y[left], depth - 1), self._grow(x[~left], y[~left], depth - 1)

    def __call__(self, row) -> bool:
        node = self.root
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node >= 0.5


def train(table: list[tuple[int, ...]] = LABELLED) -> Tree:
    t = np.array(table, dtype=float)
    return Tree(t[:, :-1], t[:, -1])


_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S | re.I,
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
_ATTR = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot", "thead"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}}


def _place(name: str, attrs: str, inside: int) -> int:
    """Where the text in an element stands, given where the element does."""
    if name in APART or (name == "header" and inside < 1):
        return -2
    if name == "form":
        inside = -1 if inside == 0 else inside
    marks: set[str] = set()
    for key, *values in _ATTR.findall(attrs) if attrs else ():
        key, value = key.lower(), next((v for v in values if v), "").lower()
        if key in ("class", "role") or key == "id" and name in NAMED:
            marks |= _marks(value)
        elif key == "id" and name == "section":
            marks |= _marks(value) & {"comment", "comments"}
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return -2
        elif key == "itemprop" and value == "articlebody":
            return 1
    if name in MAIN:
        # An article within comments or a list of teasers stays apart only by its own marks.
        return -2 if marks & {"comment", "comments", "teaser", "related"} else 1
    if marks & MARKS - (MILD | {"header"} if inside == 1 else set()):
        return -2
    if inside == 1 and marks & MILD:
        return DOUBTFUL
    return max(inside, 1) if "main" in marks else inside


def _marks(value: str) -> set[str]:
    """The marks in the names of an attribute: of each name that has none but marks, words for boxes and numbers."""
    out: set[str] = set()
    for token in value.split():
        parts = [x for x in _PARTS.split(token) if x]
        if all(x in MARKS or x in BOXES or x.isdigit() for x in parts):
            out.update(parts)
    return out


class _Open:
    """Names of open elements, innermost last, counted so that none is looked for in vain."""

    def __init__(self):
        self.names: list[str] = []
        self.places: list[int] = []
        self.count = Counter()
        self.blocks: list[int] = []  # where in ``names`` blocks stand

    def push(self, name: str, place: int = 0) -> None:
        if name in BLOCKS:
            self.blocks.append(len(self.names))
        self.names.append(name)
        self.places.append(place)
        self.count[name] += 1

    def cut(self, at: int) -> None:
        for name in self.names[at:]:
            self.count[name] -= 1
        del self.names[at:], self.places[at:]
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()

    def any(self, names) -> bool:
        return any(self.count[x] for x in names)

    def last(self, name: str) -> int:
        """Where the innermost ``name`` stands; an inline one is not looked for beyond the block around."""
        if not self.count[name]:
            return -1
        least = -1 if name in BLOCKS else self.blocks[-1] if self.blocks else -1
        at = len(self.names) - 1
        while at > least and self.names[at] != name:
            at -= 1
        return at if at > least else -1

    def block(self) -> str:
        """The innermost block that is no paragraph's own line of inline elements."""
        return self.names[self.blocks[-1]] if self.blocks else "p"


def _unread_ends(name: str, unread: _Open, around: _Open) -> bool:
    """Does the start tag end the unread element, whose end tag is left out?"""
    if unread.names[-1] == "head":
        return name not in IN_HEAD
    if name == unread.names[0] and name in ("button", "select"):
        return True
    block = around.block()
    return block != "p" and name in _CLOSED_BY.get(block, ()) and not unread.any(("ul", "ol", "dl", "table", "select"))


def blocks(page: str) -> list[tuple[str, int, int, int, int]]:
    """(text, words, link density, place, heading) of each flat block that has text."""
    out: list[tuple[str, int, int, int, int]] = []
    parts: list[tuple[str, bool]] = []
    stack, unread = _Open(), _Open()  # open elements; the open unread element and what is open in it

    def flush() -> None:
        if parts:
            text = " ".join("".join(t for t, _ in parts).split())
            if text:
                n = len(text.split())
                links = min(100, 100 * len("".join(t if a else " " for t, a in parts).split()) // n)
                place = stack.places[-1] if stack.places else 0
                if place == DOUBTFUL:
                    place = 0 if n >= LONG and links < 50 else -2
                out.append((text, n, links, place, int(stack.any(HEADINGS))))
            parts.clear()

    def close(name: str) -> None:
        at = stack.last(name)
        if at >= 0:
            if stack.blocks and stack.blocks[-1] >= at:
                flush()
            stack.cut(at)

    def text(raw: str) -> None:
        if raw:
            parts.append((html.unescape(raw) if "&" in raw else raw, stack.count["a"] > 0))

    at = 0
    while m := _TOKEN.search(page, at):
        raw = page[at : m.start()]
        if unread.names == ["head"] and raw.strip():
            unread.cut(0)
        if not unread.names:
            text(raw)
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        closed = m["attrs"].endswith("/") and (name in DRAWN or unread.any(DRAWN))
        if name in RAW and not m["end"] and not closed:
            over = _RAW_END[name].search(page, at)
            at = over.end() if over else len(page)
            if not unread.names:
                parts.append((" ", False))
            continue
        if unread.names:
            if m["end"]:
                if unread.count[name]:
                    unread.cut(len(unread.names) - 1 - unread.names[::-1].index(name))
                    continue
                if name not in BLOCKS or not stack.count[name]:
                    continue
                unread.cut(0)  # its end tag is left out: it ends with the block around it
            elif _unread_ends(name, unread, stack):
                unread.cut(0)
            else:
                if name not in VOID and not closed:
                    unread.push(name)
                continue
        if name in UNREAD and not m["end"]:
            parts.append((" ", False))
            if not closed:
                unread.push(name)
            continue
        if name == "br":
            parts.append((" ", False))
            continue
        if name in BLOCKS:
            flush()
        if m["end"]:
            close(name)
            continue
        if name in VOID or closed:
            continue
        while stack.names and name in _CLOSED_BY.get(stack.names[-1], ()):
            stack.cut(len(stack.names) - 1)
        if name in BLOCKS and stack.blocks:
            # An open paragraph or item ends where a block begins, even if inline tags stand open in it.
            around = stack.block()
            if around == "p" or (around == "li" and name == "li"):
                stack.cut(stack.blocks[-1])
        elif name == "a":
            close("a")
        stack.push(name, _place(name, m["attrs"], stack.places[-1] if stack.places else 0))
    if not unread.names or (unread.names == ["head"] and page[at:].strip()):
        text(page[at:])
    flush()
    return out


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page or "")
    words = [0, *(b[1] for b in found), 0]
    links = [0, *(b[2] for b in found), 0]
    keep = [tree((*words[i : i + 3], *links[i : i + 3], b[3], b[4])) for i, b in enumerate(found)]
    return "\n\n".join(b[0] for b, k in zip(found, keep, strict=True) if k)


def extract_batches(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py(), tree) for p in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), *batch.columns[1:]], ["text", "n_chars", *batch.schema.names[1:]])

    return run


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """Main text and its length of every page, with the columns ``keep``."""
    rows = pages.select(F.col(html_col).cast("string").alias("html"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)))
    kinds = "".join(f", k{i} {pages.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    out = rows.mapInArrow(extract_batches(train()), "text string, n_chars long" + kinds)
    return out.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "text", "n_chars")
