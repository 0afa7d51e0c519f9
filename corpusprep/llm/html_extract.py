"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is read once into blocks that end at block-level tags. A block has its word count and
link density, those of the blocks before and after it, and two signs of its place: whether it
lies in an article (unknown on pages without one), and whether it is set aside. For a block of an
article only blocks of articles are neighbours. The tree is trained on the table ``LABELLED``.

An element sets its text aside by its name or role (menus, footers, sidebars, forms; a header
outside of articles), or because it is hidden. Words in its class or id are a weaker sign: they
count unless the element holds ``WHOLE`` of the words of its article, or of a page it leaves
little of; then the word names the text, and nothing is set aside by it. Words for reader comments
count up to ``ALL`` of them. An article that is set aside is no article of the page.

Cases: NULL and empty pages give the empty text; markup that is never closed ends with its
page; white space alone makes no block; repeated rows give repeated results; very long pages are
read in one pass like others; an empty table gives an empty result; columns other than the named
ones are dropped; ties in the tree go to the earlier feature and limit.
"""

from __future__ import annotations

import html
import re
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import map_slices

# HTML element names by what they do to text.
SKIPPED = frozenset("script style template noscript iframe audio video annotation annotation-xml".split())
# Their text runs to the end of the page if they stay open.
RAW = frozenset("script style iframe".split())
FORMS = frozenset("form button select textarea input label fieldset datalist option".split())
# Of these, a label may also stand in a text.
LABEL = "label"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rb rp rt s samp "
    "small span strike strong sub sup time tt u var wbr nobr picture source object canvas "
    "math semantics maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts "
    "mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none "
    "svg circle clippath defs ellipse filter foreignobject g image line lineargradient marker mask path pattern polygon "
    "polyline radialgradient rect stop switch symbol text textpath tspan use".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav header footer aside menu dialog head".split()) | FORMS
MAIN = frozenset("article main".split())
MARKS = re.compile(
    r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|notification\w*|"
    r"alerts?|popup|modal|overlay|newsletter|subscri\w*|signup|login|sidebar|widgets?|related|recommend\w*|"
    r"share|sharing|social|comments?|commentlist|repl(?:y|ies)|disqus|discussion|respond|footer|header|masthead|"
    r"nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|toolbar|copyright|disclaimer|search|form)(?:$|[\s_-])")
# Class words of a layout name what a page has beside the element.
LAYOUT = re.compile(r"(?i)(?:(?<=[\s_-])|^)(?:has|no|with|without)[_-]\S*")
READERS = re.compile(r"(?i)(?:^|[\s_-])(?:comments?|commentlist|repl(?:y|ies)|disqus|respond)(?:$|[\s_-])")
WHOLE, ALL, FEW_WORDS = 0.5, 0.95, 20
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPACE = re.compile(r"\s+")


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(text)}


def _hidden(attributes: dict[str, str]) -> bool:
    style = attributes.get("style", "").replace(" ", "").lower()
    return (
        "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style
        or attributes.get("role", "").lower() in ROLES)


class Main:
    """An article: its words, and the marks of itself and of what it lies in."""

    __slots__ = ("marks", "words")

    def __init__(self, marks: tuple):
        self.marks, self.words = marks, 0


class Mark:
    """An element whose class or id has a word for what is not main text."""

    __slots__ = ("limit", "scope", "words", "holds_main")

    def __init__(self, readers: bool, scope: Main | None):
        self.limit, self.scope = ALL if readers else WHOLE, scope
        self.words, self.holds_main = 0, False


class Block:
    __slots__ = ("text", "words", "links", "mains", "marks", "main", "aside")

    def __init__(self, text: str, linked: int, aside: bool, marks: tuple[Mark, ...], mains: tuple[Main, ...]):
        self.text, self.aside, self.marks, self.mains = text, aside, marks, mains
        self.main = False
        self.words = len(text.split(" "))
        self.links = min(1.0, linked / max(1, len(text)))


class Element:
    __slots__ = ("name", "aside", "mark", "main")

    def __init__(self, name: str, aside: bool, mark: Mark | None, main: Main | None):
        self.name, self.aside, self.mark, self.main = name, aside, mark, main


def placed(found: list[Block]) -> bool:
    """Decide which marks count, and with them where blocks lie; whether the page has an article."""
    whole = 0
    for block in found:
        if block.aside:
            continue
        whole += block.words
        for part in (*block.marks, *block.mains):
            part.words += block.words
    counts: dict[int, bool] = {}

    def sets_aside(mark: Mark) -> bool:
        if id(mark) not in counts:
            scope = mark.scope.words if mark.scope else whole
            small = mark.scope is None and not mark.holds_main and mark.words < FEW_WORDS
            counts[id(mark)] = small or mark.words < mark.limit * scope or not mark.words
        return counts[id(mark)]

    has_main = False
    for block in found:
        block.main = any(not any(map(sets_aside, m.marks)) for m in block.mains)
        block.aside = block.aside or any(map(sets_aside, block.marks))
        has_main |= block.main
    return has_main


def blocks(page: str) -> tuple[list[Block], bool]:
    """The text blocks of a page in order, and whether it has an article."""
    out: list[Block] = []
    stack: list[Element] = []
    buffer: list[str] = []
    linked, in_link, in_svg, in_form = 0, False, False, 0
    paragraph = Element("p", False, None, None)

    def close_block() -> None:
        nonlocal linked
        if buffer:
            text = _SPACE.sub(" ", "".join(buffer)).strip()
            if text:
                around = [*stack, paragraph]
                out.append(Block(
                    text, linked, any(e.aside for e in around), tuple(e.mark for e in around if e.mark),
                    tuple(e.main for e in around if e.main)))
            buffer.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw)
            buffer.append(text)
            if in_link:
                linked += len(text.strip())

    def opened(name: str, attributes: str) -> Element:
        """What an element says about its text."""
        mains = [e.main for e in stack if e.main]
        aside = name in ASIDE and not (name == "header" and mains)
        mark = None
        if attributes.strip() and not aside:
            found = _attributes(attributes)
            aside = _hidden(found)
            named = [LAYOUT.sub("", found.get(key, "")) for key in ("class", "id")]
            if not aside and any(map(MARKS.search, named)):
                mark = Mark(any(map(READERS.search, named)), mains[-1] if mains else None)
        main = None
        if name in MAIN and not aside and not any(e.aside for e in stack):
            main = Main(tuple(m for m in (*(e.mark for e in stack), mark) if m))
            for m in main.marks:
                m.holds_main |= m is not mark
        return Element(name, aside, mark, main)

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name, closing = m[2].lower(), bool(m[1])
        unseen = name in SKIPPED or in_svg and name in ("title", "desc", "metadata") or (
            name == "svg" and _hidden(_attributes(m[3])))
        if unseen and not closing and not m[3].rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\s*[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page) if name in RAW else at
            continue
        if name in SKIPPED:
            continue
        in_svg = name in INLINE and (not closing if name == "svg" else in_svg)
        if name == "a":
            in_link = not closing
        if name == "form":
            in_form = max(0, in_form + (-1 if closing else 1))
        if name in ("br", "img", "wbr") or name == LABEL and not in_form:
            buffer.append(" " if name == "br" else "")
            continue
        if name == "text":
            buffer.append(" ")
        if name in INLINE and name not in FORMS:
            # Marked inline elements set their text aside as a block of their own.
            if closing:
                if any(e.name == name for e in stack):
                    close_block()
                    _pop(stack, name)
                continue
            element = None if name == "a" else opened(name, m[3])
            if element is None or not (element.aside or element.mark):
                continue
        close_block()
        in_link = in_link and name == "a"
        if name not in INLINE and name not in FORMS:
            # A paragraph ends with the next block, closed or not.
            paragraph = opened("p", m[3]) if name == "p" and not closing else Element("p", False, None, None)
        if closing:
            _pop(stack, name)
        elif name == "body":
            _pop(stack, "head")
        elif name not in VOID and name != "p" and not m[3].rstrip().endswith("/"):
            stack.append(opened(name, m[3]))
    close_block()
    return out, placed(out)


def _pop(stack: list[Element], name: str) -> None:
    for i in range(len(stack) - 1, -1, -1):
        if stack[i].name == name:
            del stack[i:]
            return


FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "article", "aside")

# The labelled blocks: features in the order above (link densities in percent; article 0 outside,
# 1 inside, 2 on a page without one), then 1 for main text.
LABELLED = """
1 100 0 0 1 100 0 1 0
2 100 1 100 2 100 0 1 0
1 100 2 100 7 0 0 1 0
7 0 1 100 9 0 0 1 0
12 0 1 100 10 0 0 1 0
30 0 4 100 12 0 0 1 0
9 0 7 0 60 0 1 0 1
1 0 9 0 40 0 1 0 1
60 0 9 0 24 0 1 0 1
2 0 60 0 3 0 1 0 1
3 0 2 0 250 4 1 0 1
250 4 3 0 1 0 1 0 1
1 0 250 4 12 10 1 0 1
5 100 30 0 44 0 1 0 1
8 100 41 2 17 0 1 0 1
1 100 12 0 80 0 1 0 1
14 55 60 0 90 5 1 0 1
4 0 1 100 12 10 1 0 1
40 0 15 0 3 100 1 0 1
12 10 30 0 0 0 0 1 0
25 4 80 0 0 0 0 1 0
8 0 45 0 9 0 1 1 0
40 0 25 0 22 0 1 1 0
22 0 40 0 6 0 1 1 0
120 0 22 0 50 2 1 1 0
3 100 90 0 2 100 1 1 0
2 100 3 100 70 0 1 1 0
6 0 22 0 2 0 0 1 0
2 0 6 0 15 0 0 1 0
15 20 2 0 30 0 0 1 0
80 0 15 20 9 50 0 1 0
4 0 0 0 9 0 0 0 0
18 0 4 0 12 0 0 0 0
35 0 18 0 60 0 0 0 0
2 50 90 0 5 80 0 0 0
70 0 40 0 20 10 0 0 0
1 100 0 0 1 100 2 1 0
20 0 2 100 40 0 2 1 0
60 0 30 0 10 0 2 1 0
9 0 60 0 4 100 2 1 0
45 0 6 0 70 0 2 0 1
70 2 45 0 32 0 2 0 1
32 0 70 2 8 0 2 0 1
8 0 32 0 55 5 2 0 1
5 0 40 0 60 0 2 0 1
3 0 50 0 44 0 2 0 1
6 0 0 0 45 0 2 0 1
25 12 60 0 30 0 2 0 1
16 0 20 0 18 0 2 0 1
2 100 0 0 3 100 2 0 0
3 100 2 100 1 100 2 0 0
4 90 3 100 50 0 2 0 0
6 80 55 0 5 95 2 0 0
12 75 5 95 4 100 2 0 0
20 85 12 75 3 100 2 0 0
3 0 0 0 2 100 1 0 1
2 100 3 0 60 0 1 0 1
6 0 80 0 0 0 1 0 1
1 0 40 0 2 100 1 0 1
2 100 1 0 3 100 1 0 1
3 100 2 100 2 100 1 0 1
2 100 3 100 0 0 1 0 1
9 60 2 100 4 100 1 0 1
5 0 3 100 2 100 1 0 1
4 0 0 0 2 100 2 0 1
6 0 40 0 1 100 2 0 1
7 0 60 0 0 0 2 0 1
8 0 45 0 4 100 2 0 1
3 0 1 100 30 0 2 0 1
2 0 1 100 1 100 2 0 0
3 0 2 100 2 100 2 0 0
2 0 1 100 9 100 2 0 0
1 100 1 100 20 0 2 0 0
20 0 19 0 1 0 2 0 1
15 0 20 0 0 0 2 0 1
18 0 1 100 20 0 2 0 1
19 0 0 0 0 0 2 0 1
24 0 30 0 2 100 2 0 1
5 100 2 100 90 0 2 0 0
30 90 2 100 2 100 2 0 0
""".strip()


class Node:
    __slots__ = ("feature", "limit", "low", "high", "value")

    def __init__(self, value, feature=-1, limit=0.0, low=None, high=None):
        self.value, self.feature, self.limit, self.low, self.high = value, feature, limit, low, high


def grow(x: np.ndarray, y: np.ndarray, depth: int) -> Node:
    """A classification tree by Gini impurity; ties go to the earlier feature and limit."""
    share = y.mean()
    if depth == 0 or share in (0.0, 1.0):
        return Node(bool(share >= 0.5))
    best = (2 * share * (1 - share) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        levels = np.unique(x[:, f])
        for limit in (levels[:-1] + levels[1:]) / 2:
            low = x[:, f] <= limit
            p, q, part = y[low].mean(), y[~low].mean(), low.mean()
            impurity = part * 2 * p * (1 - p) + (1 - part) * 2 * q * (1 - q)
            if impurity < best[0] - 1e-12:
                best = (impurity, f, float(limit))
    if best[1] < 0:
        return Node(bool(share >= 0.5))
    low = x[:, best[1]] <= best[2]
    return Node(None, best[1], best[2], grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


def train(labelled: str = LABELLED, depth: int = 6) -> Node:
    rows = np.array([line.split() for line in labelled.splitlines()], dtype=np.float64)
    return grow(rows[:, :-1], rows[:, -1], depth)


@lru_cache(maxsize=1)
def _tree() -> Node:
    return train()


def features(found: Sequence[Block], has_main: bool) -> np.ndarray:
    own = np.array([[b.words, 100 * b.links] for b in found])
    main = np.array([b.main for b in found])
    around = np.vstack([np.zeros((1, 2)), own, np.zeros((1, 2))])
    inside = np.concatenate([[False], main, [False]])
    # What lies outside of articles is no neighbour of what lies in them.
    before = np.where((main & ~inside[:-2])[:, None], 0, around[:-2])
    after = np.where((main & ~inside[2:])[:, None], 0, around[2:])
    place = np.array([[(1 if b.main else 0) if has_main else 2, b.aside] for b in found], dtype=np.float64)
    return np.hstack([own, before, after, place])


def main_text(page: str, tree: Node | None = None) -> str:
    """The blocks the tree takes for main text, one line each."""
    found, has_main = blocks(page)
    if not found:
        return ""
    kept = []
    for block, row in zip(found, features(found, has_main)):
        node = tree or _tree()
        while node.value is None:
            node = node.low if row[node.feature] <= node.limit else node.high
        if node.value:
            kept.append(block.text)
    return "\n".join(kept)


def extract(pages: DataFrame, *keep: str, page: str = "html") -> DataFrame:
    """``(*keep, text, n_chars)`` of every row."""
    kinds = [f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keep]
    rows = pages.select(*keep, F.col(page).cast("binary").alias("__page"))

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        held = [main_text((p or b"").decode("utf-8", "replace")) for p in piece.column("__page").to_pylist()]
        return pa.record_batch(
            [*(piece.column(k) for k in keep), pa.array(held, pa.string()), pa.array(list(map(len, held)), pa.int64())],
            [*keep, "text", "n_chars"])

    return map_slices(rows, "__page", run, ", ".join([*kinds, "text string, n_chars long"]))
