"""Main text of web pages: flat text blocks judged by a decision tree over their own and their neighbours' features."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridframe.llm.textbytes import added

# Element names and name hints of page furniture.
DROPPED = "script style noscript template textarea select svg math iframe object canvas audio video button".split()
INLINE = (
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong"
    " sub sup time tt u var wbr img input"
).split()
CONTAINERS = (
    "html head body div section nav header footer aside form article main ul ol dl table figure dialog details fieldset"
    " blockquote menu address center"
).split()
FURNITURE = "head nav header footer aside form dialog menu fieldset".split()
ROLES = "navigation banner contentinfo complementary search dialog alert alertdialog menu form".split()
HINTS = (
    "ad ads advert advertisement adverts advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr"
    " notice notification alert warning disclaimer comment comments disqus respond reply replies discussion sidebar side"
    " widget widgets menu nav navbar navigation breadcrumb breadcrumbs topbar toolbar header masthead footer bottom"
    " copyright legal share sharing social related recommended recommendations newsletter subscribe subscription signup"
    " login popup modal overlay pagination pager search form skip teaser outbrain taboola"
).split()

FEATURES = "words density prev_words prev_density next_words next_density marked in_article heading".split()

#: Blocks labelled by hand, the features in the order above and then 1 for main text.
LABELLED = (
    # menus, adverts, notices, headers, footers, comments: marked by their element or name
    (6, 1.0, 0, 0.0, 1, 1.0, 1, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0), (8, 0.0, 1, 1.0, 9, 0.0, 1, 0, 0, 0),
    (30, 0.0, 1, 1.0, 12, 0.0, 1, 0, 0, 0), (14, 0.1, 80, 0.0, 0, 0.0, 1, 0, 0, 0), (4, 0.0, 60, 0.0, 25, 0.0, 1, 1, 1, 0),
    (45, 0.0, 4, 0.0, 30, 0.0, 1, 1, 0, 0), (25, 0.0, 45, 0.0, 3, 0.0, 1, 1, 0, 0), (3, 0.0, 25, 0.0, 0, 0.0, 1, 1, 0, 0),
    (120, 0.0, 70, 0.0, 5, 0.0, 1, 0, 0, 0), (9, 0.0, 0, 0.0, 6, 1.0, 1, 0, 1, 0), (18, 0.3, 50, 0.0, 40, 0.0, 1, 1, 0, 0),
    # inside an article element
    (9, 0.0, 12, 0.0, 60, 0.0, 0, 1, 1, 1), (1, 0.0, 0, 0.0, 1, 0.0, 0, 1, 1, 1), (60, 0.0, 9, 0.0, 40, 0.0, 0, 1, 0, 1),
    (1, 0.0, 40, 0.0, 35, 0.0, 0, 1, 0, 1), (2, 0.0, 1, 0.0, 90, 0.0, 0, 1, 0, 1), (35, 0.1, 2, 0.0, 7, 0.0, 0, 1, 0, 1),
    (200, 0.05, 0, 0.0, 14, 0.0, 0, 1, 0, 1), (7, 0.0, 35, 0.1, 10, 0.0, 0, 1, 0, 1), (22, 0.4, 60, 0.0, 48, 0.0, 0, 1, 0, 1),
    (3, 0.0, 1, 1.0, 15, 0.0, 0, 1, 0, 1), (12, 0.2, 3, 0.0, 0, 0.0, 0, 1, 0, 1), (5, 0.0, 5, 0.0, 5, 0.0, 0, 1, 0, 1),
    (4, 0.0, 12, 0.0, 4, 0.0, 0, 1, 1, 1), (4, 0.0, 4, 0.0, 3, 0.0, 0, 1, 0, 1), (8, 0.0, 5, 0.0, 3, 0.0, 0, 1, 0, 1),
    (6, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (3, 0.0, 30, 0.0, 2, 0.0, 0, 1, 0, 1), (9, 0.0, 1, 1.0, 1, 0.0, 0, 1, 1, 1),
    (2, 0.0, 7, 0.0, 1, 0.0, 0, 1, 0, 1), (10, 0.0, 10, 0.0, 4, 0.0, 0, 1, 1, 1), (5, 0.0, 6, 0.0, 0, 0.0, 0, 1, 0, 1),
    (7, 0.0, 90, 0.0, 2, 0.0, 0, 1, 0, 1), (1, 0.0, 1, 0.0, 0, 0.0, 0, 1, 0, 1), (3, 0.0, 4, 0.0, 4, 0.0, 0, 1, 0, 1),
    (3, 1.0, 50, 0.0, 4, 1.0, 0, 1, 0, 0), (4, 1.0, 3, 1.0, 5, 1.0, 0, 1, 0, 0), (6, 0.9, 4, 1.0, 14, 0.0, 0, 1, 0, 0),
    (10, 0.8, 90, 0.0, 0, 0.0, 0, 1, 0, 0),
    # outside of it, or on pages without one
    (60, 0.0, 5, 0.0, 40, 0.0, 0, 0, 0, 1), (40, 0.1, 60, 0.0, 30, 0.0, 0, 0, 0, 1), (25, 0.0, 3, 1.0, 50, 0.0, 0, 0, 0, 1),
    (90, 0.2, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (6, 0.0, 45, 0.0, 50, 0.0, 0, 0, 0, 1), (3, 0.0, 30, 0.0, 28, 0.1, 0, 0, 0, 1),
    (7, 0.0, 4, 1.0, 40, 0.0, 0, 0, 1, 1), (5, 0.0, 8, 0.3, 70, 0.0, 0, 0, 1, 1), (4, 0.0, 55, 0.0, 33, 0.0, 0, 0, 1, 1),
    (17, 0.0, 28, 0.0, 4, 0.5, 0, 0, 0, 1), (20, 0.1, 6, 0.0, 20, 0.0, 0, 0, 0, 1), (150, 0.3, 12, 0.0, 8, 1.0, 0, 0, 0, 1),
    (3, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (2, 1.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0), (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0),
    (5, 0.0, 3, 0.0, 4, 0.0, 0, 0, 0, 0), (9, 0.2, 60, 0.0, 3, 1.0, 0, 0, 0, 0), (8, 0.0, 40, 0.0, 0, 0.0, 0, 0, 0, 0),
    (3, 0.0, 6, 0.0, 2, 1.0, 0, 0, 1, 0), (20, 0.7, 3, 0.0, 15, 0.8, 0, 0, 0, 0), (35, 0.6, 20, 0.7, 2, 1.0, 0, 0, 0, 0),
    (12, 0.6, 40, 0.0, 40, 0.0, 0, 0, 0, 0), (6, 0.5, 5, 0.6, 7, 0.4, 0, 0, 0, 0), (2, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0),
    (5, 0.0, 7, 0.0, 3, 0.0, 0, 0, 0, 0), (9, 0.0, 3, 1.0, 4, 0.0, 0, 0, 0, 0), (4, 0.0, 50, 0.0, 2, 0.0, 0, 0, 0, 0),
    (7, 0.0, 9, 0.0, 0, 0.0, 0, 0, 0, 0), (3, 0.0, 2, 0.0, 6, 0.0, 0, 0, 0, 0), (6, 0.0, 5, 0.0, 1, 1.0, 0, 0, 0, 0),
    (5, 0.0, 0, 0.0, 4, 1.0, 0, 0, 1, 0), (4, 1.0, 60, 0.0, 70, 0.0, 0, 0, 0, 0),
)


@dataclass(frozen=True)
class Node:
    """A split ``row[feature] <= limit`` with two branches, or a leaf with the share of main text."""

    share: float
    feature: int = -1
    limit: float = 0.0
    low: Node | None = None
    high: Node | None = None


def train_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 7, least: int = 2) -> Node:
    """A classification tree by Gini impurity; ties go to the earlier feature and the lower limit."""
    share = float(labels.mean())
    best = None
    if depth and 0 < share < 1:
        for feature in range(rows.shape[1]):
            values = np.unique(rows[:, feature])
            for limit in (values[:-1] + values[1:]) / 2:
                low = rows[:, feature] <= limit
                n = low.sum()
                if least <= n <= len(rows) - least:
                    a, b = labels[low].mean(), labels[~low].mean()
                    impurity = n * a * (1 - a) + (len(rows) - n) * b * (1 - b)
                    if best is None or impurity < best[0] - 1e-12:
                        best = (impurity, feature, float(limit), low)
    if best is None:
        return Node(share)
    _, feature, limit, low = best
    return Node(
        share, feature, limit, train_tree(rows[low], labels[low], depth - 1, least),
        train_tree(rows[~low], labels[~low], depth - 1, least),
    )


def block_tree() -> Node:
    """The tree of the labelled blocks."""
    table = np.array(LABELLED, dtype="float64")
    return train_tree(table[:, :-1], table[:, -1])


def is_main(node: Node, row: tuple) -> bool:
    while node.feature >= 0:
        node = node.low if row[node.feature] <= node.limit else node.high
    return node.share >= 0.5


_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>[^<>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^<>\"']*)*|[^>]*)>"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL,
)
_ATTR = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {name: re.compile(rf"</{name}[\s/>]", re.IGNORECASE) for name in DROPPED}
_DROPPED, _INLINE, _CONTAINERS, _FURNITURE = map(frozenset, (DROPPED, INLINE, CONTAINERS, FURNITURE))
_ROLES, _HINTS = frozenset(ROLES), frozenset(HINTS)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BODY = frozenset("html body article main".split())


def _is_marked(name: str, attrs: str, in_article: bool) -> bool:
    """Whether an element is page furniture by its name, role, class, id or visibility."""
    if name in _BODY:
        return False
    if name in _FURNITURE and not (name == "header" and in_article):
        return True
    if not attrs.strip():
        return False
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
        if key == "role" and value.lower() in _ROLES:
            return True
        if key in ("class", "id"):
            words = {w.lower() for w in _WORD.findall(value)}
            if in_article:
                words.discard("header")
            if words & _HINTS:
                return True
    return False


def text_blocks(page: str) -> list[tuple]:
    """Blocks of a page in order: ``(text, words, density, marked, in_article, heading)``.

    A block is the text between two tags that are not inline. Scripts, styles, comments and other unread elements are
    left out; character references are decoded; white space becomes single spaces; empty blocks are dropped.
    """
    out: list[tuple] = []
    pieces: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # name, marked, in an article, each for everything below it
    own_mark, heading, link, at = False, False, False, 0

    def flush() -> None:
        if pieces:
            text = " ".join("".join(t for t, _ in pieces).split())
            if text:
                words = text.count(" ") + 1
                linked = sum(len(t.split()) for t, inside in pieces if inside)
                _, marked, article = stack[-1] if stack else ("", False, False)
                out.append((text, words, min(1.0, linked / words), int(marked or own_mark), int(article), int(heading)))
            pieces.clear()

    while at < len(page):
        token = _TOKEN.match(page, at)
        at = token.end()
        if (text := token["text"]) is not None:
            pieces.append((html.unescape(text) if "&" in text else text, link))
            continue
        if token["name"] is None:
            continue
        name, attrs = token["name"].lower(), token["attrs"]
        if name in _DROPPED:
            if not token["end"] and not attrs.endswith("/"):
                close = _RAW_END[name].search(page, at)
                at = close.start() if close else len(page)
            continue
        if name == "a":
            link = not token["end"]
        if name in _INLINE:
            continue
        flush()
        link = link and name == "br"
        own_mark, heading = False, False
        if name in _CONTAINERS:
            if token["end"]:
                names = [n for n, _, _ in stack]
                if name in names:
                    del stack[len(names) - 1 - names[::-1].index(name) :]
            else:
                if name == "body":
                    stack = [s for s in stack if s[0] == "html"]
                _, marked, article = stack[-1] if stack else ("", False, False)
                marked = marked or _is_marked(name, attrs, article)
                stack.append((name, marked, article or name in ("article", "main")))
        elif not token["end"]:
            heading = name in _HEADINGS
            own_mark = _is_marked(name, attrs, bool(stack) and stack[-1][2]) or name in ("title", "legend", "option")
    flush()
    return out


def main_text(page: str | None, tree: Node) -> str:
    """The blocks of a page that the tree takes for main text, one per line. Null gives an empty text."""
    found = text_blocks(page or "")
    none = ("", 0, 0.0)
    kept = []
    for i, (text, words, density, marked, article, heading) in enumerate(found):
        before = found[i - 1] if i else none
        after = found[i + 1] if i + 1 < len(found) else none
        if is_main(tree, (words, density, before[1], before[2], after[1], after[2], marked, article, heading)):
            kept.append(text)
    return "\n".join(kept)


def extract(pages: DataFrame, html_column: str = "html", tree: Node | None = None) -> DataFrame:
    """The rows of ``pages`` without the html, with ``text`` and ``n_chars``, its code points.

    Every page is read whole, row by row, so nothing is shuffled and memory follows one page. A null or empty page has
    an empty text. Columns named ``text`` or ``n_chars`` are replaced.
    """
    tree = tree or block_tree()
    kept = [c for c in pages.columns if c not in (html_column, "text", "n_chars")]
    chosen = pages.select(*[pages[c] for c in kept], pages[html_column].alias("_html"))
    schema = added(pages.select(*[pages[c] for c in kept]), text="string", n_chars="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [main_text(page.as_py(), tree) for page in part.column("_html")]
                columns = [*part.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "text", "n_chars"])

    return chosen.mapInArrow(run, schema)
