"""Main text of web pages: flat text blocks, shallow features of a block and its neighbours, a decision tree.

A page is cut at block-level tags into a flat list of text blocks. Each block is described by its word count,
its link density, the same two numbers of the blocks before and after it, and whether an element around it
names itself content or page furniture. The tags article and main win over names, and over elements around them that
are furniture by name alone; nav, aside, footer, comments and what is hidden stay furniture. A decision tree, grown here by Gini impurity on the small labelled table
``LABELLED``, keeps or drops the block. No page depends on another, so there is no shuffle.

Defined results: null or empty html, or a page without content, gives an empty text. Unclosed comments, scripts
and tags end with the page; an unclosed button, select, svg or the like hides nothing. The content of math and object
is text like any other. Repeated page ids are separate rows. Other columns of the table are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from palate.llm.common import map_batches

#: Raw text up to the closing tag.
_RAW = "script|style|textarea|title|iframe"
#: Their text is not of the page; it is skipped without cutting the block around.
_SILENT = frozenset("annotation button canvas noscript select svg template".split())
_ATTRIBUTES = r"""(?:"[^"]*"|'[^']*'|[^>"'])*"""
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:{_RAW})(?=[\s/>])(?P<raw>{_ATTRIBUTES})>|<(/?)([a-z][a-z0-9:-]*)({_ATTRIBUTES})>|<[!?][^>]*>",
    re.S | re.I,
)
_RAW_NAME = re.compile(rf"<({_RAW})(?=[\s/>])", re.I)
#: A start tag closes itself, unless the slash belongs to an unquoted value.
_SELF_CLOSED = re.compile(r"(?<!=)/\s*\Z")
_UNQUOTED_END = re.compile(r"""=\s*[^\s"'>]+/\Z""")
_HINT_ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s/=>]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_NAME_PART = re.compile(r"[a-z]+")

_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option "
    "p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINER = frozenset(
    "article aside blockquote details dialog div dl fieldset figure footer form header main menu nav ol section "
    "table td ul".split()
)
#: Blocks without blocks inside, whose own names count for their text alone.
_LEAF = frozenset("address caption dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre summary".split())
_CONTENT_TAGS = frozenset({"article", "main"})
#: A header that names one of these is that of the article.
_ARTICLE_NAMES = frozenset("article entry post story".split())
_FURNITURE_TAGS = frozenset({"nav", "aside", "footer", "form", "menu", "dialog", "header"})
#: What an element of these names holds is never content, whatever is inside.
_STRICT_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs aside footer comment comments disqus reply replies respond "
    "related recommended advert adverts advertisement sponsored cookie cookies consent gdpr".split()
)
#: A name with one of these parts tells the state of a layout or the topic of a post, not what the element is.
_STATE_NAMES = frozenset(
    "no not without with has have is open closed enabled disabled allowed supports tag category cat topic format "
    "status author".split()
)
_CONTENT_NAMES = frozenset("article content main post story entry text".split())
_FURNITURE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement banner promo sponsor sponsored nav navbar navigation menu breadcrumb "
    "breadcrumbs masthead footer sidebar aside comment comments disqus reply replies respond cookie cookies consent "
    "notice alert gdpr popup modal newsletter subscribe share sharing social related recommended widget toolbar "
    "login signup search form copyright pagination pager".split()
)

#: (hint, words, link density, words before, link density before, words after, link density after, is content).
#: The hint is 1 inside an element that names itself content, -1 inside one that is furniture by its tag or a strict
#: name, -0.5 inside one that is furniture by other names alone, else 0.
LABELLED = (
    (1, 12, 0.0, 9, 0.0, 60, 0.0, 1), (1, 60, 0.0, 12, 0.0, 45, 0.0, 1), (1, 45, 0.02, 60, 0.0, 3, 0.0, 1),
    (1, 3, 0.0, 45, 0.0, 80, 0.0, 1), (1, 80, 0.1, 3, 0.0, 14, 0.0, 1), (1, 1, 0.0, 80, 0.1, 1, 0.0, 1),
    (1, 1, 0.0, 1, 0.0, 0, 0.0, 1), (1, 7, 0.0, 1, 1.0, 7, 0.0, 1), (1, 7, 0.3, 20, 0.0, 11, 0.0, 1),
    (1, 150, 0.05, 7, 0.0, 12, 0.1, 1), (1, 6, 0.6, 40, 0.0, 35, 0.0, 1), (1, 4, 1.0, 40, 0.0, 35, 0.0, 1),
    (1, 9, 0.0, 0, 0.0, 30, 0.0, 1), (1, 30, 0.0, 9, 0.0, 0, 0.0, 1), (1, 22, 0.0, 1, 1.0, 12, 0.0, 1),
    (-1, 1, 1.0, 0, 0.0, 1, 1.0, 0), (-1, 1, 1.0, 1, 1.0, 1, 1.0, 0), (-1, 2, 1.0, 1, 1.0, 14, 0.0, 0),
    (-1, 14, 0.0, 2, 1.0, 9, 0.0, 0), (-1, 12, 0.1, 80, 0.0, 0, 0.0, 0), (-1, 40, 0.0, 12, 0.0, 25, 0.0, 0),
    (-1, 25, 0.0, 40, 0.0, 33, 0.0, 0), (-1, 90, 0.0, 60, 0.0, 70, 0.0, 0), (-1, 5, 0.0, 5, 0.0, 5, 0.0, 0),
    (-1, 16, 0.4, 30, 0.0, 3, 1.0, 0), (-1, 130, 0.0, 2, 0.0, 2, 0.0, 0), (-1, 30, 0.05, 3, 0.0, 3, 0.0, 0),
    (0, 70, 0.0, 8, 0.0, 65, 0.0, 1), (0, 65, 0.05, 70, 0.0, 40, 0.0, 1), (0, 40, 0.0, 65, 0.0, 90, 0.0, 1),
    (0, 90, 0.1, 40, 0.0, 12, 0.0, 1), (0, 24, 0.0, 55, 0.0, 60, 0.0, 1), (0, 18, 0.0, 60, 0.0, 48, 0.0, 1),
    (0, 12, 0.0, 48, 0.0, 52, 0.0, 1), (0, 9, 0.0, 52, 0.0, 75, 0.0, 1), (0, 30, 0.1, 20, 0.0, 20, 0.0, 1),
    (0, 5, 0.0, 75, 0.0, 58, 0.0, 1), (0, 50, 0.2, 6, 0.0, 4, 0.5, 1), (0, 110, 0.0, 3, 1.0, 3, 1.0, 1),
    (0, 35, 0.0, 8, 0.0, 6, 0.0, 1), (0, 26, 0.0, 10, 0.0, 40, 0.0, 1), (0, 8, 0.0, 30, 0.0, 70, 0.0, 1),
    (0, 1, 1.0, 1, 1.0, 1, 1.0, 0), (0, 2, 1.0, 1, 1.0, 3, 1.0, 0), (0, 3, 1.0, 2, 1.0, 60, 0.0, 0),
    (0, 4, 0.0, 3, 1.0, 2, 1.0, 0), (0, 10, 0.9, 4, 0.0, 8, 0.8, 0), (0, 25, 0.8, 10, 0.9, 12, 0.7, 0),
    (0, 7, 0.5, 60, 0.0, 3, 1.0, 0), (0, 6, 0.0, 2, 1.0, 3, 1.0, 0), (0, 8, 0.0, 6, 0.0, 4, 1.0, 0),
    (0, 3, 0.0, 5, 0.0, 4, 0.0, 0), (0, 5, 0.0, 3, 0.0, 0, 0.0, 0), (0, 11, 0.2, 4, 1.0, 0, 0.0, 0),
    (-0.5, 9, 0.0, 45, 0.0, 60, 0.0, 0), (-0.5, 14, 0.0, 2, 0.0, 2, 0.0, 0), (-0.5, 22, 0.0, 70, 0.0, 50, 0.0, 0),
    (-0.5, 38, 0.0, 12, 0.0, 25, 0.0, 0), (-0.5, 1, 1.0, 1, 1.0, 1, 1.0, 0), (-0.5, 12, 0.1, 80, 0.0, 0, 0.0, 0),
    (-0.5, 90, 0.7, 3, 1.0, 30, 0.9, 0), (-0.5, 60, 0.5, 5, 0.0, 4, 1.0, 0), (-0.5, 5, 0.0, 5, 0.0, 5, 0.0, 0),
    (-0.5, 62, 0.0, 8, 0.0, 65, 0.0, 1), (-0.5, 80, 0.05, 62, 0.0, 5, 0.0, 1), (-0.5, 120, 0.1, 3, 1.0, 3, 1.0, 1),
    (-0.5, 150, 0.0, 30, 0.0, 90, 0.0, 1), (-0.5, 70, 0.2, 0, 0.0, 0, 0.0, 1), (-0.5, 95, 0.0, 80, 0.0, 70, 0.0, 1),
    (1, 2, 0.0, 2, 0.0, 14, 0.0, 1), (1, 2, 0.0, 9, 0.3, 2, 0.0, 1), (1, 3, 0.0, 2, 0.0, 3, 1.0, 1),
    (1, 2, 0.0, 1, 1.0, 2, 0.0, 1), (1, 5, 0.0, 2, 0.0, 8, 0.4, 1), (1, 4, 0.0, 5, 0.0, 4, 0.0, 1),
    (1, 2, 0.0, 0, 0.0, 0, 0.0, 1), (1, 6, 0.5, 3, 1.0, 5, 0.0, 1), (1, 14, 0.0, 2, 1.0, 9, 0.0, 1),
    (1, 3, 0.0, 14, 0.0, 12, 0.0, 1), (1, 11, 0.9, 20, 0.0, 22, 0.0, 1), (1, 2, 1.0, 12, 0.0, 0, 0.0, 1),
    (-1, 26, 0.0, 0, 0.0, 0, 0.0, 0), (-1, 18, 0.0, 20, 0.0, 22, 0.0, 0), (-1, 60, 0.0, 3, 0.0, 1, 0.0, 0),
    (-1, 110, 0.0, 0, 0.0, 30, 0.0, 0), (-1, 15, 0.0, 15, 0.0, 15, 0.0, 0), (-1, 33, 0.1, 26, 0.0, 26, 0.0, 0),
    (-0.5, 26, 0.0, 0, 0.0, 0, 0.0, 0), (-0.5, 26, 0.0, 26, 0.0, 26, 0.0, 0), (-0.5, 16, 0.0, 14, 0.0, 12, 0.0, 0),
    (0, 1, 0.0, 0, 0.0, 0, 0.0, 0), (0, 4, 0.0, 0, 0.0, 0, 0.0, 0), (0, 2, 0.0, 50, 0.0, 0, 0.0, 0),
    (0, 4, 0.0, 26, 0.0, 0, 0.0, 0), (0, 3, 0.0, 15, 0.0, 0, 0.0, 0), (0, 6, 0.0, 90, 0.0, 0, 0.0, 0),
    (0, 26, 0.0, 0, 0.0, 0, 0.0, 1), (0, 12, 0.0, 0, 0.0, 0, 0.0, 1), (0, 26, 0.0, 3, 0.0, 1, 0.0, 1),
    (0, 26, 0.0, 1, 0.0, 0, 0.0, 1), (0, 3, 0.0, 0, 0.0, 26, 0.0, 1), (0, 1, 0.0, 26, 0.0, 1, 0.0, 1),
    (0, 1, 0.0, 1, 0.0, 26, 0.0, 1), (0, 14, 0.0, 16, 0.0, 12, 0.0, 1), (0, 16, 0.0, 12, 0.0, 14, 0.0, 1),
    (0, 12, 0.0, 14, 0.0, 0, 0.0, 1), (0, 13, 0.0, 0, 0.0, 15, 0.0, 1), (0, 20, 0.1, 18, 0.0, 22, 0.0, 1),
    (0, 2, 0.0, 4, 0.0, 5, 0.0, 0), (0, 12, 0.6, 8, 0.4, 9, 1.0, 0), (0, 40, 0.7, 4, 1.0, 30, 0.9, 0),
)


@dataclass(frozen=True)
class Tree:
    """``feature`` below 0 marks a leaf, whose decision is ``keep``."""

    feature: int
    threshold: float = 0.0
    low: Tree | None = None
    high: Tree | None = None
    keep: bool = False

    def decide(self, values: tuple[float, ...]) -> bool:
        node = self
        while node.feature >= 0:
            node = node.low if values[node.feature] <= node.threshold else node.high
        return node.keep


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 9) -> Tree:
    """A binary tree by Gini impurity; of equal splits the first feature and the lowest threshold win."""
    leaf = Tree(-1, keep=bool(labels.mean() >= 0.5))
    if depth == 0 or labels.min() == labels.max():
        return leaf
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for threshold in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] <= threshold
            cost = sum(side.sum() * (p := labels[side].mean()) * (1 - p) for side in (low, ~low))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, feature, threshold, low)
    if best is None:
        return leaf
    _, feature, threshold, low = best
    return Tree(
        feature, float(threshold), grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)
    )


def train(labelled: tuple = LABELLED) -> Tree:
    """Blocks in elements that name themselves are the most common by far, so their rows count four times."""
    data = np.array([row for row in labelled for _ in range(4 if abs(row[0]) == 1 else 1)], float)
    return grow(data[:, :-1], data[:, -1])


def _own_hint(tag: str, attributes: str) -> tuple[float, bool]:
    """The hint of an element, and whether content names inside it count although it is furniture by name."""
    if _HIDDEN.search(attributes):
        return -1, False
    names = [
        set(_NAME_PART.findall(name))
        for found in _HINT_ATTRIBUTE.findall(attributes)
        for name in "".join(found).lower().split()
    ]
    if tag in _CONTENT_TAGS:
        return (-1, False) if any(len(n) == 1 and n <= _STRICT_NAMES for n in names) else (1, False)
    names = [n for n in names if len(n) == 1 or not n & _STATE_NAMES]
    if tag == "header" and any(n & _ARTICLE_NAMES for n in names):
        return 1, False
    if tag in _FURNITURE_TAGS or any(n & _STRICT_NAMES for n in names):
        return -1, False
    furniture = [n for n in names if n & _FURNITURE_NAMES]
    if furniture and any(n <= _CONTENT_NAMES for n in names):
        return 0, False  # names itself both
    if furniture:
        return -0.5, not any(n <= _FURNITURE_NAMES for n in furniture)
    return (1 if any(n & _CONTENT_NAMES for n in names) else 0), False


def _leaf_hint(attributes: str) -> float:
    """The hint of a paragraph, list item, heading or span by its own names, as far as all of a name is furniture."""
    if _HIDDEN.search(attributes):
        return -1
    found = [set(_NAME_PART.findall(n)) for own in _HINT_ATTRIBUTE.findall(attributes) for n in "".join(own).lower().split()]
    names = [n for n in found if n and (len(n) == 1 or not n & _STATE_NAMES)]
    if any(n & _STRICT_NAMES for n in names):
        return -1
    return -0.5 if any(n <= _FURNITURE_NAMES for n in names) else 0


def _closes_itself(attributes: str) -> bool:
    return bool(_SELF_CLOSED.search(attributes)) and not _UNQUOTED_END.search(attributes)


def _has_end(page: str, tag: str, at: int) -> bool | None:
    """Whether an element whose start tag ends at ``at`` is closed, as those of its kind inside; None: no end follows."""
    depth, ended = 1, None
    for found in re.compile(rf"<(/?){tag}(?=[\s/>])({_ATTRIBUTES})>", re.I).finditer(page, at):
        if found.group(1):
            depth, ended = depth - 1, False
        elif tag != "svg" and tag != "template":
            return False  # cannot hold one of its kind
        elif not _closes_itself(found.group(2)):
            depth += 1
        if depth == 0:
            return True
    return ended


def blocks(page: str) -> list[tuple[str, int, int, float]]:
    """``(text, words, linked words, hint)`` of each text block, in page order."""
    found: list[tuple[str, int, int, float]] = []
    pieces: list[str] = []
    linked: list[str] = []
    # Tag, hint of what is inside, whether content names inside count although it is furniture (by a form or names),
    # whether its text is skipped.
    stack: list[tuple[str, float, bool, bool]] = []
    endless: set[str] = set()  # silent tags that no closing tag follows
    in_link = False
    own_hint = 0.0  # of the paragraph or the like that is open
    forms: list[tuple[int, int]] = []  # blocks that only a form around them makes furniture: number, words
    at = 0

    def text_until(end: int) -> None:
        if end > at and not (stack and stack[-1][3]):
            pieces.append(page[at:end])
            if in_link:
                linked.append(page[at:end])

    def close_block() -> None:
        nonlocal pieces, linked, own_hint
        if pieces:
            words = html.unescape("".join(pieces)).split()
            if words:
                links = len(html.unescape(" ".join(linked)).split()) if linked else 0
                hint = min(own_hint, stack[-1][1] if stack else 0) if own_hint else (stack[-1][1] if stack else 0)
                if hint == -1 and own_hint == 0 and _only_a_form(stack):
                    forms.append((len(found), len(words)))
                found.append((" ".join(words), len(words), min(links, len(words)), hint))
        pieces, linked, own_hint = [], [], 0.0

    def close_element(tag: str) -> None:
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] == tag:
                if stack[-1][3] and not stack[depth][3]:
                    close_block()  # a block ends where a silent element was left open in it
                del stack[depth:]
                break

    length = len(page)
    while at < length:
        match = _MARKUP.search(page, at)
        if match is None:
            text_until(length)
            break
        text_until(match.start())
        at = match.end()
        tag = match.group(3)
        if tag is None:
            raw = _RAW_NAME.match(match.group())
            if raw and not _closes_itself(match.group("raw")):
                end = re.compile(rf"</{raw.group(1)}\s*>", re.I).search(page, at)
                at = end.end() if end else length
            continue
        tag, closing = tag.lower(), bool(match.group(2))
        if tag == "a":
            in_link = not closing
        elif tag == "br":
            pieces.append(" ")
        elif tag == "span":
            if closing:
                if any(own[0] == "span" for own in stack):
                    close_block()
                    close_element(tag)
            elif stack and any(own[0] == "span" for own in stack):
                stack.append((tag, *stack[-1][1:]))
            elif not (stack and stack[-1][3]) and (own := _leaf_hint(match.group(4))) < 0:
                close_block()
                outer = stack[-1] if stack else ("", 0, False, False)
                stack.append((tag, min(own, outer[1]), outer[2], False))
        elif tag in _SILENT:
            if closing:
                close_element(tag)
            elif tag not in endless and not _closes_itself(match.group(4)):
                ended = _has_end(page, tag, at)
                if ended:
                    hint, open_to_names = (stack[-1][1], stack[-1][2]) if stack else (0, False)
                    stack.append((tag, hint, open_to_names, True))
                elif ended is None:
                    endless.add(tag)
        elif tag in _BLOCK:
            silent = bool(stack) and stack[-1][3]
            if not silent:
                close_block()
                in_link = False
            if tag not in _CONTAINER:
                if tag in _LEAF and not closing and not silent:
                    own_hint = _leaf_hint(match.group(4))
                continue
            if closing:
                close_element(tag)
            elif silent:
                stack.append((tag, *stack[-1][1:]))
            else:
                outer, open_to_names = (stack[-1][1], stack[-1][2]) if stack else (0, False)
                own, mixed = _own_hint(tag, match.group(4))
                if tag == "header" and outer == 1:
                    own = 0  # the heading of the article itself
                if own < 0 and (outer > -1 or (own > -1 and open_to_names)):
                    stack.append((tag, own, mixed or (tag == "form" and outer == 0), False))
                elif own > 0 and (outer >= 0 or open_to_names or (outer > -1 and tag in _CONTENT_TAGS)):
                    stack.append((tag, 1, False, False))
                elif own < 0:
                    stack.append((tag, -1, False, False))
                else:
                    stack.append((tag, outer, open_to_names, False))
    close_block()
    # A form that holds nearly all of a page is a frame around it.
    others = sum(words for i, (_, words, _, hint) in enumerate(found) if hint >= 0)
    if forms and sum(words for _, words in forms) > 2 * others:
        for i, _ in forms:
            found[i] = (*found[i][:3], 0)
    return found


def _only_a_form(stack: list[tuple[str, float, bool, bool]]) -> bool:
    """Whether the outermost furniture around is a form, and nothing inside it is furniture by itself."""
    hints = [(tag, hint) for tag, hint, _, _ in stack]
    first = next((i for i, (_, hint) in enumerate(hints) if hint < 0), None)
    if first is None or hints[first][0] != "form":
        return False
    return all(tag not in _FURNITURE_TAGS and hint == hints[first][1] for tag, hint in hints[first + 1 :])


def main_text(page: str | None, tree: Tree) -> str:
    if not page:
        return ""
    found = blocks(page)
    nothing = (0, 0.0)
    sizes = [nothing, *((words, links / words) for _, words, links, _ in found), nothing]
    kept = [
        text
        for i, (text, _, _, hint) in enumerate(found)
        if tree.decide((hint, *sizes[i + 1], *sizes[i], *sizes[i + 2]))
    ]
    return "\n\n".join(kept)


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; ``tree`` defaults to the one that ``LABELLED`` trains."""
    model = tree or train()

    def run(parts: Iterator[dict[str, list]]) -> Iterator[dict]:
        for part in parts:
            texts = [main_text(page, model) for page in part["html"]]
            yield {"page_id": part["page_id"], "url": part["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(pages, ["page_id", "url", "html"], run, _SCHEMA)
