"""Main text of web pages by a minimum cut.

A page becomes blocks of text. What speaks for or against a block is its cost of being called
boilerplate or content, the capacity to either terminal; neighbours in page order and in the
document tree are tied by smoothness edges. The minimum cut is the cheapest labelling.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names that HTML gives a meaning.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
UNSEEN = frozenset(
    "head template noscript svg math select option button object audio video canvas map datalist dialog".split()
)
AWAY = frozenset("nav aside footer menu".split())
WRAPPING = frozenset("form header fieldset".split())
MAIN = frozenset("article main".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header"
    " hr main menu nav ol p pre section table ul".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td dd dt figcaption".split())
# Words in class, id or role. The first always speak against a block, the others only where no
# article or main element lies between: wrappers of a whole page carry such names too.
ADVERTS = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promoted".split())
REPLIES = frozenset("comment comments commentlist reply replies respond disqus".split())
AGAINST = ADVERTS | REPLIES | frozenset(
    "promo promotion cookie cookies consent gdpr alert alertdialog"
    " popup modal overlay newsletter subscribe subscription share sharing social complementary contentinfo".split()
)
AGAINST_OUTSIDE = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar rail widget widgets related recommended recommendations"
    " footer header masthead banner notice notices notification copyright legal disclaimer search login signin signup"
    " register pagination pager toolbar topbar form skip hidden".split()
)
ARTICLE_NAMES = frozenset("article post entry story content body text".split())
AWAY_NAMES = frozenset("nav menu sidebar widget widgets related recommended form footer notice search copyright".split())
LAYOUT_NAMES = frozenset("has with no layout wrapper wrap container".split())
PAGE_NAMES = frozenset("page site layout wrapper root app outer".split())
EDGE_NAMES = frozenset("header footer nav menu banner notice".split())
# A name that tells a state, not what an element is: "no-ads", "has-comments", "modal-open".
BEFORE_STATE = frozenset("has have no not non with without is are hide show shows allow allows enable disable".split())
AFTER_STATE = frozenset("enabled disabled open opened closed active inactive on off free visible loaded ready allowed count status".split())

# Costs, in nats. What a block itself says lies between about -9 and 5; a tie between neighbours is of the
# size of a sentence more or less, so that in pages without telling names the cut decides by the neighbours.
FAR_AGAINST = 12.0
IN_MAIN = 4.0
TIE = 2.0

_TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*?)>""", re.S
)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORDS = re.compile(r"\S+")
_RIGHTS = re.compile(r"(?:©|\(c\)|copyright\b|all rights reserved)", re.I)


@dataclass(eq=False)
class Element:
    name: str
    parent: Element | None = field(default=None, repr=False)
    depth: int = 0
    against: float = 0.0
    main: bool = False
    # Whether the cost holds for an article below as well.
    fixed: bool = False


@dataclass
class Block:
    text: str
    linked: int
    under: Element | None = field(repr=False)


def _names(value: str) -> Iterator[set[str]]:
    """The words of each whole name of an attribute; names of a state have none."""
    for token in value.split():
        words = [w.lower() for w in _NAME.findall(token)]
        if len(words) > 1 and (words[0] in BEFORE_STATE or words[-1] in AFTER_STATE):
            continue
        yield set(words)


def _judge(name: str, attributes: str, under: Element | None) -> Element:
    """The element with the cost of what lies in it being called content, and whether it is in the main part."""
    made = Element(name, under, under.depth + 1 if under else 0)
    if under:
        made.against, made.main, made.fixed = under.against, under.main, under.fixed
    if made.fixed and made.against >= FAR_AGAINST:
        return made
    tokens: list[set[str]] = []
    for m in _ATTRIBUTE.finditer(attributes or ""):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key in ("class", "id", "role"):
            tokens += _names(value)
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and _HIDDEN.search(value)):
            made.against, made.fixed = FAR_AGAINST, True
            return made
    names = set().union(*tokens)
    if name in AWAY:
        made.against, made.fixed = FAR_AGAINST, True
        return made
    if name in ("html", "body"):
        return made
    told = ADVERTS | REPLIES
    if name == "article" and any(t & told for t in tokens):
        # A reader's comment may be an article of its own, and so may an advert.
        made.against, made.fixed = FAR_AGAINST, True
        return made
    if name in MAIN or "main" in names:
        # Names of wrappers above the main part say nothing about it.
        made.against, made.main = 0.0, True
        return made
    if made.against >= FAR_AGAINST:
        return made
    page_wide = not made.main and any(t & PAGE_NAMES and not t & (AGAINST | EDGE_NAMES) for t in tokens)
    if names & (told if page_wide else AGAINST):
        made.against, made.fixed = FAR_AGAINST, bool(names & told)
    elif (name == "header" and made.main) or page_wide or (names & LAYOUT_NAMES and not names & EDGE_NAMES):
        pass
    elif names & ARTICLE_NAMES and not names & AWAY_NAMES:
        made.against = 0.0
    elif name in WRAPPING or names & AGAINST_OUTSIDE:
        made.against = FAR_AGAINST if made.main else FAR_AGAINST / 2
    return made


def blocks_of(page: str) -> list[Block]:
    """The visible blocks of a page in order, each with the elements it lies in."""
    out: list[Block] = []
    stack: list[Element] = []
    pieces: list[str] = []
    linked = 0
    in_link = unseen = 0
    open_names: Counter[str] = Counter()

    def end_block() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, linked, stack[-1] if stack else None))
            pieces.clear()
        linked = 0

    def leave(first: int) -> None:
        """Close the elements of the stack from a place on."""
        nonlocal unseen
        for e in stack[first:]:
            open_names[e.name] -= 1
            unseen -= e.name in UNSEEN
        del stack[first:]

    def say(text: str) -> None:
        nonlocal linked
        if text and not unseen:
            pieces.append(text)
            if in_link:
                linked += len(text)

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            say(page[at:])
            break
        if start > at:
            say(page[at:start])
        m = _TOKEN.match(page, start)
        if m is None:
            following = page[start + 1 : start + 2]
            if not (following.isascii() and following.isalpha()) and not re.match(r"</[a-zA-Z]", page[start : start + 3]):
                say("<")
                at = start + 1
                continue
            m = _LOOSE.match(page, start)  # a quote that never ends
            if m is None:
                break  # a tag that never ends
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if name == "a":
                in_link = 0
            if name in INLINE:
                continue
            if open_names[name]:
                end_block()
                leave(next(k for k in range(len(stack) - 1, -1, -1) if stack[k].name == name))
            elif name in ("br", "p"):
                end_block()
            continue
        if name in RAW:
            if not m[3].endswith("/") or name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = close.end() if close else size
            continue
        if name == "a":
            in_link = 1
        if name == "br":
            say(" ")
            continue
        if name in INLINE:
            continue
        end_block()
        if name in VOID:
            continue
        if name in CLOSES_P and stack and stack[-1].name == "p":
            leave(len(stack) - 1)
        elif name in ("li", "td", "th", "tr", "dd", "dt", "option") and stack and stack[-1].name == name:
            leave(len(stack) - 1)
        elif name == "body" and unseen:
            leave(next(k for k, e in enumerate(stack) if e.name in UNSEEN))
        stack.append(_judge(name, m[3], stack[-1] if stack else None))
        open_names[name] += 1
        unseen += name in UNSEEN
    end_block()
    return out


def evidence(block: Block) -> float:
    """Cost of calling a block boilerplate, less that of calling it content."""
    under = block.under
    words = len(_WORDS.findall(block.text))
    share = min(1.0, block.linked / max(len(block.text), 1))
    value = min(3.0, (words - 8) / 8) - 6.0 * share * (1.0 if words < 40 else 0.5)
    if block.text[-1] in ".!?:;\"'”»…":
        value += 0.7
    if under and under.name in PROSE:
        value += 0.6
    if under and under.name in ("h1", "h2", "h3"):
        value += 0.8
    if _RIGHTS.match(block.text) and words < 30 and not (under and under.main):
        value -= 4.0
    if under:
        value += IN_MAIN * under.main - under.against
    return value


def _distance(a: Element | None, b: Element | None) -> int:
    """Steps in the document tree between two elements."""
    steps = 0
    while a is not b:
        if b is None or (a is not None and a.depth >= b.depth):
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Ties between neighbours in page order, and between a block and the next in the same parent.

    All steps between neighbours together are no more than the tags of the page.
    """
    out = []
    last: dict[int, int] = {}
    for k, block in enumerate(blocks):
        if k:
            out.append((k - 1, k, TIE / (1 + 0.5 * _distance(blocks[k - 1].under, block.under))))
        parent = id(block.under.parent) if block.under and block.under.parent else 0
        before = last.get(parent)
        if before is not None and before != k - 1:
            out.append((before, k, TIE / (1 + 0.5 * _distance(blocks[before].under, block.under))))
        last[parent] = k
    return out


# --- minimum cut ---------------------------------------------------------------------------


def min_cut(unary: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each node whether it is on the source side of the cheapest cut.

    unary is the capacity from the source, or, negative, to the sink. Nodes that outweigh all their
    ties are settled at once, which moves their ties to the neighbours; maximum flow decides the rest.
    """
    n = len(unary)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
    value = list(unary)
    free = [sum(w for _, w in x) for x in near]
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        k = todo.popleft()
        if side[k] is not None or abs(value[k]) < free[k] or (value[k] == 0 and free[k] > 0):
            continue
        side[k] = value[k] > 0
        for other, w in near[k]:
            if side[other] is None:
                value[other] += w if side[k] else -w
                free[other] -= w
                todo.append(other)
    rest = [k for k in range(n) if side[k] is None]
    if rest:
        place = {k: i for i, k in enumerate(rest)}
        inner = [(place[a], place[b], w) for a, b, w in edges if a in place and b in place]
        for k, s in zip(rest, _max_flow_side([value[k] for k in rest], inner), strict=True):
            side[k] = s
    return [bool(s) for s in side]


def _max_flow_side(unary: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Shortest augmenting paths, then what the source still reaches."""
    n = len(unary)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for k, v in enumerate(unary):
        if v > 0:
            join(source, k, v, 0.0)
        elif v < 0:
            join(k, sink, -v, 0.0)
    for a, b, w in edges:
        join(a, b, w, w)
    while True:
        via = [-1] * (n + 2)
        via[source] = -2
        queue = deque([source])
        while queue and via[sink] == -1:
            k = queue.popleft()
            for e in out[k]:
                if room[e] > 1e-12 and via[to[e]] == -1:
                    via[to[e]] = e
                    queue.append(to[e])
        if via[sink] == -1:
            return [via[k] != -1 for k in range(n)]
        path, k = [], sink
        while k != source:
            path.append(via[k])
            k = to[via[k] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push


def main_text(page: str | None) -> str:
    """The content blocks of a page, joined by one space; empty if there are none."""
    blocks = blocks_of(page or "")
    keep = min_cut([evidence(b) for b in blocks], edges_of(blocks))
    return " ".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: (id, url, text, n_chars); null and empty pages have empty text. Rows that repeat are kept.
    The work on a page grows with its length, also where it is one element in another thousands of times."""

    def run(batches):
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [id_col, url_col, "text", "n_chars"],
            )

    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).alias("_html"))
    kinds = [rows.schema[k].dataType.simpleString() for k in (0, 1)]
    return rows.mapInArrow(run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars bigint")
