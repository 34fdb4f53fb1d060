"""Main text of web pages: blocks labelled content or boilerplate by a minimum cut."""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm.arrow import slices

#: Pages that the text classifier is fitted on, about, by a hash of their id and url: the bound of the fit.
TRAIN_PAGES = 1000
#: Weight of an edge between neighbours in the page, and between blocks of one parent.
ADJACENT, SIBLING = 0.4, 0.8
#: What the element a block lies in says, in log-odds of content; the text classifier adds at most TEXT_LIMIT. Names are hints, which
#: text and neighbours together can outweigh; what is no text of the page at all (CERTAIN) stays out.
INSIDE, OUTSIDE, CERTAIN, TEXT_LIMIT = 3.0, -3.0, -9.0, 2.0
#: A hint around so much of a page's text is about its layout.
MOST = 0.6

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<title\s*/>"  # as in <svg>, where it has no end tag
    r"|<(?P<raw>script|style|noscript|template|iframe|textarea|select|title)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)[^>]*>"
    r"|<[!?][^>]*>"
    r"|<[a-zA-Z/!?][^>]*\Z",
    re.S | re.I,
)
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end when another of the set starts in the same parent.
CLOSES = {"p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
BAD_TAGS = frozenset("header form fieldset".split())
CERTAIN_TAGS = frozenset("nav footer aside menu button dialog head".split())
GOOD_TAGS = frozenset("article main".split())
BAD_NAMES = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer discussion feedback "
    "footer form header login masthead menu modal nav navbar navigation newsletter notice notices overlay pagination popup promo promoted "
    "recommended related replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar warning widget".split()
)
GOOD_NAMES = frozenset("article body content entry main maincontent post story text".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form menu alert dialog".split())
CERTAIN_NAMES = frozenset("comment comments discussion feedback replies reply".split())
#: With one of these a name speaks of the layout around, or of what is not there.
LAYOUT_PARTS = frozenset("has no not with without is js".split())
#: Parts that may follow a name of boilerplate: a list of comments is comments.
HOLDERS = frozenset("area bar block body bottom box container content group holder inner items item left links list main panel region right row section top widget wrap wrapper".split())
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass
class Element:
    name: str
    cue: int  # 1 content, 0 nothing known, -1 boilerplate by a hint, -2 for certain
    number: int
    hint: int = 0  # the element that the hint comes from


@dataclass
class Block:
    parent: int
    cue: int
    name: str
    hint: int
    pieces: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.pieces)).split())


def attributes(text: str) -> dict[str, str]:
    """Names, in lower case, with their values; of a repeated name the first counts."""
    found: dict[str, str] = {}
    for key, value in ATTRIBUTE.findall(text):
        found.setdefault(key.lower(), html.unescape(value.strip("\"'")))
    return found


def named(word: str, names: frozenset[str]) -> bool:
    """Whether an id or class speaks of the element itself by one of the names: as its last part, or as its first before a holder."""
    parts = [p.lower() for p in NAME_PART.findall(word)]
    if not parts or not LAYOUT_PARTS.isdisjoint(parts):
        return False
    return parts[-1] in names or parts[0] in names and parts[-1] in HOLDERS


def cue_of(name: str, attrs: str) -> int:
    """What an element's name, role, id and classes say of its content."""
    if name in CERTAIN_TAGS:
        return -2
    got = attributes(attrs) if attrs.strip() else {}
    if "hidden" in got or got.get("aria-hidden", "").strip().lower() == "true" or HIDDEN_STYLE.search(got.get("style", "")):
        return -2
    words = [got.get("id", "").strip(), *got.get("class", "").split()]
    if any(named(w, CERTAIN_NAMES) for w in words):
        return -2
    role = got.get("role", "").strip().lower()
    if name in GOOD_TAGS or role == "main":
        return 1
    if role in BAD_ROLES or name in BAD_TAGS:
        return -1
    if name != "body" and any(named(w, BAD_NAMES) for w in words):
        return -1
    return int(any(named(w, GOOD_NAMES) for w in words))


def blocks_of(page: str) -> list[tuple[Block, str]]:
    """Runs of text between block elements, in page order, each with its text; blocks without text are left out.

    Elements that are never closed end with the element around them, as browsers do it. A line break is white space.
    """
    stack = [Element("", 0, 0)]
    made = 0
    found: list[Block] = []
    block: Block | None = None
    links = 0
    at = 0

    def add(piece: str) -> None:
        nonlocal block
        if block is None:
            block = Block(stack[-1].number, stack[-1].cue, stack[-1].name, stack[-1].hint)
            found.append(block)
        block.pieces.append(piece)
        if links:
            block.linked += len(piece)

    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        closing = bool(m["end"] or m["end2"])
        if name == "br":
            if block is not None:
                add(" ")
        elif name == "a":
            links = 0 if closing else 1
        elif name in BLOCKS:
            block, links = None, 0
            if closing:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name == name:
                        del stack[k:]
                        break
            elif name not in VOID:
                while len(stack) > 1 and name in CLOSES.get(stack[-1].name, ()):
                    stack.pop()
                made += 1
                stack.append(within(stack[-1], Element(name, cue_of(name, m["attrs"] or ""), made)))
    if at < len(page):
        add(page[at:])
    told = [(b, t) for b in found if (t := b.text())]
    # a hint around most of the text says nothing of it
    size: dict[int, int] = {}
    for b, t in told:
        if b.cue == -1:
            size[b.hint] = size.get(b.hint, 0) + len(t)
    whole = sum(len(t) for b, t in told if b.cue > -2)
    for b, _ in told:
        if b.cue == -1 and size[b.hint] > MOST * whole and len(told) > 1:
            b.cue = 0
    return told


def within(outer: Element, element: Element) -> Element:
    """An element with what those around it say: certainty holds for all inside; a mark of content ends a hint from outside."""
    if outer.cue == -2:
        element.cue = -2
    elif element.cue == 0:
        element.cue, element.hint = outer.cue, outer.hint
    elif element.cue == -1:
        element.hint = outer.hint if outer.cue == -1 else element.number
    return element


def features(block: Block, text: str) -> np.ndarray:
    n = len(text)
    return np.array([
        1.0, np.log1p(n), min(1.0, block.linked / n), sum(map(text.count, ".,;:!?")) / n, np.log1p(text.count(" ")),
        float(block.name in ("p", "pre", "blockquote")), float(block.name == "li"), float(block.name[:1] == "h" and block.name[1:].isdigit()),
    ])


WIDTH = 8


def minimum_cut(odds: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Labels (true: source side) of a minimum cut: ``odds`` are the capacities from the source, or to the sink where negative.

    A node whose capacity exceeds all its edges has its label in every minimum cut; such nodes are settled first and
    hand their edges on as capacities. Maximum flow, by shortest augmenting paths, decides the rest.
    """
    n = len(odds)
    odds = odds.astype(float).copy()
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    label = np.zeros(n, bool)
    open_ = [True] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if open_[i] and abs(odds[i]) >= sum(near[i].values()):
            open_[i], label[i] = False, odds[i] > 0
            for j, w in near[i].items():
                del near[j][i]
                odds[j] += w if label[i] else -w
                todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if open_[i]]
    if not rest:
        return label
    source, sink = n, n + 1
    flow: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest} | {source: {}, sink: {}}
    for i in rest:
        a, b = (source, i) if odds[i] > 0 else (i, sink)
        flow[a][b] = abs(odds[i])
        flow[b].setdefault(a, 0.0)
    while True:
        back = {source: source}
        queue = deque([source])
        while queue and sink not in back:
            i = queue.popleft()
            for j, c in flow[i].items():
                if c > 1e-9 and j not in back:
                    back[j] = i
                    queue.append(j)
        if sink not in back:
            break
        path, j = [], sink
        while j != source:
            path.append((back[j], j))
            j = back[j]
        least = min(flow[i][j] for i, j in path)
        for i, j in path:
            flow[i][j] -= least
            flow[j][i] = flow[j].get(i, 0.0) + least
    for i in rest:
        label[i] = i in back
    return label


def main_text(page: str, weights: np.ndarray | None = None) -> str:
    """Blocks on the content side of the cut, in page order, joined by a line feed.

    Capacities: what the elements around a block say, and a linear classifier of its text. Smoothness: every block with
    the next in the page and with the next of the same parent.
    """
    blocks = blocks_of(page)
    if not blocks:
        return ""
    odds = np.zeros(len(blocks))
    known = any(b.cue > 0 for b, _ in blocks)
    for i, (b, t) in enumerate(blocks):
        text = 0.0 if weights is None else float(np.clip(features(b, t) @ weights, -TEXT_LIMIT, TEXT_LIMIT))
        # in a page that marks its content, what lies outside is less likely to be some
        odds[i] = text + (INSIDE if b.cue > 0 else CERTAIN if b.cue < -1 else OUTSIDE if b.cue < 0 else -INSIDE / 2 if known else 1.0)
    edges = [(i, i + 1, ADJACENT) for i in range(len(blocks) - 1)]
    last: dict[int, int] = {}
    for i, (b, _) in enumerate(blocks):
        if b.parent in last:
            edges.append((last[b.parent], i, SIBLING))
        last[b.parent] = i
    keep = minimum_cut(odds, edges)
    return "\n".join(t for (_, t), k in zip(blocks, keep, strict=True) if k)


def fit_text(pages: DataFrame, most: int = TRAIN_PAGES) -> np.ndarray:
    """A linear discriminant between blocks that elements mark as content and as boilerplate, from a bounded sample of pages.

    Executors return a class's count, sums and products of features for each batch. Without both classes there is nothing to learn.
    """
    every = max(1, pages.count() // most)
    sample = pages.where(F.col("html").isNotNull() & (F.pmod(F.xxhash64("page_id", "url"), F.lit(every)) == 0)).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for sign in (-1, 1):
                x = [features(b, t) for page in batch.column(0) for b, t in blocks_of(page.as_py()) if b.cue and (b.cue > 0) == (sign > 0)]
                if x:
                    x = np.array(x)
                    yield pa.RecordBatch.from_pydict({"sign": pa.array([sign], pa.int32()), "n": [len(x)], "sums": [x.sum(0).tolist()], "squares": [(x.T @ x).ravel().tolist()]})

    rows = sample.mapInArrow(run, "sign int, n long, sums array<double>, squares array<double>").collect()
    n = {s: sum(r["n"] for r in rows if r["sign"] == s) for s in (-1, 1)}
    if not n[-1] or not n[1]:
        return np.zeros(WIDTH)
    mean = {s: np.sum([r["sums"] for r in rows if r["sign"] == s], axis=0) / n[s] for s in n}
    second = np.sum([r["squares"] for r in rows], axis=0).reshape(WIDTH, WIDTH)
    spread = (second - sum(n[s] * np.outer(mean[s], mean[s]) for s in n)) / (n[1] + n[-1])
    w = np.linalg.solve(spread[1:, 1:] + 0.01 * np.eye(WIDTH - 1), (mean[1] - mean[-1])[1:])
    return np.concatenate([[-(w @ (mean[1] + mean[-1])[1:]) / 2], w])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; the text is empty if nothing is content, or html is null.

    White space inside a block, line breaks included, becomes one space; character references are decoded. Repeated rows
    are each extracted. Other columns are ignored.
    """
    weights = fit_text(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(page.as_py() or "", weights) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", F.col("html").cast("string")).mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
