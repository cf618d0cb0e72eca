"""Main text of web pages by minimum cut.

A page becomes a row of text blocks. A logistic classifier on the look of a block (length, links,
punctuation, tag, place), and the names of the elements around it, give the cost of calling the block
content and the cost of calling it boilerplate: the capacities of its edges to the two terminals.
Blocks that follow each other, and blocks under one parent, are joined by edges that cost the less the
further apart the blocks are in the document tree. The minimum cut, found by maximum flow, is the
labelling of least total cost.

The classifier is trained without labels: blocks inside elements of telling names are its examples.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements of raw text, which only their end tag ends, and other elements whose content is no text of the page.
RAW = {"script", "style", "title", "textarea"}
MUTE = {"noscript", "template", "head", "svg", "iframe", "object", "select", "canvas", "audio", "video"}
#: Of these, the elements that can hold one of their own kind.
_NESTING = {"template", "svg", "object"}
#: Elements that begin and end a block of text.
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html",
    "label", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
#: Elements and words of class, id and role that tell boilerplate, and those that tell content.
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "search", "fieldset", "label", "option"}
BOILERPLATE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary",
    "consent", "contentinfo", "cookie", "cookies", "discussion", "disqus", "footer", "form", "header", "hidden", "login", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo", "promoted", "related",
    "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored",
    "subscribe", "toolbar", "warning", "widget", "widgets",
}
CONTENT_WORDS = {"article", "articlebody", "content", "entry", "main", "post", "story"}
_CLOSES_P = BLOCKS - {"button", "label", "option", "caption", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
_CLOSES_SAME = {"li", "dt", "dd", "option", "tr", "td", "th"}

_TOKEN = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>)", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|aria-hidden|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I | re.A) for tag in RAW}
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SENTENCE = re.compile(r"[.!?…][\"'»”)]*(?:\s|$)")


class Tree:
    """The elements of a page, 0 for the page itself: parent and depth of each."""

    def __init__(self) -> None:
        self.parent, self.depth = [0], [0]

    def add(self, parent: int) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        return len(self.parent) - 1

    def steps(self, a: int, b: int, most: int = 64) -> int:
        """Edges between two elements, as far as `most`: further apart makes no difference to a cut."""
        n = 0
        while a != b and n < most:
            if self.depth[a] >= self.depth[b]:
                a = self.parent[a]
            else:
                b = self.parent[b]
            n += 1
        return n


@dataclass(slots=True)
class Block:
    text: str
    node: int
    tree: Tree
    tag: str
    hint: int
    linked: int
    features: list[float] = field(default_factory=list)


def _hint(tag: str, attributes: str, inside: int) -> int:
    """-1 for boilerplate, 1 for content, else what the parent says."""
    names: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            names.add("hidden")
        elif name == "style":
            if "display:none" in value.replace(" ", "").lower():
                names.add("hidden")
        elif name in ("class", "id", "role"):
            names.update(_NAME.findall(_CAMEL.sub(" ", value).lower()))
    if tag in BOILERPLATE_TAGS or names & BOILERPLATE_WORDS or tag == "header" and inside != 1:
        return -1
    if tag in ("article", "main") or names & CONTENT_WORDS:
        return 1 if inside != -1 or tag == "main" else -1
    return inside


def _after_raw(page: str, tag: str, at: int) -> int:
    """Where the end tag of a raw element starts, or the end of the page."""
    end = _RAW_END[tag].search(page, at)
    return end.start() if end else len(page)


def _after_mute(page: str, end: int, tag: str, at: int, around: Collection[str]) -> tuple[int | None, int]:
    """Where a mute element of an end tag of its own ends, else None; and how far the page was searched.

    It has none when its kind, which cannot hold itself, or the body starts first, or an element `around` it ends.
    """
    depth, inner = 1, []
    while match := _TOKEN.search(page, at, end):
        at = match.end()
        name = (match[2] or "").lower()
        if name in RAW and not match[1] and not match[3].endswith("/"):
            at = _after_raw(page, name, at)
        elif name == tag:
            if match[1]:
                depth -= 1
                if not depth:
                    return at, at
            elif tag not in _NESTING:
                return None, match.start()
            elif not match[3].endswith("/"):
                depth += 1
        elif name in BLOCKS and name not in VOID:
            if name == "body" and not match[1]:
                return None, match.start()
            if not match[1]:
                inner.append(name)
            elif name in inner:
                while inner.pop() != name:
                    pass
            elif name in around:
                return None, match.start()
    return None, len(page)


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page in order, with character references decoded and white space made single.

    Time and memory grow with the length of the page, however it is nested or broken.
    """
    out: list[Block] = []
    if not page:
        return out
    stack: list[tuple[str, int, int]] = []  # tag, number of the element, hint
    parts: list[str] = []
    linked = in_link = at = 0
    tree, around = Tree(), Counter()  # around: open elements by tag
    # No tag ends later, so nothing is searched for its end there.
    last = page.rfind(">") + 1
    mute = ""  # the open element without text of its own: head, or one without its end tag
    searched: dict[str, int] = {}

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                tag = stack[-1][0] if stack else ""
                node, hint = stack[-1][1:] if stack else (0, 0)
                out.append(Block(text, node, tree, tag, hint, min(linked, len(text))))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not mute:
            parts.append(text)
            if in_link:
                linked += len(text)

    def close(tag: str) -> None:
        if around[tag]:
            flush()
            while stack:
                closed = stack.pop()[0]
                around[closed] -= 1
                if closed == tag:
                    return

    while match := _TOKEN.search(page, at, last):
        add(page[at : match.start()])
        at = match.end()
        if at == last and match[0][:2] in ("<!", "<?") and not match[0].endswith("-->" if match[0][:4] == "<!--" else ">"):
            at = len(page)  # a comment without its end
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if tag in RAW:
            if not match[1] and not match[3].endswith("/"):
                at = _after_raw(page, tag, at)
            continue
        if tag in MUTE:
            if match[1]:
                mute = "" if mute == tag else mute
            elif tag == "head":
                mute = tag
            elif not match[3].endswith("/"):
                # A part of the page that was searched in vain is not searched again.
                end = None
                if at >= searched.get(tag, 0):
                    end, searched[tag] = _after_mute(page, last, tag, at, +around)
                if end is None:
                    mute = tag
                else:
                    at = end
            continue
        if mute and tag in BLOCKS and not (mute == "select" and tag == "option"):
            # A block starts, or the parent ends: end tags that close nothing do not count.
            if not match[1] or around[tag]:
                mute = ""
        if tag == "a":
            in_link = 0 if match[1] else 1
        elif tag == "br":
            add(" ")
        elif tag in BLOCKS:
            if match[1]:
                close(tag)
                flush()
                continue
            if tag in _CLOSES_P and stack and stack[-1][0] == "p":
                close("p")
            if tag in _CLOSES_SAME and stack and stack[-1][0] == tag:
                close(tag)
            flush()
            if tag not in VOID:
                parent, inside = stack[-1][1:] if stack else (0, 0)
                stack.append((tag, tree.add(parent), _hint(tag, match[3], inside)))
                around[tag] += 1
    rest = page[at:]
    add(rest[: opened.start()] if (opened := re.search("<[!?]", rest)) else rest)
    flush()
    n = len(out)
    for i, b in enumerate(out):
        words = b.text.count(" ") + 1
        b.features = [
            1.0, math.log1p(words), b.linked / len(b.text), float(bool(_SENTENCE.search(b.text))), float(words < 4),
            float(b.tag == "p"), float(b.tag in ("li", "td", "th", "dd", "dt")), float(b.tag[:1] == "h" and b.tag[1:].isdigit()),
            abs(2 * (i + 0.5) / n - 1) ** 2,
        ]
    return out


#: Weights of the features where there are no examples to train on.
DEFAULT_WEIGHTS = (-1.5, 0.7, -4.0, 1.0, -0.5, 1.0, -0.5, 0.5, -0.5)


@dataclass(frozen=True)
class Cut:
    """Parameters. `train_pages` bounds the pages to train on.

    A telling name weighs `hint`, about as much as the look of a block at most does; the edges of a block to
    its neighbours can outweigh both. An edge to the block before costs `follows` * `decay` ** steps in the
    document tree, one to the last block under the same parent `siblings`.
    """

    train_pages: int = 2000
    hint: float = 3.0
    follows: float = 1.5
    siblings: float = 0.75
    decay: float = 0.5


def _max_flow_side(n: int, source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each node, whether it stays on the source's side of a minimum cut (Dinic's maximum flow)."""
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def edge(a: int, b: int, there: float, back: float) -> None:
        head[a].append(len(to))
        head[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for i in range(n):
        flow = min(source[i], sink[i])  # goes straight through
        edge(s, i, source[i] - flow, 0.0)
        edge(i, t, sink[i] - flow, 0.0)
    for a, b, w in edges:
        edge(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s], queue = 0, [s]
        for a in queue:
            for e in head[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        nxt = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(i for i, e in enumerate(path) if room[e] <= tiny)
                a = to[path[k] ^ 1]
                del path[k:]
                continue
            while nxt[a] < len(head[a]):
                e = head[a][nxt[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                nxt[a] += 1
            if nxt[a] < len(head[a]):
                path.append(head[a][nxt[a]])
                a = to[path[-1]]
            elif path:
                e = path.pop()
                a = to[e ^ 1]
                nxt[a] += 1
            else:
                break


def label_blocks(blocks: list[Block], weights: np.ndarray, cut: Cut) -> list[bool]:
    """Whether each block is content, by minimum cut."""
    n = len(blocks)
    logit = np.array([b.features for b in blocks]) @ weights + cut.hint * np.array([b.hint for b in blocks])
    logit = np.clip(logit, -30, 30)
    # Cost of calling a block boilerplate, and of calling it content.
    as_boilerplate, as_content = np.logaddexp(0, logit).tolist(), np.logaddexp(0, -logit).tolist()
    edges: list[tuple[int, int, float]] = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, cut.follows * cut.decay ** b.tree.steps(blocks[i - 1].node, b.node)))
        parent = b.tree.parent[b.node]
        if (j := last.get(parent, i)) < i - 1:
            edges.append((j, i, cut.siblings))
        last[parent] = i
    # A block whose own preference outweighs all of its edges keeps it in every minimum cut.
    pull = [0.0] * n
    for a, b, w in edges:
        pull[a] += w
        pull[b] += w
    fixed = [abs(x - y) > p for x, y, p in zip(as_boilerplate, as_content, pull)]
    out = [x > y for x, y in zip(as_boilerplate, as_content)]
    if all(fixed):
        return out
    place = {i: k for k, i in enumerate(i for i in range(n) if not fixed[i])}
    source, sink = [as_boilerplate[i] for i in place], [as_content[i] for i in place]
    inner = []
    for a, b, w in edges:
        if fixed[a] and fixed[b]:
            continue
        if fixed[a] or fixed[b]:
            free, held = (b, a) if fixed[a] else (a, b)
            (source if out[held] else sink)[place[free]] += w
        else:
            inner.append((place[a], place[b], w))
    for i, side in zip(place, _max_flow_side(len(place), source, sink, inner)):
        out[i] = side
    return out


def main_text(page: str | None, weights: np.ndarray, cut: Cut = Cut()) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    return "\n".join(b.text for b, keep in zip(blocks, label_blocks(blocks, weights, cut)) if keep)


def fit_weights(rows: list[list[float]], labels: list[int], steps: int = 25, ridge: float = 0.02) -> np.ndarray:
    """Logistic regression by Newton steps, each class weighing the same; `ridge` is a penalty per row."""
    x, y = np.array(rows), np.array(labels, dtype=float)
    share = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    w, ridge = np.zeros(x.shape[1]), ridge * len(x)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + ridge * w
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(curve, gradient)
    return w


def train(pages: DataFrame, cut: Cut = Cut()) -> np.ndarray:
    """Weights of the block classifier, from at most `train_pages` pages: the first by a hash of their id."""
    chosen = pages.select("page_id").filter("page_id IS NOT NULL").orderBy(F.xxhash64("page_id"), "page_id").limit(cut.train_pages)
    # At most train_pages ids: a bounded side.
    sample = pages.select("page_id", "html").join(F.broadcast(chosen.distinct()), "page_id")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, labels = [], []
            for page in batch.column("html"):
                for b in blocks_of(page.as_py()):
                    if b.hint:
                        rows.append(b.features)
                        labels.append(int(b.hint > 0))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.int32())], names=["x", "y"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for batch in batches:
            rows += batch.column("x").to_pylist()
            labels += batch.column("y").to_pylist()
        w = fit_weights(rows, labels) if 0 < sum(labels) < len(labels) else np.array(DEFAULT_WEIGHTS)
        yield pa.RecordBatch.from_pydict({"w": pa.array([w.tolist()], pa.list_(pa.float64()))})

    examples = sample.select("html").mapInArrow(sums, "x array<double>, y int")
    # A fixed order, so that a rerun sums alike. The pages are bounded, and so are their blocks.
    examples = examples.repartition(1).sortWithinPartitions("y", "x")
    row = examples.mapInArrow(fit, "w array<double>").first()
    return np.array(DEFAULT_WEIGHTS if row is None else row.w)


def extracted(pages: DataFrame, cut: Cut = Cut()) -> DataFrame:
    """page_id, url, text, n_chars for every row of `pages`.

    Null, empty and broken pages have what text they have, at least the empty string. Repeated rows get equal
    texts; null ids and urls are kept; other columns are ignored; an empty table gives no rows.
    """
    weights = train(pages, cut)

    @F.pandas_udf("string")
    def text_of(htmls: pd.Series) -> pd.Series:
        return pd.Series([main_text(x, weights, cut) for x in htmls], dtype=object)

    out = pages.select("page_id", "url", text_of("html").alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
