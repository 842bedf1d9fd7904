"""HTML extraction by gradient-boosted trees over the nodes of the document tree.

Every element becomes a row of features: depth, place among its siblings and how many are like it, size and density of
its subtree, share of linked text, punctuation, tag and attribute tokens. Boosted regression trees give its probability of
being content. Labels come from the pages themselves, where authors mark regions: elements in ``article`` and ``main``
are content, those in ``nav``, ``aside``, ``footer`` and ``header`` are not; the names of these regions are hidden from
the features, so that other pages are judged by the rest. A bounded sample of pages is trained on (``train_pages``, the
lowest hashes of ``page_id``, then of ``html``). Decoding goes bottom up: of a subtree all is kept, all is dropped, or, at a small price,
each child has its own best choice, so that no kept element stands in a dropped one or the other way round.

Defined results: a null or empty page has an empty text; text outside all elements belongs to the root; unclosed and
stray tags are repaired as browsers do for the common cases; a tag without an end is text; pages of any length are read
whole, in time that is linear in it; equal elements have equal choices, and of equally good choices for a subtree dropping
it comes first, then keeping it; an empty table gives no rows; pages without any labels leave the prior of one half; rows
that share a ``page_id`` are each extracted. Only ``page_id`` and ``html`` are read.
"""

from __future__ import annotations

import html as entities
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorgnette.llm.common import held

TRAIN_PAGES, TREES, DEPTH, RATE, BINS, PRICE = 300, 40, 3, 0.2, 24, 1.0
CONTENT, OTHER = {"article", "main"}, {"nav", "aside", "footer", "header"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"p", "div", "section", "article", "main", "nav", "aside", "header", "footer", "ul", "ol", "li", "table", "tr", "td", "th", "blockquote", "pre", "form", "figure", "dl", "dt", "dd", *(f"h{k}" for k in range(1, 7)), "br", "hr", "body"}
HIDDEN = {"script", "style", "noscript", "template", "head", "title"}
BEGIN, STOP = re.compile(r"<(?:!--|[!?]*[a-zA-Z]|/[a-zA-Z])"), re.compile(r">|=\s*[\"']")
RAW = {x: re.compile(rf"</{x}\s*>", re.I) for x in ("script", "style")}
NAME, ATTRIBUTE = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)"), re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
TAGS = ["p", "div", "a", "li", "ul", "b", "br", "h1", "h2", "span", "body", "html"]
N_TOKENS = 8
N_FEATURES = 14 + len(TAGS) + N_TOKENS


class Node:
    __slots__ = ("tag", "parent", "children", "parts", "tokens", "block")

    def __init__(self, tag, parent, tokens=()):
        self.tag, self.parent, self.children, self.parts, self.tokens = tag, parent, [], [], tokens
        self.block = self if parent is None or tag in BLOCK else parent.block  # the nearest block around, itself if it is one


def marks(page: str):
    """(start, end) of tags, comments and raw elements, each found by going on from the one before.

    A tag ends at the first ``>`` outside values in quotes; a quote that never closes is an ordinary sign, and what has no
    end at all is text.
    """
    at, last = 0, {q: page.rfind(q) for q in ">\"'"}
    while True:
        m = BEGIN.search(page, at)
        if not m:
            return
        start = m.start()
        if m[0] == "<!--":
            end = page.find("-->", m.end())
            end = len(page) if end < 0 else end + 3
        else:
            end = m.end()
            while True:
                stop = STOP.search(page, end) if end <= last[">"] else None
                if not stop:
                    return
                end = stop.end()
                if stop[0] == ">":
                    break
                quote = page[end - 1]
                if last[quote] >= end and m[0][1] != "/":
                    end = page.find(quote, end) + 1
            name = NAME.match(page, start, end)
            if name and m[0][1] != "/" and name[1].lower() in RAW:
                close = RAW[name[1].lower()].search(page, end)
                end = close.end() if close else len(page)
        yield start, end
        at = end


def parse(page: str) -> list[Node]:
    """The elements in document order, the root first; ``parts`` of a node are its texts and children, in order."""
    root = Node("#root", None)
    nodes, here, at = [root], root, 0
    is_open: dict[str, int] = {}

    def closed(up: Node) -> Node:
        """What is open once ``up`` and all in it are closed."""
        x = here
        while True:
            is_open[x.tag] -= 1
            if x is up:
                return x.parent
            x = x.parent

    for start, end in marks(page):
        if start > at:
            here.parts.append(page[at:start])
        at = end
        text = page[start:end]
        tag = NAME.match(text)
        if not tag:
            continue
        tag = tag[1].lower()
        if tag in RAW and text[1] != "/":
            continue
        if text[1] == "/":
            if is_open.get(tag):
                up = here
                while up.tag != tag:
                    up = up.parent
                here = closed(up)
            continue
        if tag in BLOCK and tag != "br":
            # An open paragraph ends where a block begins, and with it whatever inline elements it holds.
            up = here.block
            if up.tag == "p" or up.tag == tag == "li" or up.tag == tag == "tr" or up.tag == tag == "td":
                here = closed(up)
        words = ()
        if "=" in text:
            words = tuple(t for a in ATTRIBUTE.finditer(text) for t in re.split(r"[\s_-]+", (a[1] or a[2] or a[3] or "").lower()) if t)
        node = Node(tag, here, words)
        here.children.append(node)
        here.parts.append(node)
        nodes.append(node)
        if tag not in VOID and not text.endswith("/>"):
            here = node
            is_open[tag] = is_open.get(tag, 0) + 1
    if at < len(page):
        here.parts.append(page[at:])
    return nodes


def features(nodes: list[Node]) -> np.ndarray:
    n = len(nodes)
    number = {id(x): k for k, x in enumerate(nodes)}
    own = np.zeros((n, 5))  # text, linked text, punctuation, elements, words
    parent, depth, place, siblings, alike = (np.zeros(n, np.int64) for _ in range(5))
    linked, hidden = np.zeros(n, bool), np.zeros(n, bool)
    tags, tokens = np.zeros((n, len(TAGS))), np.zeros((n, N_TOKENS))
    for k, x in enumerate(nodes):
        if k:
            p = parent[k] = number[id(x.parent)]
            depth[k] = depth[p] + 1
            linked[k] = linked[p] or x.tag == "a"
            hidden[k] = hidden[p] or x.tag in HIDDEN
        if x.tag in TAGS:
            tags[k, TAGS.index(x.tag)] = 1
        for t in x.tokens:
            tokens[k, zlib.crc32(t.encode()) % N_TOKENS] = 1
        if x.children:
            same: dict[str, int] = {}
            for c in x.children:
                same[c.tag] = same.get(c.tag, 0) + 1
            for i, c in enumerate(x.children):
                j = number[id(c)]
                place[j], siblings[j], alike[j] = i, len(x.children), same[c.tag]
        own[k, 3] = 1
        if not hidden[k]:
            for t in x.parts:
                if isinstance(t, str):
                    size = len(t.strip())
                    own[k, 0] += size
                    own[k, 2] += t.count(".") + t.count(",")
                    own[k, 4] += t.count(" ")
            if linked[k]:
                own[k, 1] = own[k, 0]
    tree = own.copy()
    for k in range(n - 1, 0, -1):
        tree[parent[k]] += tree[k]
    text, link, stops, size, gaps = tree.T
    return np.column_stack([
        depth, place, siblings, alike / np.maximum(siblings, 1), np.log1p(text), np.log1p(own[:, 0]), np.log1p(size),
        text / size, link / np.maximum(text, 1), stops / np.maximum(text, 1), gaps / np.maximum(text, 1), hidden,
        np.log1p(text[parent]), text / np.maximum(text[parent], 1), tags, tokens,
    ])


def labels(nodes: list[Node]) -> np.ndarray:
    """1 for elements in content regions, 0 in others, -1 where no region says."""
    out = np.full(len(nodes), -1)
    number = {id(x): k for k, x in enumerate(nodes)}
    for k, x in enumerate(nodes):
        out[k] = 1 if x.tag in CONTENT else 0 if x.tag in OTHER or x.tag in HIDDEN else out[number[id(x.parent)]] if k else -1
    return out


class Boosted:
    """Boosted regression trees of one depth for a yes-or-no answer, on features cut into quantile bins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE):
        self.depth, self.trees = depth, []
        mean = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        self.prior = float(np.log(mean / (1 - mean)))
        if not len(y) or len(np.unique(y)) < 2:
            return
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
        score = np.full(len(y), self.prior)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            leaf, feature, value = np.zeros(len(y), np.int64), np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
            for level in range(depth):
                n_leaves, first = 2**level, 2**level - 1
                best, gain_at = np.zeros(n_leaves), [None] * n_leaves
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    key = leaf * (BINS + 1) + binned[:, f]
                    sg = np.bincount(key, g, n_leaves * (BINS + 1)).reshape(n_leaves, -1).cumsum(1)
                    sh = np.bincount(key, h, n_leaves * (BINS + 1)).reshape(n_leaves, -1).cumsum(1)
                    gl, hl, gt, ht = sg[:, : len(c)], sh[:, : len(c)], sg[:, -1:], sh[:, -1:]
                    gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                    top = gain.argmax(1)
                    for k in np.flatnonzero(gain[np.arange(n_leaves), top] > best + 1e-9):
                        best[k], gain_at[k] = gain[k, top[k]], (f, c[top[k]])
                for k, found in enumerate(gain_at):
                    if found:
                        feature[first + k], value[first + k] = found
                leaf = 2 * leaf + (x[np.arange(len(y)), feature[first + leaf]] > value[first + leaf])
            out = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + 1)
            score += out[leaf]
            self.trees.append((feature, value, out))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.full(len(x), self.prior), np.arange(len(x))
        for feature, value, out in self.trees:
            leaf = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = 2**level - 1 + leaf
                leaf = 2 * leaf + (x[rows, feature[at]] > value[at])
            score += out[leaf]
        return 1 / (1 + np.exp(-score))


def decode(nodes: list[Node], p: np.ndarray, price: float = PRICE) -> np.ndarray:
    """For each element whether it is kept: the likeliest choice in which a wholly kept or dropped subtree has no exception."""
    n = len(nodes)
    number = {id(x): k for k, x in enumerate(nodes)}
    q = np.clip(p, 1e-4, 1 - 1e-4)
    keep, drop = np.log(q), np.log(1 - q)
    mixed = np.maximum(keep, drop) - price
    own_keep = keep >= drop
    for k in range(n - 1, 0, -1):
        up = number[id(nodes[k].parent)]
        keep[up] += keep[k]
        drop[up] += drop[k]
        mixed[up] += max(keep[k], drop[k], mixed[k])
    state, kept = np.zeros(n, np.int64), np.zeros(n, bool)  # state 1: all kept, 0: all dropped, 2: each child for itself
    for k in range(n):
        above = state[number[id(nodes[k].parent)]] if k else 2
        state[k] = above if above < 2 else int(np.argmax([drop[k], keep[k], mixed[k]]))
        kept[k] = state[k] == 1 or state[k] == 2 and own_keep[k]
    return kept


def text_of(nodes: list[Node], kept: np.ndarray) -> str:
    """The kept elements' own texts in document order, blocks on lines of their own."""
    number = {id(x): k for k, x in enumerate(nodes)}
    out: list[str] = []
    work: list = [nodes[0]]
    while work:
        x = work.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        if x.tag in HIDDEN:
            continue
        line = ["\n"] if x.tag in BLOCK else []
        keep = kept[number[id(x)]]
        work += line
        work += [part for part in reversed(x.parts) if keep or not isinstance(part, str)]
        work += line
    lines = (re.sub(r"[ \t\r\f\xa0]+", " ", part).strip() for part in entities.unescape("".join(out)).split("\n"))
    return "\n".join(part for part in lines if part)


def train(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> Boosted:
    """A model from the elements with labels of ``train_pages`` pages, those with the lowest hashes of ``page_id``."""
    h = [F.xxhash64("page_id"), F.xxhash64("html")]
    sample = pages.select("html", *h).toDF("html", "h", "g").orderBy("h", "g").limit(train_pages).collect()
    xs, ys = [np.zeros((0, N_FEATURES))], [np.zeros(0)]
    for r in sample:
        nodes = parse(r["html"] or "")
        y = labels(nodes)
        xs.append(features(nodes)[y >= 0])
        ys.append(y[y >= 0])
    return Boosted(np.concatenate(xs), np.concatenate(ys).astype(float))


def extract(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """(page_id, text, n_nodes, n_kept) of every page."""
    model = held(pages.sparkSession.sparkContext, train(pages, train_pages))
    kind = pages.schema["page_id"].dataType.simpleString()

    def extracted(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                trees = [parse(h or "") for h in batch.column("html").to_pylist()]
                p = model()(np.concatenate([features(t) for t in trees]))
                ends = np.cumsum([len(t) for t in trees])
                kept = [decode(t, p[e - len(t) : e]) for t, e in zip(trees, ends, strict=True)]
                texts = [text_of(t, k) for t, k in zip(trees, kept, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), pa.array(texts, pa.string()), pa.array([len(t) - 1 for t in trees], pa.int32()), pa.array([int(k[1:].sum()) for k in kept], pa.int32())],
                    ["page_id", "text", "n_nodes", "n_kept"],
                )

    return pages.select("page_id", "html").mapInArrow(extracted, f"page_id {kind}, text string, n_nodes int, n_kept int")
