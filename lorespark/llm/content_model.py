"""Which nodes of a page are content: a tree-structured graphical model (problem 1).

Every node has a hidden state: hidden or quoted, rendered but no content of the page (navigation,
notices, boxes), or content. Node potentials depend on its kind, on length, links and prose of its
text, and on words and attributes that notices and navigation use; parent-child potentials on the
parent's kind, on whether the child is a comment, nowiki, script or code block, and on both states. Sum-product messages pass up and then down the trees, all pages of a
batch at once and one depth after another, and give exact marginals. Training climbs the likelihood
of labelled pages, whose gradient is observed minus expected counts under the same marginals.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespark.llm import doctree as dt
from lorespark.llm.labelled_pages import PAGES
from lorespark.session import ship

HIDDEN, CHROME, CONTENT = range(3)
MARKS = {"-": HIDDEN, "~": CHROME, "+": CONTENT}
N_KINDS = len(dt.KINDS)
LENGTHS = np.array([8, 24, 64, 160, 512])
#: What navigation and notices say, and how containers of them are named.
_NOTICES = (
    "jump to", "navigation", "log in", "sign in", "subscribe", "newsletter", "cookie", "privacy", "copyright", "all rights reserved", "terms of use", "retrieved from", "edit this", "view history",
    "back to top", "share on", "follow us", "contact us", "latest posts", "table of contents", "help by", "跳转到", "导航", "版权", "保留所有权利", "登录", "订阅",
)
_ALONE = {"contents", "home", "help", "menu", "search"}
_CHROME_BOX = re.compile(r"\A(?:nav|header|footer|aside|form)\b|nav|menu|toc\b|sidebar|footer|breadcrumb|cookie|banner|share|social|metadata|noprint|edit|notice|login|advert", re.I)
_LINKED = re.compile(r"\[\[[^\[\]]*\]\]|<a\b[^>]*>.*?</a\s*>|\[[^\[\]]*\]\([^()]*\)", re.S | re.I)
_PROSE = re.compile(r"[^\W\d_]{2,}(?:\W+[^\W\d_]+){3,}|[一-鿿]{6,}")
#: Cues beside the kind and the length class: mostly links, only links, a notice, a container of chrome, prose.
CUES = 5
N_FEATURES = N_KINDS + len(LENGTHS) + 1 + CUES
ROUNDS, RATE, RIDGE = 2500, 0.8, 0.0005
ELEMENTS = {dt.HEADING: "heading", dt.ITEM: "list", dt.CODE: "code", dt.FORMULA: "formula"}
_OPAQUE = (dt.COMMENT, dt.NOWIKI, dt.SCRIPT, dt.CODE)
N_EDGES = 2 * N_KINDS
_QUIET = (dt.CODE, dt.COMMENT, dt.NOWIKI, dt.FORMULA, dt.SCRIPT)


def cues(kind: int, raw: str) -> tuple[bool, ...]:
    if kind == dt.BOX:
        return False, False, False, bool(_CHROME_BOX.search(raw)), False
    if kind in _QUIET or not raw:
        return False, False, False, False, False
    mostly = only = False
    if "[" in raw or "<" in raw:
        linked = sum(len(m[0]) for m in _LINKED.finditer(raw))
        if linked:
            left = len(_LINKED.sub("", raw).strip(" \t\r\n*.,;|·"))
            mostly, only = 2 * linked > len(raw), left == 0
    low = raw.lower()
    notice = any(n in low for n in _NOTICES) or len(low) < 24 and low.strip(" \t\r\n[]*|·.") in _ALONE
    return mostly, only, notice, False, bool(_PROSE.search(raw))


class Forest:
    """Arrays over the nodes of many pages."""

    def __init__(self, trees: list[dt.Tree]):
        sizes = np.array([len(t.kinds) for t in trees])
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.kind = np.fromiter((k for t in trees for k in t.kinds), np.int64, self.first[-1])
        self.parent = np.fromiter((p for t in trees for p in t.parents), np.int64, self.first[-1]) + np.repeat(self.first[:-1], sizes)
        self.length = np.searchsorted(LENGTHS, np.fromiter((len(r) for t in trees for r in t.raw), np.int64, self.first[-1]))
        self.cues = np.array([cues(k, r) for t in trees for k, r in zip(t.kinds, t.raw)], float).reshape(-1, CUES)
        self.edge = self.kind[self.parent] + N_KINDS * np.isin(self.kind, _OPAQUE)  # which parent-child potential
        depth = np.zeros(len(self.kind), np.int64)
        root = self.kind == dt.ROOT
        while True:  # as often as the trees are deep
            deeper = np.where(root, 0, depth[self.parent] + 1)
            if (deeper == depth).all():
                break
            depth = deeper
        self.levels = [np.flatnonzero(depth == d) for d in range(depth.max() + 1)] if len(depth) else []

    def unary(self, w: np.ndarray) -> np.ndarray:
        return w[self.kind] + w[N_KINDS + self.length] + self.cues @ w[-CUES:]


def marginals(forest: Forest, node_w: np.ndarray, edge_w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(state) of each node, P(parent state, state) of each node with its parent)."""
    own = forest.unary(node_w)
    own[forest.kind == dt.ROOT] = [-30.0, -30.0, 0.0]  # the page itself is content
    up = np.zeros_like(own)  # message of a node to its parent
    inside = own.copy()
    pair = edge_w[forest.edge]  # node, parent state, state
    for nodes in reversed(forest.levels[1:]):
        up[nodes] = np.logaddexp.reduce(pair[nodes] + inside[nodes][:, None, :], axis=2)
        np.add.at(inside, forest.parent[nodes], up[nodes])
    belief = inside.copy()
    joint = np.zeros((len(own), 3, 3))
    for nodes in forest.levels[1:]:
        outside = belief[forest.parent[nodes]] - up[nodes]  # message of the parent, without what came from the node
        both = outside[:, :, None] + pair[nodes] + inside[nodes][:, None, :]
        belief[nodes] = np.logaddexp.reduce(outside[:, :, None] + pair[nodes], axis=1) + inside[nodes]
        both -= np.logaddexp.reduce(both.reshape(len(nodes), 9), axis=1)[:, None, None]
        joint[nodes] = np.exp(both)
    belief -= np.logaddexp.reduce(belief, axis=1)[:, None]
    return np.exp(belief), joint


def labelled(pages: list = PAGES) -> tuple[list[dt.Tree], np.ndarray]:
    """Trees of labelled pages and the states of their nodes.

    A page is parsed block by block, so that every node has the mark of its block, and a heading's
    section takes in what follows it.
    """
    trees, states = [], []
    for blocks in pages:
        whole, state, open_ = dt.Tree(), [CONTENT], []
        for mark, text in blocks:
            part = dt.parse(text)
            shift = len(whole.kinds) - 1
            hidden = [False] * len(part.kinds)
            order = sorted(range(1, len(part.kinds)), key=lambda i: _depth(part, i))  # parents first
            home = open_[-1][1] if open_ else 0
            for i in range(1, len(part.kinds)):
                whole.add(part.kinds[i], part.parents[i] + shift if part.parents[i] else home, "")
                whole.raw[-1], whole.level[-1] = part.raw[i], part.level[i]
            for i in order:
                up = part.parents[i]
                hidden[i] = bool(up) and (hidden[up] or part.kinds[up] in (dt.COMMENT, dt.NOWIKI, dt.CODE))
            state += [HIDDEN if hidden[i] else MARKS[mark] for i in range(1, len(part.kinds))]
            for i in range(1, len(part.kinds)):
                if part.kinds[i] == dt.HEADING and part.kinds[part.parents[i]] == dt.SECTION and not hidden[i]:
                    while open_ and open_[-1][0] >= part.level[i]:
                        open_.pop()
                    whole.parents[part.parents[i] + shift] = open_[-1][1] if open_ else 0
                    open_.append((part.level[i], part.parents[i] + shift))
        trees.append(whole)
        states += state
    return trees, np.array(states)


def _depth(tree: dt.Tree, i: int) -> int:
    n = 0
    while i:
        i, n = tree.parents[i], n + 1
    return n


@lru_cache(maxsize=1)
def trained() -> tuple[np.ndarray, np.ndarray]:
    """Node and parent-child weights that make the labelled pages likely."""
    trees, y = labelled()
    f = Forest(trees)
    node_w, edge_w = np.zeros((N_FEATURES, 3)), np.zeros((N_EDGES, 3, 3))
    real = np.flatnonzero(f.kind != dt.ROOT)
    seen = np.eye(3)[y]
    seen_pair = np.zeros((len(y), 3, 3))
    seen_pair[real, y[f.parent[real]], y[real]] = 1
    for _ in range(ROUNDS):
        p, joint = marginals(f, node_w, edge_w)
        gap, gap_pair = (seen - p)[real], (seen_pair - joint)[real]
        grad = np.zeros_like(node_w)
        np.add.at(grad, f.kind[real], gap)
        np.add.at(grad, N_KINDS + f.length[real], gap)
        grad[-CUES:] = f.cues[real].T @ gap
        grad_pair = np.zeros_like(edge_w)
        np.add.at(grad_pair, f.edge[real], gap_pair)
        node_w += RATE * (grad / len(trees) - RIDGE * node_w)
        edge_w += RATE * (grad_pair / len(trees) - RIDGE * edge_w)
    return node_w, edge_w


def render(tree: dt.Tree, keep: np.ndarray) -> str:
    """Clean text of the kept nodes in reading order; structure shows as in Markdown.

    Headings have a `#` a level, items are indented and numbered where their list is, rows of
    tables are lines of cells; what a table holds is shown in its cells only.
    """
    held = [f"${h}$" for h in tree.held]
    out: list[str] = []
    numbers: dict[int, int] = {}
    order = sorted(range(1, len(tree.kinds)), key=tree.place.__getitem__)
    celled: set[int] = set()
    rows: dict[int, list[int]] = {}
    for i, parent in enumerate(tree.parents):
        if i and (tree.kinds[parent] == dt.CELL or parent in celled):
            celled.add(i)
        if tree.kinds[i] in (dt.ROW, dt.CELL):
            rows.setdefault(parent, []).append(i)
    in_list = False
    for i in order:
        kind = tree.kinds[i]
        if not keep[i] or i in celled or tree.kinds[tree.parents[i]] in (dt.COMMENT, dt.NOWIKI, dt.CODE):
            continue
        item = kind == dt.ITEM
        if kind == dt.CODE:
            out.append("```\n" + dt.code_body(tree.raw[i]).strip("\r\n") + "\n```")
        elif kind == dt.HEADING:
            out.append("#" * max(1, tree.level[i]) + " " + dt.clean(tree.raw[i], held))
        elif item:
            depth, parent = abs(tree.level[i]), tree.parents[i]
            first = parent not in numbers
            numbers[parent] = numbers.get(parent, 0) + 1 if tree.level[i] < 0 else 0
            line = "  " * (depth - 1) + (f"{numbers[parent]}. " if tree.level[i] < 0 else "- ") + dt.clean(tree.raw[i], held)
            if in_list and (depth > 1 or not first):
                out[-1] += "\n" + line
            else:
                out.append(line)
        elif kind == dt.TABLE:
            lines = [" | ".join(x for c in rows.get(r, []) if keep[c] and (x := dt.clean(tree.raw[c], held, drop_calls=True))) for r in _rows(tree, i, rows) if keep[r]]
            if any(lines):
                out.append("\n".join(x for x in lines if x))
        elif kind in (dt.PARA, dt.GALLERY, dt.FILE):
            if text := dt.clean(tree.raw[i], held, drop_calls=True):
                out.append(text)
        else:
            continue
        in_list = item
    return "\n\n".join(out)


def _rows(tree: dt.Tree, table: int, rows: dict[int, list[int]]) -> list[int]:
    """The rows of a table, also those in its head, body and foot."""
    out = [r for r in rows.get(table, []) if tree.kinds[r] == dt.ROW]
    for box in (b for b in range(table + 1, len(tree.kinds)) if tree.kinds[b] == dt.BOX and tree.parents[b] == table):
        out += [r for r in rows.get(box, []) if tree.kinds[r] == dt.ROW]
    return sorted(out)


def _elements(node_w: np.ndarray, edge_w: np.ndarray, with_text: bool):
    element = pa.struct([("elem_kind", pa.string()), ("label", pa.string()), ("content_p", pa.float32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = batch.column(1).to_pylist()
                trees = [dt.parse(t or "") for t in texts]
                forest = Forest(trees)
                p, _ = marginals(forest, node_w, edge_w)
                shown = 1 - p[:, HIDDEN]  # an element is one whether or not it is content of the page
                kinds = forest.kind
                found: list[dict[tuple[str, str], float]] = [{} for _ in trees]
                of = np.repeat(np.arange(len(trees)), np.diff(forest.first))
                for node in np.flatnonzero((shown >= 0.5) & np.isin(kinds, list(ELEMENTS))).tolist():
                    page = of[node]
                    label = trees[page].label(node - int(forest.first[page]))
                    if label:
                        key = (ELEMENTS[int(kinds[node])], label)
                        found[page][key] = max(found[page].get(key, 0.0), float(p[node, CONTENT]))
                out = [batch.column(0), pa.array([[{"elem_kind": k, "label": v, "content_p": q} for (k, v), q in f.items()] for f in found], pa.list_(element))]
                names = ["item_key", "elements"]
                if with_text:
                    keep = p[:, CONTENT] >= 0.5
                    out.append(pa.array([None if t is None else render(tree, keep[a:b]) for t, tree, a, b in zip(texts, trees, forest.first[:-1], forest.first[1:])], pa.string()))
                    names.append("clean_text")
                yield pa.record_batch(out, names=names)

    return run


def structure(df: DataFrame, id_col: str, text_col: str, with_text: bool = True) -> DataFrame:
    """(item_key, elements[, clean_text]) of each row.

    `elements` holds the distinct headings, list items, code blocks and formulas that are not
    hidden, with their labels and the probability of being content; elements without a label are
    none. The clean text has the nodes that are content. A null text has no elements and a null
    clean text, an empty one an empty clean text.
    """
    ship(df.sparkSession)
    node_w, edge_w = trained()
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"item_key {kind}, elements array<struct<elem_kind:string,label:string,content_p:float>>" + ", clean_text string" * with_text
    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(_elements(node_w, edge_w, with_text), schema)
