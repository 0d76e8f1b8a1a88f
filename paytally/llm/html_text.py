"""Main text of pages by a tree-structured graphical model over the DOM.

Each block element is content or not. Its own features (kind of tag, words of its class
and id, own and linked text) speak for either; a potential for each parent and child,
by kind of the child, says how far the two agree. Sum-product messages go from the
leaves to the root and back and give each element its marginal; the text of elements
that are content rather than not is the main text. All probabilities are counts over
labelled pages, so training is one pass.

Defined results for odd input: a null or empty page has an empty text; unclosed and
crossing tags are read leniently; pages are read whole, however long or deep; repeated
rows each give a row; an empty table gives none; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytally.llm.html_pages import labelled_pages
from paytally.llm.html_tree import Node, Tree, read

# Words of class, id and role that mark what is part of an article or not.
GOOD = frozenset("article content post entry body text main story".split())
BAD = frozenset(
    "nav navigation menu navbar ad ads advert advertisement sponsor sponsored banner sidebar "
    "footer header masthead comment comments disqus responses discussion reply replies cookie "
    "cookies consent notice notices promo promotion related share sharing social breadcrumb "
    "breadcrumbs widget subscribe subscription newsletter login signup popup modal overlay "
    "toolbar pagination pager copyright legal search form complementary contentinfo".split()
)
_WORD = re.compile(r"[a-z]+")
# Kinds of elements without which a page has no layout: nothing but text.
PLAIN = frozenset("html head body p heading list item quote br".split())
KINDS = {
    **dict.fromkeys(("article", "main"), "article"),
    **dict.fromkeys(("nav", "menu", "search"), "nav"),
    **dict.fromkeys(("footer", "header", "aside", "form", "head", "p"), ""),
    **dict.fromkeys(("fieldset", "legend", "dialog"), "form"),
    **dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"), "heading"),
    **dict.fromkeys(("ul", "ol", "dl"), "list"),
    **dict.fromkeys(("li", "dt", "dd"), "item"),
    **dict.fromkeys(("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"), "table"),
    **dict.fromkeys(("blockquote", "pre", "figure", "figcaption", "details", "summary"), "quote"),
    **dict.fromkeys(("div", "section", "center", "address"), "div"),
}


def _kind(node: Node) -> str:
    return KINDS.get(node.tag, node.tag) or node.tag


def _hint(node: Node) -> str:
    if node.hidden:
        return "bad"
    words = set(_WORD.findall(node.hints))
    return "bad" if words & BAD else "good" if words & GOOD else "none"


def _features(tree: Tree) -> list[tuple[tuple, ...]]:
    """Features of each node; text and links of a node count those of its descendants."""
    chars = [n.chars for n in tree.nodes]
    linked = [n.linked for n in tree.nodes]
    for i in range(len(tree.nodes) - 1, 0, -1):
        parent = tree.nodes[i].parent
        chars[parent] += chars[i]
        linked[parent] += linked[i]
    bare = all(_kind(node) in PLAIN and _hint(node) != "bad" for node in tree.nodes)
    found = []
    for node, all_chars, all_linked in zip(tree.nodes, chars, linked, strict=True):
        own = min(4, node.chars and 1 + int(math.log2(1 + node.chars / 25)))
        density = min(3, int(4 * all_linked / all_chars)) if all_chars else -1
        found.append((("kind", _kind(node)), ("hint", _hint(node)), ("text", own, density)))
    # Whether there is a layout at all tells what the page itself is.
    found[0] = (*found[0], ("bare", bare))
    return found


def _edge(node: Node) -> tuple[str, str]:
    """The kind of the potential between a node and its parent."""
    return _kind(node), _hint(node)


@dataclass(frozen=True)
class Model:
    """Log odds of features, and P(child | parent) by kind of edge."""

    features: dict[tuple, tuple[float, float]]
    edges: dict[tuple, tuple[tuple[float, float], tuple[float, float]]]
    other_edge: tuple[tuple[float, float], tuple[float, float]]
    root: tuple[float, float]

    def marginals(self, tree: Tree) -> list[float]:
        """P(content) of each node given the whole page."""
        nodes, one = tree.nodes, (1.0, 1.0)
        up = []
        for features in _features(tree):
            p0 = p1 = 1.0
            for f in features:
                a, b = self.features.get(f, one)
                p0, p1 = p0 * a, p1 * b
            up.append((p0 / (p0 + p1), p1 / (p0 + p1)))
        local, sent = list(up), [one] * len(nodes)
        edge = [self.edges.get(_edge(n), self.other_edge) for n in nodes]
        for i in range(len(nodes) - 1, 0, -1):
            (e00, e01), (e10, e11) = edge[i]
            u0, u1 = up[i]
            m0, m1 = e00 * u0 + e01 * u1, e10 * u0 + e11 * u1
            sent[i] = (m0 / (m0 + m1), m1 / (m0 + m1))
            p0, p1 = up[nodes[i].parent]
            p0, p1 = p0 * sent[i][0], p1 * sent[i][1]
            up[nodes[i].parent] = (p0 / (p0 + p1), p1 / (p0 + p1))
        belief = [one] * len(nodes)
        b0, b1 = up[0][0] * self.root[0], up[0][1] * self.root[1]
        belief[0] = (b0 / (b0 + b1), b1 / (b0 + b1))
        for i in range(1, len(nodes)):
            (e00, e01), (e10, e11) = edge[i]
            # What the parent believes without this child's own message.
            q0, q1 = (b / max(s, 1e-300) for b, s in zip(belief[nodes[i].parent], sent[i]))
            down0, down1 = q0 * e00 + q1 * e10, q0 * e01 + q1 * e11
            b0, b1 = up[i][0] * down0, up[i][1] * down1
            belief[i] = (b0 / (b0 + b1), b1 / (b0 + b1)) if b0 + b1 > 0 else local[i]
        return [b for _, b in belief]

    def text(self, page: str, least: float = 0.5) -> str:
        tree = read(page)
        marginals = self.marginals(tree)
        return "\n".join(text for i, text in tree.runs if marginals[i] >= least)


def train(pages: list[str], smoothing: float = 0.5) -> Model:
    """Count features and parent-child agreement over pages with ``data-main`` labels."""
    counts: dict[tuple, list[float]] = {}
    edges: dict[tuple, list[list[float]]] = {}
    totals, root = [0.0, 0.0], [1.0, 1.0]
    every = [[1.0, 1.0], [1.0, 1.0]]
    for page in pages:
        tree = read(page)
        labels: list[int] = []
        for i, (node, features) in enumerate(zip(tree.nodes, _features(tree), strict=True)):
            inherited = labels[node.parent] if i else 0
            label = inherited if node.label is None else node.label
            labels.append(label)
            totals[label] += 1
            for f in features:
                counts.setdefault(f, [smoothing, smoothing])[label] += 1
            if i:
                pair = edges.setdefault(_edge(node), [[smoothing] * 2, [smoothing] * 2])
                pair[labels[node.parent]][label] += 1
                every[labels[node.parent]][label] += 1
            else:
                root[label] += 1

    def rates(pair: list[list[float]]) -> tuple:
        return tuple((a / (a + b), b / (a + b)) for a, b in pair)

    return Model(
        {f: (c[0] / totals[0], c[1] / totals[1]) for f, c in counts.items()},
        {e: rates(pair) for e, pair in edges.items()},
        rates(every),
        (root[0] / sum(root), root[1] / sum(root)),
    )


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page."""
    shared = pages.sparkSession.sparkContext.broadcast(model or train(labelled_pages()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [own.text(page or "") for page in batch.column(2).to_pylist()]
            arrays = [*batch.columns[:2], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    found = rows.mapInArrow(run, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
