"""Main text of web pages: gradient-boosted trees over DOM nodes.

Every block element and every run of text (``dom.Page``) is a node.  Trees of
Spark ML's ``GBTClassifier`` judge each node by its text, links and
punctuation, the density of its subtree, learned weights of its attribute
tokens, its depth, its place and its siblings; the score is the log odds that
the node holds text of the article.

Decoding keeps, per page, the set of nodes with the largest sum of scores in
which every kept node's parent is kept too: a block is never text inside a
dropped ancestor, and a container stays only if the blocks that it holds
outweigh it.  Kept text runs are joined in page order.

The model is fitted on composed labelled pages (``sample_pages``; their number
``n_pages`` is a parameter), since no table has labels.  It is a few kilobytes
of numbers and is broadcast; pages are then judged in one pass without any
shuffle.

Defined results: a null or empty page has empty text; a page without any kept
block too; repeated rows and null ids are rows of their own; other columns of
the input are not read.  White space is what Python calls so, the no-break
space included.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.dom import LEAF, Page
from salesmart.llm.sample_pages import MARK, sample_page
from salesmart.llm.tables import only
from salesmart.llm.textops import freed, row_blocks

#: Element kinds that are features, each as "is one" and "stands in one".
_KINDS = [("nav", "menu"), ("header",), ("footer",), ("aside",), ("form", "fieldset", "legend"), ("article", "main"),
          ("section",), ("ul", "ol", "dl"), ("li", "dd", "dt"), ("table", "tr", "td", "th", "tbody"),
          ("h1",), ("h2", "h3", "h4", "h5", "h6"), ("p",), ("blockquote", "pre", "figure", "figcaption"), ("div",), (LEAF,)]
_BIT = {tag: 1 << i for i, tags in enumerate(_KINDS) for tag in tags}
_ENDS = (".", "!", "?", "…", ":", '"')
#: Weight of a token that the sample does not have.
_UNKNOWN = 0.0


def page_arrays(page: Page, weights: dict[str, float]) -> np.ndarray:
    """Plain per-node numbers of one page, one row per node: parent, end,
    depth, bits of its kind, bits of its ancestors' kinds, token weight,
    lowest and highest token weight among its ancestors, characters, words,
    link characters, punctuation, whether it ends like a sentence."""
    rows = []
    for i, (tag, parent, tokens, text) in enumerate(zip(page.tag, page.parent, page.tokens, page.text)):
        bit = _BIT.get(tag, 0)
        own = sum([weights.get(t, _UNKNOWN) for t in tokens]) if tokens else 0.0
        if parent < 0:
            rows.append((0, page.end[0], 0, bit, 0, own, 0.0, 0.0, 0, 0, 0, 0, 0))
            continue
        up = rows[parent]
        low, high = min(up[6], up[5]), max(up[7], up[5])
        if text is None:
            rows.append((parent, page.end[i], up[2] + 1, bit, up[4] | up[3], own, low, high, 0, 0, 0, 0, 0))
        else:
            marks = text.count(".") + text.count(",") + text.count("?") + text.count("!")
            rows.append((parent, page.end[i], up[2] + 1, bit, up[4] | up[3], own, low, high,
                         len(text), text.count(" ") + 1, page.link[i], marks, text.endswith(_ENDS)))
    return np.array(rows, float)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def node_features(pages: list[np.ndarray]) -> np.ndarray:
    """Features of all nodes of some pages (``page_arrays``), one row each."""
    sizes = np.array([len(p) for p in pages])
    first = np.repeat(np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    raw = np.vstack(pages)
    parent, end = raw[:, 0].astype(np.int64) + first, raw[:, 1].astype(np.int64) + first
    here = np.arange(len(raw))
    kinds, above = raw[:, 3].astype(np.int64), raw[:, 4].astype(np.int64)
    leaf = (kinds & _BIT[LEAF]) > 0

    def subtree(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[end] - total[here]

    def before(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[here] - total[first]

    chars, words, links, marks = (subtree(raw[:, c]) for c in (8, 9, 10, 11))
    sentences, leaves = subtree(raw[:, 12]), subtree(leaf)
    nodes = (end - here).astype(float)
    child = here != first
    siblings = np.bincount(parent[child], minlength=len(raw))[parent]
    alike_key = np.unique(parent * (1 << len(_KINDS)) + kinds, return_inverse=True)[1]
    alike = np.bincount(alike_key)[alike_key]
    page_chars, page_nodes = chars[first], nodes[first]
    link_share = _ratio(links, chars)
    previous = np.where(child, np.roll(chars, 1), 0)
    columns = [
        raw[:, 2], raw[:, 5], raw[:, 6], raw[:, 7], raw[:, 5][parent],
        np.log1p(chars), np.log1p(words), link_share, _ratio(marks, words), _ratio(sentences, leaves),
        _ratio(chars, nodes), _ratio(chars, leaves), np.log1p(leaves), _ratio(chars, words),
        _ratio(chars, page_chars), _ratio(before(raw[:, 8]), page_chars), _ratio(here - first, page_nodes),
        siblings, alike, _ratio(alike, siblings), np.log1p(previous),
        _ratio(chars, chars[parent]), np.log1p(chars[parent]), link_share[parent], _ratio(marks[parent], words[parent]),
        _ratio(sentences[parent], leaves[parent]), _ratio(chars[parent], page_chars), np.log1p(leaves[parent]),
        _ratio(chars[parent], nodes[parent]), link_share[parent[parent]], _ratio(chars[parent[parent]], page_chars),
        np.log1p(page_chars), page_nodes,
    ]
    columns += [(kinds >> i) & 1 for i in range(len(_KINDS))]
    columns += [((above | kinds[parent] * child) >> i) & 1 for i in range(len(_KINDS) - 1)]
    return np.column_stack(columns).astype(float)


def decode(parent: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The ancestor-closed node set of one page with the largest sum of scores
    (node 0 is the root and is always open)."""
    total = score.tolist()
    up = parent.astype(np.int64).tolist()
    total[0] = 0.0
    for i in range(len(up) - 1, 0, -1):
        if total[i] > 0:
            total[up[i]] += total[i]
    kept = [True] + [False] * (len(up) - 1)
    for i in range(1, len(up)):
        kept[i] = total[i] > 0 and kept[up[i]]
    return np.array(kept)


@dataclass
class Trees:
    """Boosted regression trees as arrays; ``score`` gives log odds."""

    feature: np.ndarray   # tree x place; -1: a leaf
    threshold: np.ndarray
    value: np.ndarray
    low: np.ndarray       # places of the branches
    high: np.ndarray
    weight: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        rows = np.arange(len(x))
        for t, w in enumerate(self.weight):
            at = np.zeros(len(x), np.int64)
            feature, threshold, low, high = self.feature[t], self.threshold[t], self.low[t], self.high[t]
            for _ in range(self.depth):
                f = feature[at]
                at = np.where(f < 0, at, np.where(x[rows, f] <= threshold[at], low[at], high[at]))
            out += w * self.value[t][at]
        return 2 * out


_IF = re.compile(r"(If|Else) \(feature (\d+) (?:<=|>) (\S+)\)")


def read_trees(debug_string: str) -> Trees:
    """The trees of a fitted model from its text form."""
    trees, weights, deepest = [], [], 0
    for line in debug_string.splitlines():
        line = line.strip()
        if line.startswith("Tree "):
            weights.append(float(re.search(r"weight ([^)]+)\)", line)[1]))
            trees.append([])
            open_nodes: list[tuple[int, int]] = []  # place and depth of nodes that lack a branch
        elif (m := _IF.match(line)) or line.startswith("Predict:"):
            if m and m[1] == "Else":
                continue  # the second branch of the node on top follows
            nodes = trees[-1]
            place, depth = len(nodes), 0
            if open_nodes:
                above, depth = open_nodes[-1][0], open_nodes[-1][1] + 1
                nodes[above][3].append(place)
                if len(nodes[above][3]) == 2:
                    open_nodes.pop()
            deepest = max(deepest, depth)
            if m:
                nodes.append((int(m[2]), float(m[3]), 0.0, []))
                open_nodes.append((place, depth))
            else:
                nodes.append((-1, 0.0, float(line.split()[1]), [place, place]))
    size = max(len(t) for t in trees)
    table = np.zeros((5, len(trees), size))
    for t, nodes in enumerate(trees):
        for p, (f, cut, value, branches) in enumerate(nodes):
            table[:, t, p] = f, cut, value, *branches
    return Trees(table[0].astype(np.int64), table[1], table[2], table[3].astype(np.int64),
                 table[4].astype(np.int64), np.array(weights), deepest)


@dataclass
class Extractor:
    token_weights: dict[str, float]
    trees: Trees

    def blocks(self, pages: list[Page]) -> list[list[str]]:
        """Kept text runs of each page, in page order."""
        arrays = [page_arrays(p, self.token_weights) for p in pages]
        score = self.trees.score(node_features(arrays)) if arrays else np.zeros(0)
        out, at = [], 0
        for page, a in zip(pages, arrays):
            kept = decode(a[:, 0], score[at: at + len(a)])
            out.append([page.text[i] for i in np.flatnonzero(kept) if page.text[i] is not None])
            at += len(a)
        return out


def _labelled(number: int, seed: int) -> tuple[Page, np.ndarray]:
    """A sample page without marks, and whether each node holds marked text."""
    page = Page(sample_page(number, seed))
    marked = np.array([t is not None and MARK in t for t in page.text])
    page.text = [t if t is None else t.replace(MARK, "") for t in page.text]
    total = np.concatenate(([0], np.cumsum(marked)))
    return page, (total[np.array(page.end)] - total[: len(marked)]) > 0


def token_weights(n_pages: int, seed: int = 0) -> dict[str, float]:
    """Log odds of the attribute tokens of the sample's article nodes."""
    inside: dict[str, int] = {}
    outside: dict[str, int] = {}
    for number in range(n_pages):
        page, label = _labelled(number, seed)
        for tokens, main in zip(page.tokens, label):
            count = inside if main else outside
            for t in tokens:
                count[t] = count.get(t, 0) + 1
    return {t: math.log((inside.get(t, 0) + 0.5) / (outside.get(t, 0) + 0.5)) for t in sorted(inside | outside)}


def fit_extractor(spark: SparkSession, n_pages: int = 500, seed: int = 0, rounds: int = 12, depth: int = 5) -> Extractor:
    """Trees fitted by Spark ML on ``n_pages`` composed pages."""
    weights = token_weights(min(n_pages, 300), seed)

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number in b["id"].to_pylist():
                page, label = _labelled(number, seed)
                x = node_features([page_arrays(page, weights)])
                yield pa.RecordBatch.from_arrays([pa.array(list(x)), pa.array(label.astype(float))], names=["x", "label"])

    sample = spark.range(0, n_pages, numPartitions=4).mapInArrow(freed(nodes), "x array<double>, label double")
    rows = sample.select(array_to_vector("x").alias("features"), "label")
    model = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.5, maxBins=32, minInstancesPerNode=4, seed=17,
                          subsamplingRate=1.0, cacheNodeIds=False, checkpointInterval=-1).fit(rows)
    return Extractor(weights, read_trees(model.toDebugString))


def extract_text(pages: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks) of every row of ``pages``."""
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(extractor or fit_extractor(spark))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            size = np.concatenate(([0], np.cumsum(b["size"].to_numpy())))
            for lo, hi in row_blocks(size, 1 << 21):
                part = b.slice(lo, hi - lo)
                blocks = model.blocks([Page(h or "") for h in part["html"].to_pylist()])
                texts = ["\n".join(kept) for kept in blocks]
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64()), pa.array([len(k) for k in blocks], pa.int64())],
                    names=["page_id", "url", "text", "n_chars", "n_blocks"])

    kind = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    sized = only(pages, "page_id", "url", "html").withColumn("size", F.coalesce(F.octet_length("html"), F.lit(0)).cast("long"))
    return sized.mapInArrow(
        freed(extract), f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long, n_blocks long")
