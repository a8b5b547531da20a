"""Main text of web pages: a tree-structured graphical model over the nodes of each page.

Every block element and every text block is a variable, main text or not. Its own features (tag, words of its names, length,
links, punctuation, share of the page) and a potential on each link between parent and child, by their kinds, say which
values go together. Messages passed up and then down the tree by sum-product give exact marginals; text blocks whose
marginal exceeds one half are the main text. The weights maximise the likelihood of labelled pages: the gradient is what was
seen less what the marginals expect.

Marginals are found for many pages at once, depth by depth.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.frames import arrow_map, column, portions
from trendloom.llm.htmltree import Page, read_page
from trendloom.llm.layouts import labelled_pages

#: Labelled pages by rule that the default model is fitted to, and the most of a table that ``trained_on`` takes.
LABELLED, LABELLED_ROWS = 900, 5_000
#: Steps of the fit, their size, and the weight of the squared weights.
STEPS, RATE, SHRINK = 250, 0.08, 0.3
#: Characters of pages that are judged at once.
PORTION = 2 << 20

#: Kinds of nodes; each pair of kinds of parent and child has potentials of its own.
KINDS = {"#text": 0, **dict.fromkeys("p blockquote pre h1 h2 h3 h4 h5 h6 figure figcaption dl dd dt".split(), 1)}
KINDS |= {**dict.fromkeys("ul ol li menu".split(), 2), **dict.fromkeys("table tbody thead tfoot tr td th".split(), 3)}
KINDS |= {**dict.fromkeys("nav aside footer header form dialog address".split(), 4), "article": 5, "main": 5, "html": 6, "body": 6}
OTHER_KIND = 7
N_KINDS = 8
#: Words that short texts beside the main text often hold.
CUES = re.compile(r"©|\(c\)|copyright|rights reserved|cookie|privacy|advertis|sponsored|subscribe|newsletter|sign (?:up|in)|log ?in", re.I)

_ENDINGS = tuple(".!?:;…。！？\"»”)")


def _step(x: float, marks: tuple[float, ...]) -> int:
    return sum(x >= m for m in marks)


def features(page: Page) -> list[list[str]]:
    """Names of the features of each node."""
    n = len(page.parent)
    size = [len(t) if t else 0 for t in page.text]
    linked, blocks = list(page.linked), [int(t is not None) for t in page.text]
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        size[up] += size[i]
        linked[up] += linked[i]
        blocks[up] += blocks[i]
    whole = max(1, size[0])
    done = 0
    out = []
    for i in range(n):
        tag, text = page.tag[i], page.text[i]
        links = _step(linked[i] / max(1, size[i]), (0.01, 0.2, 0.5, 0.8))
        if text is not None:
            words = text.count(" ") + 1
            above = page.tag[page.parent[i]]
            made = [
                "text", f"in {above}", f"length {_step(size[i], (8, 20, 45, 90, 180, 400))}", f"links {links}",
                f"ends {text.endswith(_ENDINGS)} {_step(size[i], (20, 45, 90))}",
                f"place {_step(done / whole, (0.02, 0.1, 0.5, 0.9, 0.98))}", f"link length {links}/{_step(size[i], (20, 90))}",
                f"heading {above[0] == 'h' and above[1:].isdigit()} {_step(words, (2, 6, 12))}",
            ]
            if size[i] < 300 and CUES.search(text):
                made.append("cue")
            done += size[i]
        else:
            share = _step(size[i] / whole, (0.02, 0.1, 0.3, 0.6, 0.9))
            mean = _step(size[i] / max(1, blocks[i]), (10, 25, 60, 150))
            made = [
                "element", f"tag {tag}", f"share {share}", f"element links {links}", f"mean {mean}", f"share links {share}/{links}",
                f"element place {_step(done / whole, (0.02, 0.5, 0.98))}", *[f"name {w}" for w in page.names[i]],
            ]
            if not page.names[i]:
                made.append(f"unnamed {tag}")
        out.append(made)
    return out


@dataclass
class Forest:
    """Nodes of many pages: parents (-1 for roots), pairs of kinds, nodes by depth, and features as pairs of node and feature."""

    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]
    node: np.ndarray
    feature: np.ndarray

    @property
    def size(self) -> int:
        return len(self.parent)


def forest(pages: list[Page], vocabulary: dict[str, int], grow: bool = False) -> Forest:
    """``grow`` gives features not seen so far a number; otherwise they don't count."""
    parent, kind, depth, node, feature = [], [], [], [], []
    for page in pages:
        offset = len(parent)
        parent += [p + offset if p >= 0 else -1 for p in page.parent]
        own = [KINDS.get(t, OTHER_KIND) for t in page.tag]
        kind += [N_KINDS * own[max(p, 0)] + k for p, k in zip(page.parent, own)]
        for p in page.parent:
            depth.append(0 if p < 0 else depth[offset + p] + 1)
        for i, made in enumerate(features(page)):
            for name in made:
                number = vocabulary.setdefault(name, len(vocabulary)) if grow else vocabulary.get(name)
                if number is not None:
                    node.append(offset + i)
                    feature.append(number)
    depths = np.array(depth, np.int64)
    order = np.argsort(depths, kind="stable")
    levels = np.split(order, np.cumsum(np.bincount(depths))[:-1]) if len(depths) else []
    return Forest(np.array(parent, np.int64), np.array(kind, np.int64), levels, np.array(node, np.int64), np.array(feature, np.int64))


@dataclass(frozen=True)
class Model:
    """Weights of features for main text, and log potentials ``links[pair of kinds, value of the parent, value of the child]``."""

    vocabulary: dict[str, int]
    weights: np.ndarray
    links: np.ndarray


def marginals(trees: Forest, weights: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of main text of each node, and of both values of each node and its parent, as ``[node, parent's, own]``."""
    own = np.bincount(trees.node, weights[trees.feature], trees.size)
    up, t = np.zeros(trees.size), links[trees.kind]
    for level in reversed(trees.levels[1:]):
        b, k = own[level], t[level]
        message = np.logaddexp(k[:, 1, 1] + b, k[:, 1, 0]) - np.logaddexp(k[:, 0, 1] + b, k[:, 0, 0])
        up[level] = message
        np.add.at(own, trees.parent[level], message)
    # ``own`` now has all that lies below a node; what comes from above is added on the way down.
    total = own.copy()
    pairs = np.zeros((trees.size, 2, 2))
    for level in trees.levels[1:]:
        k = t[level]
        above = total[trees.parent[level]] - up[level]
        total[level] += np.logaddexp(k[:, 1, 1] + above, k[:, 0, 1]) - np.logaddexp(k[:, 1, 0] + above, k[:, 0, 0])
        joint = k.copy()
        joint[:, 1, :] += above[:, None]
        joint[:, :, 1] += own[level][:, None]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        pairs[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
    return 1 / (1 + np.exp(-np.clip(total, -500, 500))), pairs


def true_values(page: Page) -> np.ndarray:
    """1 for text blocks marked as main text, and for elements of whose text more than half is."""
    n = len(page.parent)
    size, main = [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        if page.text[i] is not None:
            size[i] += len(page.text[i])
            main[i] += len(page.text[i]) * (page.label[i] or 0)
        if i:
            size[page.parent[i]] += size[i]
            main[page.parent[i]] += main[i]
    return np.array([(2 * m > s) if s else bool(page.label[i]) for i, (s, m) in enumerate(zip(size, main))], np.int64)


def fitted(pages: list[str]) -> Model:
    """The model that makes the labels of these pages most likely, by ascent along the gradient with adapted steps."""
    read = [read_page(p) for p in pages]
    vocabulary: dict[str, int] = {}
    trees = forest(read, vocabulary, grow=True)
    y = np.concatenate([true_values(p) for p in read]) if read else np.zeros(0, np.int64)
    inner = np.flatnonzero(trees.parent >= 0)
    seen_links = np.zeros((N_KINDS**2, 2, 2))
    np.add.at(seen_links, (trees.kind[inner], y[trees.parent[inner]], y[inner]), 1)
    seen = np.bincount(trees.feature, y[trees.node], len(vocabulary))
    values = [np.zeros(len(vocabulary)), np.zeros((N_KINDS**2, 2, 2))]
    first, second = [[np.zeros_like(v) for v in values] for _ in range(2)]
    for step in range(1, STEPS + 1):
        p, pairs = marginals(trees, *values)
        expected = np.zeros_like(seen_links)
        np.add.at(expected, trees.kind[inner], pairs[inner])
        slopes = [seen - np.bincount(trees.feature, p[trees.node], len(vocabulary)), seen_links - expected]
        for j, slope in enumerate(slopes):
            slope = slope - SHRINK * values[j]
            first[j] = 0.9 * first[j] + 0.1 * slope
            second[j] = 0.99 * second[j] + 0.01 * slope**2
            values[j] = values[j] + RATE * (first[j] / (1 - 0.9**step)) / (np.sqrt(second[j] / (1 - 0.99**step)) + 1e-8)
    return Model(vocabulary, *values)


@lru_cache(maxsize=1)
def default_model() -> Model:
    return fitted(labelled_pages(LABELLED))


def trained_on(pages: DataFrame, html: str = "html") -> Model:
    """A model fitted to a table of labelled pages: HTML with ``data-label="1"`` on what holds main text and ``"0"`` on what
    does not. At most ``LABELLED_ROWS`` pages count, those with the smallest hash of their html; null ones don't."""
    some = pages.select(column(html).cast("string").alias("html")).where("html IS NOT NULL")
    rows = some.orderBy(F.xxhash64("html"), "html").limit(LABELLED_ROWS).collect()
    return fitted([r.html for r in rows])


def main_blocks(pages: list[str | None], model: Model) -> list[list[str]]:
    """The text blocks of each page that are more likely main text than not, in page order."""
    read = [read_page(p) for p in pages]
    trees = forest(read, model.vocabulary)
    p, _ = marginals(trees, model.weights, model.links)
    out, at = [], 0
    for page in read:
        found = p[at : at + len(page.parent)].tolist()
        out.append([t for t, x in zip(page.text, found) if t is not None and x > 0.5])
        at += len(page.parent)
    return out


def _extracted(rows: Iterator[tuple], model: Model) -> Iterable[tuple]:
    for some in portions(rows, PORTION):
        for (row, _), blocks in zip(some, main_blocks([html for _, html in some], model)):
            text = "\n\n".join(blocks)
            yield row, text, len(text)


def main_text(pages: DataFrame, model: Model | None = None, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page: its main text, blocks joined by an empty line.

    The whole page is read, whatever its length; nothing is dropped but what is not main text, and nothing is cut. Character
    references are decoded and white space inside a block is one space. A null or empty page, and one without main text,
    gives an empty text and 0. Rows that repeat an id are each read alone; an empty table gives no rows; columns not in
    ``keep`` play no part. Nothing is shuffled: the model goes to the tasks with the function.
    """
    from pyspark.sql import types as T

    kept = T.StructType([pages.schema[c] for c in keep])
    rows = pages.select(F.struct(*[column(c) for c in keep]).alias("row"), column(html).cast("string").alias("html"))
    schema = T.StructType([T.StructField("row", kept), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    found = arrow_map(rows, _extracted, schema, model or default_model())
    return found.select(*[F.col("row").getField(c).alias(c) for c in keep], "text", "n_chars")
