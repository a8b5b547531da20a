"""Ranked lexical search of many items at once: dual-tree branch and bound over items and documents.

A document is a vector over the items' terms, with what a term adds to a score before it is weighted; an item is a vector of
weights. Both are grouped into trees whose nodes hold, for each term, the greatest value below them. The product of two nodes
bounds the score of every pair below them, so a pair of nodes goes as a whole when it can't reach the weakest k-th best score
among its items so far. What is left at the leaves is scored in full. All scores and bounds are whole numbers.

Documents are split into terms once and kept as short vectors. The tree of documents is built block by block inside a task,
so it is never larger than ``CELLS`` numbers; each task hands on its best ``k`` documents of each item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trendloom.llm.frames import arrow_map, column, settled

#: Characters of items that are searched for at once; each such block of items is one pass over the documents.
ITEM_CHARACTERS = 1 << 18
#: Numbers in a block of documents (documents times terms), and documents in it at most.
CELLS, DOCUMENTS = 1 << 22, 1024
#: Documents in a leaf; children of a node of documents, and of items.
LEAF, DOCUMENT_FAN, ITEM_FAN = 16, 4, 6

# Bytes that no term holds become spaces, A to Z become small letters; bytes beyond ASCII stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

RESULT = "item_id long, doc_id long, score long"


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8: runs of digits, letters and everything beyond ASCII, with only A-Z lower-cased."""
    return (text or b"").translate(_FOLD).split()


@dataclass
class ItemNode:
    """Items ``low`` to ``high`` in the order of the tree, with the greatest weight of each of their terms."""

    low: int
    high: int
    terms: np.ndarray
    weights: np.ndarray
    children: list[ItemNode] = field(default_factory=list)


def item_tree(items: list[np.ndarray], weights: np.ndarray, low: int = 0, high: int | None = None) -> ItemNode:
    """A tree over items given by their term numbers, neighbours in one node."""
    high = len(items) if high is None else high
    held = np.unique(np.concatenate([items[i] for i in range(low, high)] or [np.zeros(0, np.int64)])).astype(np.int64)
    node = ItemNode(low, high, held, weights[held])
    if high - low > 1:
        step = -(-(high - low) // ITEM_FAN)
        node.children = [item_tree(items, weights, i, min(i + step, high)) for i in range(low, high, step)]
    return node


class Search:
    """The best documents of each item among those it was shown."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, k: int):
        self.items, self.weights, self.k = items, weights, k
        self.root = item_tree(items, weights)
        self.best: list[list[tuple[int, int]]] = [[] for _ in items]
        #: The k-th best score of each item so far; below it nothing counts, and no score of 0 does.
        self.floor = np.ones(len(items), np.int64)
        self.scored = 0

    def show(self, ids: np.ndarray, starts: np.ndarray, which: np.ndarray, values: np.ndarray) -> None:
        """Documents as rows of ``which`` (term numbers) and ``values`` from ``starts[i]`` to ``starts[i + 1]``."""
        size = max(LEAF, min(DOCUMENTS, CELLS // max(1, len(self.weights)) // LEAF * LEAF))
        lengths = np.diff(starts)
        filled = np.flatnonzero(lengths)
        if not len(filled):
            return
        # Documents whose strongest term is the same come together, so that the greatest values of a node are close.
        strength = self.weights[which] * values
        row = np.repeat(np.arange(len(lengths)), lengths)
        ranked = np.lexsort((-strength, row))
        strongest = ranked[starts[:-1][filled]]
        filled = filled[np.lexsort((-strength[strongest], which[strongest]))]
        for i in range(0, len(filled), size):
            some = filled[i : i + size]
            counts = lengths[some]
            at = np.repeat(starts[some] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            block = np.zeros((-(-len(some) // LEAF) * LEAF, len(self.weights)), np.int64)
            block[np.repeat(np.arange(len(some)), counts), which[at]] = values[at]
            self._block(ids[some], block)

    def _block(self, ids: np.ndarray, block: np.ndarray) -> None:
        levels = [block.reshape(-1, LEAF, block.shape[1]).max(axis=1)]
        while len(levels[-1]) > 1:
            below = levels[-1]
            levels.append(np.maximum.reduceat(below, np.arange(0, len(below), DOCUMENT_FAN), axis=0))
        self._meet(self.root, levels, len(levels) - 1, np.zeros(1, np.int64), ids, block)

    def _meet(self, node: ItemNode, levels: list[np.ndarray], level: int, at: np.ndarray, ids: np.ndarray, block: np.ndarray) -> None:
        """Pairs of one node of items with nodes of documents ``at`` one level: bound, drop, and part both."""
        bound = levels[level][np.ix_(at, node.terms)] @ node.weights
        at = at[bound >= self.floor[node.low : node.high].min()]
        if not len(at):
            return
        if level:
            below = (at[:, None] * DOCUMENT_FAN + np.arange(DOCUMENT_FAN)).ravel()
            below = below[below < len(levels[level - 1])]
            for child in node.children or [node]:
                self._meet(child, levels, level - 1, below, ids, block)
        elif node.children:
            for child in node.children:
                self._meet(child, levels, 0, at, ids, block)
        else:
            self._score(node.low, at, ids, block)

    def _score(self, item: int, leaves: np.ndarray, ids: np.ndarray, block: np.ndarray) -> None:
        rows = (leaves[:, None] * LEAF + np.arange(LEAF)).ravel()
        rows = rows[rows < len(ids)]
        held = self.items[item]
        scores = block[np.ix_(rows, held)] @ self.weights[held]
        self.scored += len(rows)
        good = scores >= self.floor[item]
        if good.any():
            found = self.best[item] + list(zip((-scores[good]).tolist(), ids[rows[good]].tolist()))
            self.best[item] = sorted(found)[: self.k]
            if len(self.best[item]) == self.k:
                self.floor[item] = -self.best[item][-1][0]

    def results(self) -> Iterator[tuple[int, int, int]]:
        """``(item, document, score)``"""
        for item, found in enumerate(self.best):
            for score, doc in found:
                yield item, doc, -score


def term_values(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term adds before its weight: (10^9 tf) div (1000 tf + 8 m), m = 10 + (90 n N) div L."""
    if len(n) and 90 * int(n.max()) * documents >= 1 << 62:
        m = np.array([10 + 90 * x * documents // length for x in n.tolist()], np.int64)
    else:
        m = 10 + 90 * n * documents // max(1, length)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _vectors(rows: Iterator[tuple], vocabulary: dict[bytes, int]) -> Iterable[tuple]:
    for key, text in rows:
        found = terms(text)
        tf = Counter(filter(None, map(vocabulary.get, found)))
        yield key, len(found), list(tf), list(tf.values())


def _searched(batches: Iterator[pa.RecordBatch], items: list[np.ndarray], names: list[int], weights: np.ndarray, k: int, documents: int, length: int) -> Iterator[pa.RecordBatch]:
    search = Search(items, weights, k)
    for batch in batches:
        ids, n, which, tf = batch.columns
        starts = which.offsets.to_numpy().astype(np.int64)
        numbers = which.values.to_numpy()[starts[0] : starts[-1]].astype(np.int64)
        times = tf.values.to_numpy()[starts[0] : starts[-1]].astype(np.int64)
        starts = starts - starts[0]
        own = np.repeat(n.to_numpy(), np.diff(starts))
        search.show(ids.to_numpy(), starts, numbers, term_values(times, own, documents, length))
    found = list(search.results())
    columns = [[names[i] for i, _, _ in found], [d for _, d, _ in found], [s for _, _, s in found]]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])


def _block_of_items(rows: list[tuple]) -> tuple[list[int], list[list[bytes]]]:
    """Items that have terms, those with like terms next to each other."""
    named = [(key, list(dict.fromkeys(terms(text)))) for key, text in rows]
    named = [(key, held) for key, held in named if held]
    named.sort(key=lambda x: (min(x[1], key=lambda t: (-len(t), t)), x[0]))
    return [key for key, _ in named], [held for _, held in named]


def _ranked_block(docs: DataFrame, rows: list[tuple], k: int) -> DataFrame | None:
    names, held = _block_of_items(rows)
    if not names:
        return None
    # Numbers start at 1, so that no number counts as false.
    vocabulary = {t: i for i, t in enumerate(sorted({t for item in held for t in item}), 1)}
    vectors = settled(arrow_map(docs, _vectors, "doc_id long, n long, terms array<int>, tfs array<int>", vocabulary), "term-vectors")
    counted = vectors.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
    holding = dict(vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    documents, length = counted.documents or 0, counted.length or 0
    weights = np.array([0] + [term_weight(documents, holding.get(i, 0)) for i in range(1, len(vocabulary) + 1)], np.int64)
    items = [np.array(sorted(vocabulary[t] for t in item), np.int64) for item in held]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _searched(batches, items, names, weights, k, documents, length)

    return vectors.where(F.size("terms") > 0).mapInArrow(run, RESULT)


def ranked(items: DataFrame, docs: DataFrame, k: int = 10, item: str = "item_id", key: str = "doc_id", text: str = "text", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest score above 0 for each item, all if fewer.

    Equal scores go by ascending ``doc_id``. Items are a query set and are taken in blocks of about ``ITEM_CHARACTERS``, each
    one pass over all documents; what is sent to the tasks is the terms and weights of one block. A task returns ``k`` rows
    an item at most. A term's count of documents comes from a grouping with a map-side combine.

    Null or empty texts, and texts without terms, have none: such documents are found by no item and such items find none.
    Rows without an id take no part. Of rows that repeat an item's id, the greatest text counts; documents that repeat an id
    are each ranked alone. Long texts are read whole. Empty tables give no rows; other columns play no part.
    """
    asked = items.select(column(item).cast("long").alias("item_id"), column(item_text).cast("binary").alias("text"))
    asked = settled(asked.where("item_id IS NOT NULL").groupBy("item_id").agg(F.max("text").alias("text")), "items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-size // ITEM_CHARACTERS)
    table = docs.select(column(key).cast("long").alias("doc_id"), column(text).cast("binary").alias("text")).where("doc_id IS NOT NULL")
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(1, n_blocks))))
    found = None
    for b in range(n_blocks):
        part = _ranked_block(table, [tuple(r) for r in dealt.where(F.col("block") == b).select("item_id", "text").collect()], k)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        return items.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = W.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    placed = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return placed.select("item_id", F.col("rank").cast("int"), "doc_id", "score")
