"""Ranked lexical search against scores of all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_contracts import AWKWARD, awkward, rows_of, source, texts
from trendloom.llm import lexical
from trendloom.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(items, docs, k=10):
    held = [(d, Counter(split(t))) for d, t in docs if d is not None]
    held = [(d, c) for d, c in held if c]
    count, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in held:
            m = 100 - 90 + 90 * sum(c.values()) * count // length
            s = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(split(text)) if c[t])
            if s > 0:
                scores.append((-s, d))
        out += [(item, n, d, -s) for n, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def asked(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, doc_id string, score int")


def test_op13(spark, sf_dir):
    items = [(r.item_id, r.text) for r in source(spark, sf_dir, "benchmark").collect()]
    assert sorted(rows_of(QUERIES["op13_lexical"](spark, sf_dir))) == brute(items, texts(spark, sf_dir))


@pytest.mark.parametrize("docs", [AWKWARD, [(3, "a b"), (3, "a b"), (2, "A-b"), (1, "a b c"), (None, "a b")], [(1, None), (2, "..")], []])
def test_op13_awkward(spark, docs):
    items = [(1, None), (2, ""), (3, "One, ONE two"), (4, "the same long LINE of text here"), (5, "--"), (6, "a b c Ünïcode 日本語 naïve"), (7, "a"), (8, "\x1c word")]
    got = sorted(rows_of(lexical.ranked(asked(spark, items + [(None, "a")]), awkward(spark, docs), k=3)))
    assert got == brute(items, docs, 3)
    assert rows_of(lexical.ranked(asked(spark, []), awkward(spark, docs))) == []


def test_blocks_of_items_and_ties(spark, monkeypatch):
    """Small blocks of items and of documents, many equal scores, and an item whose id is repeated."""
    monkeypatch.setattr(lexical, "ITEM_CHARACTERS", 200)
    draw = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(draw.choices(words, range(1, 41), k=draw.randint(1, 12)))) for i in draw.sample(range(5000), 400)]
    docs += [(9000 - i, "w0 w1 w2") for i in range(50)]
    items = [(i, " ".join(draw.sample(words, draw.randint(1, 9)))) for i in range(40)]
    repeated = [*items, (39, ""), (7, None)]
    assert sorted(rows_of(lexical.ranked(asked(spark, repeated), awkward(spark, docs)))) == brute(items, docs)


def test_node_pairs_are_pruned_and_nothing_is_lost():
    rng = np.random.default_rng(7)
    n_terms, n_docs = 300, 6000
    weights = np.concatenate([[0], rng.integers(1, 9000, n_terms)])
    rows = [np.unique(rng.integers(1, n_terms + 1, rng.integers(1, 12))) for _ in range(n_docs)]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    which, values = np.concatenate(rows), rng.integers(1, 1000, starts[-1])
    items = [np.unique(rng.integers(1, n_terms + 1, 6)) for _ in range(30)]
    search = lexical.Search(items, weights, 5)
    search.show(np.arange(n_docs)[::-1].copy(), starts, which, values)
    dense = np.zeros((n_docs, n_terms + 1), np.int64)
    dense[np.repeat(np.arange(n_docs), np.diff(starts)), which] = values
    want = []
    for i, item in enumerate(items):
        scores = dense[:, item] @ weights[item]
        best = sorted((-int(s), n_docs - 1 - j) for j, s in enumerate(scores.tolist()) if s > 0)[:5]
        want += [(i, d, -s) for s, d in best]
    assert list(search.results()) == want
    assert search.scored < 0.5 * n_docs * len(items)


def test_large_totals_stay_exact():
    n = np.array([3, 10**9], np.int64)
    got = lexical.term_values(np.array([1, 10**6], np.int64), n, 10**11, 10**14)
    want = [10**9 * t // (1000 * t + 8 * (10 + 90 * x * 10**11 // 10**14)) for t, x in ((1, 3), (10**6, 10**9))]
    assert got.tolist() == want
