"""Periodic runs against a brute-force search of all stretches."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import models
from tests.llm.test_contracts import AWKWARD, awkward, rows_of, source, texts
from trendloom.llm import runs
from trendloom.llm.queries import QUERIES


def brute(words, least_words=24, least_times=3):
    """Maximal stretches by period, the shortest period of a stretch only."""
    n, seen, out = len(words), set(), []
    for q in range(1, n // least_times + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least_words, least_times * q) and (i, length) not in seen:
                seen.add((i, length))
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def model(doc_id, text):
    words = models.WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = [(0, n, 1)] if n >= 24 and len(set(words)) == 1 else brute(words)
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *digest)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 4), st.lists(st.integers(0, 3), max_size=70), st.integers(2, 3))
def test_all_runs_of_short_sequences(letters, values, times):
    ids = np.array([v % letters for v in values], np.int64)
    assert runs.runs_of(ids, 2, times) == brute(ids.tolist(), 2, times)


def test_nested_and_long_runs():
    draw = random.Random(5)
    for _ in range(60):
        words = []
        while len(words) < 400:
            part = [draw.randint(0, 5) for _ in range(draw.randint(1, 30))]
            words += part * draw.randint(1, 9) + part[: draw.randint(0, len(part))]
            if draw.random() < 0.3:
                words += words[-draw.randint(1, 200) :] * 2
        ids = np.array(words[:1200], np.int64)
        want = brute(ids.tolist())
        assert runs.runs_of(ids) == want
        assert runs.has_equal_windows(ids) or not want
    same = np.zeros(30_000, np.int64)
    assert runs.runs_of(same) == [(0, 30_000, 1)]


def test_windows_and_suffixes():
    assert not runs.has_equal_windows(np.arange(1000))
    ids = np.array([3, 1, 2, 1, 2, 1, 0, 3, 1, 2])
    order, place, lcp = runs.suffix_array(ids)
    suffixes = sorted(range(len(ids)), key=lambda i: ids[i:].tolist())
    assert order.tolist() == suffixes and place[order].tolist() == list(range(len(ids)))
    for k in range(1, len(ids)):
        a, b = ids[suffixes[k - 1] :].tolist(), ids[suffixes[k] :].tolist()
        assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_op12(spark, sf_dir):
    got = rows_of(QUERIES["op12_runs"](spark, sf_dir))
    assert sorted(got) == sorted(model(d, t) for d, t in texts(spark, sf_dir))
    assert sum(r[1] for r in got) > 10


@pytest.mark.parametrize("rows", [AWKWARD, [(5, "a b " * 40), (5, "a b " * 40), (None, "x " * 30), (37, " ".join(f"w{i % 13}" for i in range(500)))], []])
def test_op12_awkward(spark, rows):
    got = rows_of(runs.digests(awkward(spark, rows)))
    assert sorted(map(repr, got)) == sorted(repr(model(d, t)) for d, t in rows)


def test_collapsed_texts(spark):
    docs = awkward(spark, [(1, "x y " * 20 + "end"), (2, "no run  here")])
    assert sorted(rows_of(runs.collapsed(docs))) == [(1, "x y end"), (2, "no run here")]
    listed = runs.periodic_runs(docs).where("n_runs > 0").first()
    assert [tuple(r) for r in listed.runs] == [(0, 40, 2)]
