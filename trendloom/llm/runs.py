"""Periodic runs of words: maximal repetitions by an enhanced suffix array, without building a tree.

The words of a text are numbered, sorted by suffix, and the longest common prefixes of neighbours give the LCP intervals.
A square ``ww`` whose next word breaks the period (a branching one) starts at two suffixes that part at depth ``|w|``, in
different children of the interval of that depth. So for each interval the suffixes of all children but the largest look
up, in the inverse suffix array, whether the suffix ``depth`` words on or back lies in the interval too. Each branching
square is the last one of a run; rotating it to the left as far as words agree gives the run.

A text without a window of ``WINDOW`` words that occurs twice has no run and is passed by: a run with period q has at least
max(24, 3q) words, so two windows q words apart, of at least 16 words, are equal in it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from fractions import Fraction
from itertools import count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.frames import arrow_map, column

#: A run has at least so many words, and its period so many times.
LEAST_WORDS, LEAST_TIMES = 24, 3
#: Words of the windows of which a text with a run has two that are equal.
WINDOW = 16
#: Suffixes that are looked up at once.
PORTION = 1 << 20

Run = tuple[int, int, int]


def has_equal_windows(ids: np.ndarray) -> bool:
    """Two windows of ``WINDOW`` words are equal; with a probability below 1e-9 also said where none are."""
    if len(ids) <= WINDOW:
        return False
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    width = 1
    while width < WINDOW:
        h = h[:-width] * np.uint64(0xBF58476D1CE4E5B9) + h[width:]
        h ^= h >> np.uint64(32)
        width *= 2
    h.sort()
    return bool((h[1:] == h[:-1]).any())


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse and the longest common prefixes of neighbours (``lcp[0]`` is 0), by doubling of prefixes."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    levels = [rank]
    while True:
        width = 1 << (len(levels) - 1)
        following = np.zeros(n, np.int64)
        following[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1:
            break
        levels.append(rank)
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for j in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero((a < n) & (b < n))
        same = inside[levels[j][a[inside]] == levels[j][b[inside]]]
        for moved in (a, b, common):
            moved[same] += 1 << j
    return order, rank, np.concatenate([[0], common])


def lcp_intervals(lcp: list[int], deepest: int) -> Iterator[tuple[int, list[int]]]:
    """``(depth, cuts)`` of each LCP interval of a depth from 1 to ``deepest``; its children lie between the cuts."""
    stack: list[tuple[int, list[int]]] = [(0, [0])]
    for k in range(1, len(lcp) + 1):
        height = lcp[k] if k < len(lcp) else -1
        left = k - 1
        while stack and stack[-1][0] > height:
            depth, cuts = stack.pop()
            left = cuts[0]
            if 0 < depth <= deepest:
                cuts.append(k)
                yield depth, cuts
        if stack and stack[-1][0] == height:
            stack[-1][1].append(k)
        else:
            stack.append((height, [left, k]))


def branching_squares(ids: np.ndarray) -> set[tuple[int, int]]:
    """``(start, period)`` of each square whose next word, where there is one, breaks its period."""
    n = len(ids)
    order, place, lcp = suffix_array(ids)
    found: set[tuple[int, int]] = set()
    held: list[tuple[int, int, int, int, int]] = []
    size = 0

    def look_up() -> None:
        first, number, depth, low, high = np.array(held, np.int64).T
        each = np.repeat(np.arange(len(held)), number)
        at = first[each] + np.arange(len(each)) - np.repeat(np.cumsum(number) - number, number)
        i, q, low, high = order[at], depth[each], low[each], high[each]
        for start, other in ((i, i + q), (i - q, i - q)):
            ok = (other >= 0) & (other < n)
            ok[ok] = (place[other[ok]] >= low[ok]) & (place[other[ok]] < high[ok])
            p, period = start[ok], q[ok]
            end = p + 2 * period
            ends = end >= n
            ends[~ends] = ids[end[~ends]] != ids[(end - period)[~ends]]
            whole = ends & (end <= n)
            found.update(zip(p[whole].tolist(), period[whole].tolist()))

    for depth, cuts in lcp_intervals(lcp.tolist(), n // 2):
        largest = max(range(len(cuts) - 1), key=lambda c: cuts[c + 1] - cuts[c])
        for c in range(len(cuts) - 1):
            if c != largest:
                held.append((cuts[c], cuts[c + 1] - cuts[c], depth, cuts[0], cuts[-1]))
                size += cuts[c + 1] - cuts[c]
        if size > PORTION:
            look_up()
            held, size = [], 0
    if held:
        look_up()
    return found


def _rotated(ids: np.ndarray, start: int, period: int) -> int:
    """The first word from which on the period holds up to ``start``."""
    step = 64
    while start > 0:
        low = max(0, start - step)
        differs = np.flatnonzero(ids[low:start] != ids[low + period : start + period])
        if len(differs):
            return low + int(differs[-1]) + 1
        start, step = low, 2 * step
    return 0


def runs_of(ids: np.ndarray, least_words: int = LEAST_WORDS, least_times: int = LEAST_TIMES) -> list[Run]:
    """``(start, length, period)`` of all maximal runs of a sequence, by start, then period.

    A run is a stretch with smallest period q of at least ``least_words`` words and ``least_times`` periods (two at least)
    that no neighbouring word extends.
    """
    if len(ids) < 2:
        return []
    by_end: dict[int, list[int]] = defaultdict(list)
    for start, period in branching_squares(ids):
        by_end[start + 2 * period].append(period)
    found = []
    for end, periods in by_end.items():
        reached = end
        for period in sorted(periods):
            # Inside a run of a shorter period that ends here too, this square only repeats that period.
            if end - 2 * period >= reached:
                continue
            start = _rotated(ids, end - 2 * period, period)
            reached = min(reached, start)
            if end - start >= max(least_words, least_times * period):
                found.append((start, end - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic_part(n: int, key: int | None) -> np.ndarray | None:
    """Which original word each place holds, where the contract's rule makes a part of the text periodic; else None."""
    if key is None:
        return None
    h = zlib.crc32(str(key).encode())
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _found(rows: Iterator[tuple], planted: bool) -> Iterable[tuple]:
    for key, text in rows:
        words = (text or b"").split()
        number = defaultdict(count().__next__)
        ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        if planted and (at := periodic_part(len(words), key)) is not None:
            ids, words = ids[at], [words[i] for i in at.tolist()]
        runs = runs_of(ids) if has_equal_windows(ids) else []
        kept = words
        if runs:
            # Stretches to drop, as steps up and down.
            steps = np.zeros(len(words) + 1, np.int64)
            for start, length, period in runs:
                steps[start + period] += 1
                steps[start + length] -= 1
            stays = np.cumsum(steps) == 0
            kept = [w for w, stay in zip(words, stays.tolist()) if stay]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        yield (
            key,
            len(words),
            len(runs),
            *(best or (None, None, None)),
            1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest(),
            [{"start": s, "length": n, "period": q} for s, n, q in runs],
            b" ".join(kept),
        )


FOUND = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
)


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", planted: bool = False) -> DataFrame:
    """Runs of words in each document: their number, the one repeated most often, all of them, and the text collapsed.

    Words are split at ASCII white space. ``runs`` lists every run; ``start``, ``length`` and ``period`` are those of the one
    with the greatest length / period (ties: smallest start, then period), null where there is none. ``collapsed`` joins by one
    space the words that no run contains after its first period. ``planted`` first makes part of some texts periodic, by a
    rule on the id; a row without an id is left as it is.

    A null or empty text has no words and no runs, rows that repeat an id are each judged alone, an empty table gives no
    rows, and other columns play no part. One row is worked on at a time, with some 150 bytes a word of the longest text.
    Nothing is shuffled.
    """
    rows = docs.select(column(key).cast("long").alias("doc_id"), column(text).cast("binary").alias("text"))
    return arrow_map(rows, _found, FOUND, planted)


def digests(docs: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    found = periodic_runs(docs, planted=True)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def collapsed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text`` with every run cut to its first period; texts without a run keep their words, joined by one space."""
    return periodic_runs(docs, key, text).select("doc_id", F.col("collapsed").cast("string").alias("text"))
