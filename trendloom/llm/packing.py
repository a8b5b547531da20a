"""Packs tokenized documents into sequences of fixed capacity: linear grouping, few-size configurations, best fit.

The plan depends only on how many pieces there are of each length, so at most ``capacity`` numbers come to the driver:

1. Pieces over ``small_below`` are ranked by length and cut into groups of equal cardinality; each length counts as the
   largest of its group.
2. Over the few sizes left, configurations are chosen: the largest size left, and with it the sizes that fill the rest of a
   sequence best. A configuration is used as often as the counts allow.
3. The actual documents of a group take the slots of its size. They are no longer than the slot, so they fit.
4. Small pieces go, longest first, where they fit with the least room left: into the sequences made so far, else a new one.

Runs of equal decisions are kept as one rule: pieces of this length with ranks from here to there go to sequences from
there on, at this offset. Spark ranks the pieces within their length and applies the rules.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from trendloom.llm.chunks import PORTION_TEXT, library_encoder
from trendloom.llm.frames import arrow_map, carried, column, portions, settled

CAPACITY = 4096
#: Settings that are tried on the counts, as (groups, capacity / smallest large piece); the fewest sequences win.
SETTINGS = ((256, 8), (256, 3), (512, 3))


@dataclass
class Run:
    """Sequences ``first``, ``first + 1``, ... (``count`` of them) with the same fill."""

    first: int
    count: int
    fill: int


@dataclass
class Rule:
    """Pieces of ``length`` with ranks from ``rank`` on (``count`` of them) go to sequences from ``sequence`` on, at ``offset``."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def grouped(counts: np.ndarray, groups: int, small_below: int) -> list[tuple[int, int]]:
    """``(size, pieces)`` of each group, largest size first. Groups have equal cardinality, but for the last."""
    lengths = np.flatnonzero(counts)
    lengths = lengths[lengths >= small_below][::-1]
    ends = np.cumsum(counts[lengths])
    total = int(ends[-1]) if len(ends) else 0
    found = []
    step = max(1, -(-total // groups))
    for start in range(0, total, step):
        size = int(lengths[np.searchsorted(ends, start, side="right")])
        found.append((size, min(step, total - start)))
    return found


def best_fill(room: int, sizes: list[int], left: list[int]) -> list[int]:
    """How many of each size fill ``room`` best, as a bounded knapsack over reachable sums; larger sizes first on ties."""
    # took[j] holds, for each sum, the number of size j in one way to reach it with the sizes up to j, or -1.
    reach = np.zeros(room + 1, bool)
    reach[0] = True
    took = []
    for size, count in zip(sizes, left):
        used = np.full(room + 1, -1, np.int64)
        used[reach] = 0
        if size <= room:
            for k in range(1, min(count, room // size) + 1):
                new = np.zeros(room + 1, bool)
                new[size * k :] = reach[: room + 1 - size * k]
                new &= used < 0
                used[new] = k
        took.append(used)
        reach = used >= 0
    total = int(np.flatnonzero(reach)[-1])
    picks = [0] * len(sizes)
    for j in range(len(sizes) - 1, -1, -1):
        picks[j] = int(took[j][total])
        total -= picks[j] * sizes[j]
    return picks


def configurations(groups: list[tuple[int, int]], capacity: int) -> list[tuple[list[int], int]]:
    """``(pieces of each group, sequences)`` until all pieces of all groups are placed."""
    left = [n for _, n in groups]
    sizes = [s for s, _ in groups]
    found = []
    head = 0
    while head < len(left):
        if not left[head]:
            head += 1
            continue
        rest = left[head:]
        rest[0] -= 1
        open_ = [j for j, n in enumerate(rest) if n]
        picks = best_fill(capacity - sizes[head], [sizes[head + j] for j in open_], [rest[j] for j in open_])
        config = [0] * len(left)
        config[head] = 1
        for j, n in zip(open_, picks):
            config[head + j] += n
        times = min(left[j] // n for j, n in enumerate(config) if n)
        left = [a - n * times for a, n in zip(left, config)]
        found.append((config, times))
    return found


def plan(counts: np.ndarray, capacity: int = CAPACITY, settings: tuple = SETTINGS) -> list[Rule]:
    """Rules that place all pieces. ``counts[n]`` is the number of pieces of length ``n``; none is longer than ``capacity``."""
    plans = [_plan(counts, capacity, groups, max(1, capacity // part)) for groups, part in settings]
    return min(plans, key=lambda rules: max((r.sequence + r.count for r in rules), default=0))


def _plan(counts: np.ndarray, capacity: int, groups: int, small_below: int) -> list[Rule]:
    counts = np.zeros(capacity + 1, np.int64) + np.pad(np.asarray(counts, np.int64), (0, max(0, capacity + 1 - len(counts))))[: capacity + 1]
    sizes = grouped(counts, groups, small_below)
    large = np.flatnonzero(counts)
    large = large[large >= small_below][::-1]
    ends = np.cumsum(counts[large])
    rules: list[Rule] = []
    runs: list[Run] = []
    taken = [sum(n for _, n in sizes[:j]) for j in range(len(sizes))]  # rank of the next piece of each group, over all large pieces
    sequence = 0
    for config, times in configurations(sizes, capacity):
        slots = []
        for j, n in enumerate(config):
            for _ in range(n):
                slots.append(taken[j])
                taken[j] += times
        # Lengths change along the ranks of a slot: cut the sequences where any slot's length changes.
        cuts = {0, times}
        for rank in slots:
            a, b = np.searchsorted(ends, [rank, rank + times - 1], side="right")
            cuts.update(int(e) - rank for e in ends[a:b])
        cuts = sorted(cuts)
        for start, stop in zip(cuts, cuts[1:]):
            fill = 0
            for rank in slots:
                k = int(np.searchsorted(ends, rank + start, side="right"))
                length = int(large[k])
                before = int(ends[k] - counts[length])
                rules.append(Rule(length, rank + start - before, stop - start, sequence + start, fill))
                fill += length
            runs.append(Run(sequence + start, stop - start, fill))
        sequence += times
    _best_fit(counts, small_below, capacity, runs, rules, sequence)
    return rules


def _best_fit(counts: np.ndarray, small_below: int, capacity: int, runs: list[Run], rules: list[Rule], sequence: int) -> None:
    by_room: dict[int, list[Run]] = {}
    rooms: list[int] = []

    def put(run: Run) -> None:
        room = capacity - run.fill
        if room:
            if room not in by_room:
                by_room[room] = []
                bisect.insort(rooms, room)
            by_room[room].append(run)

    for run in runs:
        put(run)
    for length in np.flatnonzero(counts[:small_below])[::-1].tolist():
        if not length:
            rules.append(Rule(0, 0, int(counts[0]), 0, 0))
            continue
        rank, left = 0, int(counts[length])
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                run = Run(sequence, -(-left // each), 0)
                sequence += run.count
                put(run)
                continue
            room = rooms[at]
            run = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
            n = min(left, run.count)
            if n < run.count:
                put(Run(run.first + n, run.count - n, run.fill))
            rules.append(Rule(length, rank, n, run.first, run.fill))
            put(Run(run.first, n, run.fill + length))
            rank, left = rank + n, left - n


# On Spark


def _pieces(rows: Iterator[tuple], path: str, end: int, capacity: int) -> Iterable[tuple]:
    encode, dtype = library_encoder(path)
    tail = np.array([end], dtype).tobytes()
    for some in portions(rows, PORTION_TEXT):
        for (key, _), packed in zip(some, encode([text or "" for _, text in some])):
            ids = np.frombuffer(packed + tail, dtype).astype("<u4")
            for piece, start in enumerate(range(0, len(ids), capacity)):
                part = ids[start : start + capacity]
                yield key, piece, start, len(part), zlib.crc32(part.tobytes())


def pieces(docs: DataFrame, path: str, end: int = 1, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every whole text by the tokenizers library, then ``end``."""
    return arrow_map(
        docs.select(column(key).cast("long"), column(text).cast("string")),
        _pieces, "doc_id long, piece int, start long, length long, ids_crc32 long", path, end, capacity,
    )


def ranked(parts: DataFrame, length: str = "length") -> DataFrame:
    """Adds ``rank`` from 0 within each length, without ever bringing a length together in one task.

    ``parts`` must be a written table. Each of its partitions is ranked apart, then lengths are counted per partition; a
    partition's ranks start after those of the partitions before it.
    """
    marked = settled(carried(parts, length=column(length), part=F.spark_partition_id()), "marked")
    per_part = marked.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # One row for each length and partition at most, whatever the number of rows.
    order = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = per_part.select("part", "length", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    local = marked.withColumn("local", F.row_number().over(W.partitionBy("part", "length").orderBy("row")) - 1)
    joined = local.join(base, ["part", "length"])
    return joined.select("row", "length", (F.col("base") + F.col("local")).alias("rank"))


def _placed(rows: Iterator[tuple], rules: dict[int, tuple]) -> Iterable[tuple]:
    for key, piece, start, length, crc, rank in rows:
        ranks, sequences, offsets = rules[length]
        k = int(np.searchsorted(ranks, rank, side="right")) - 1
        yield key, piece, start, length, crc, int(sequences[k] + rank - ranks[k]), int(offsets[k])


def pack(parts: DataFrame, capacity: int = CAPACITY, settings: tuple = SETTINGS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces. ``parts`` should be a written table, as it is read twice.

    Pieces of one sequence have no gap between them, from 0 on. Ties and repeated rows are pieces of their own. A piece of
    length 0 takes no room. The result has as many rows as ``parts``; an empty table gives an empty table.
    """
    found = parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most one row for each length
    counts = np.zeros(capacity + 1, np.int64)
    for r in found:
        counts[r["length"]] = r["n"]
    rules: dict[int, tuple] = {}
    by_length: dict[int, list[Rule]] = {}
    for rule in plan(counts, capacity, settings):
        by_length.setdefault(rule.length, []).append(rule)
    for length, some in by_length.items():
        some.sort(key=lambda r: r.rank)
        rules[length] = tuple(np.array([getattr(r, a) for r in some], np.int64) for a in ("rank", "sequence", "offset"))
    rows = ranked(parts).select(*[F.col("row").getField(c).alias(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")], "rank")
    return arrow_map(
        rows, _placed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long", rules
    )


def pack_documents(docs: DataFrame, path: str, end: int = 1, capacity: int = CAPACITY, settings: tuple = SETTINGS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenizes, cuts and packs every document; see ``pieces`` and ``pack``.

    Null and empty texts are one piece with the end id. Null and repeated ids keep their rows. Other columns are not read.
    """
    return pack(settled(pieces(docs, path, end, capacity, key, text), "pieces"), capacity, settings)
