"""Exact top-k by inner product: branch and bound over blocks of dimensions, in vertical layout.

Vectors are packed into blocks that hold one row per dimension. Groups of candidate blocks and groups of query blocks meet in
the cells of a grid, one partition each; a block of queries meets the candidates of its cell block by block and carries its k
best along. Partial products are added dimension block by dimension block. By Cauchy and Schwarz the dimensions still to come
can add no more than the product of the remaining lengths; a candidate that can't reach the k-th best score so far of any query
is out, and the survivors are compacted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from trendloom.llm.frames import _rows, column, settled

#: Candidates and queries in a block, components in a block at most, dimensions that are added at once.
CANDIDATES, QUERIES, COMPONENTS, DIMENSIONS = 8192, 1024, 1 << 22, 16
#: Components of the candidates that a cell holds, and cells for each core.
HELD, CELLS = 1 << 24, 4
#: Queries that meet a block at once, and candidates that are scored in full at first, for a k-th best score to prune by.
TILE, PROBES = 128, 64
#: Sums of whole numbers are exact in these types below this.
EXACT = {np.dtype("f4"): 1 << 24, np.dtype("f8"): 1 << 53, np.dtype("i8"): 1 << 63}
#: More than rounding in these types can take from a bound.
SLACK = 4
#: Below every score.
LEAST = -(1 << 63)
BLOCK = "first long, ids binary, block binary, width int"
FOUND = "query_id long, vec_id long, score long"


def scaled(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """``vec_id, q``: floor(scale * x) of each component. Vectors that are null or hold null, NaN or infinite components, and
    rows without an id, are left out. Of rows that repeat an id, the smallest vector counts."""
    x = column(vector).cast("array<double>")
    rows = vectors.select(column(key).cast("long").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    rows = rows.where(F.coalesce(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))), F.lit(False)))
    return rows.select("vec_id", F.transform("x", lambda v: F.floor(v * scale)).alias("q")).groupBy("vec_id").agg(F.min("q").alias("q"))


def _packed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows ``vec_id, q`` as blocks: ``BLOCK``. Its first id is its name, as ids are distinct."""
    held: list[pa.RecordBatch] = []
    n = width = 0
    for batch in batches:
        width = max(width, int(batch.column(1).value_lengths().to_numpy(zero_copy_only=False).max(initial=0)))
        most = max(1, min(size, COMPONENTS // max(1, width)))
        while len(batch):
            if n >= most:
                yield _block(held)
                held, n = [], 0
            part, batch = batch.slice(0, most - n), batch.slice(most - n)
            held.append(part)
            n += len(part)
    if held:
        yield _block(held)


def _block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    ids = np.concatenate([p.column(0).to_numpy() for p in parts])
    lengths = np.concatenate([p.column(1).value_lengths().to_numpy(zero_copy_only=False) for p in parts])
    values = np.concatenate([p.column(1).flatten().to_numpy(zero_copy_only=False) for p in parts])
    low, high, width = int(values.min(initial=0)), int(values.max(initial=0)), int(lengths.max())
    kind = next(t for t in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    block = np.zeros((len(ids), width), kind)
    block[np.arange(width) < lengths[:, None]] = values  # shorter ones are filled with zeros
    row = [[ids[0]], [ids.astype("<i8").tobytes()], [np.ascontiguousarray(block.T).tobytes()], [width]]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int64(), pa.binary(), pa.binary(), pa.int32()))], ["first", "ids", "block", "width"])


def _opened(ids: bytes, block: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and the vectors, one row per dimension."""
    names = np.frombuffer(ids, "<i8")
    return names, np.frombuffer(block, f"<i{len(block) // (width * len(names)) if width else 8}").reshape(width, len(names))


def _remaining(block: np.ndarray, step: int) -> np.ndarray:
    """Length of each vector without its first 0, step, 2 * step, ... dimensions, rounded up."""
    squares = np.cumsum((block.astype(np.float64) ** 2)[::-1], axis=0)[::-1]
    return np.sqrt(np.concatenate([squares[::step], np.zeros((1, block.shape[1]))])) * (1 + 1e-6)


class Candidates:
    """A block of candidates by ascending id, and what all queries need of it."""

    def __init__(self, ids: np.ndarray, block: np.ndarray, step: int = DIMENSIONS) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.block, self.step = ids[order], block[:, order], step
        self.most = _most(block)
        self._typed: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

    def typed(self, width: int, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
        """The first ``width`` dimensions in this type, and what remains of lengths."""
        if (width, kind) not in self._typed:
            block = self.block[:width]
            self._typed = {(width, kind): (block.astype(kind), _remaining(block, self.step))}
        return self._typed[width, kind]


def _most(block: np.ndarray) -> int:
    return max(int(block.max(initial=0)), -int(block.min(initial=0)))


def _kind(queries: np.ndarray, block: Candidates) -> np.dtype:
    """The fastest type in which every partial product is exact."""
    most = _most(queries) * block.most * max(1, len(queries))
    return next((kind for kind, limit in EXACT.items() if most < limit), np.dtype(object))


def _probed(partial: np.ndarray, q: np.ndarray, x: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """A score for each query that ``k`` candidates reach: the k-th best of those with the best partial products."""
    n = max(PROBES, 2 * k)
    if n >= x.shape[1]:
        return np.full(len(partial), LEAST, partial.dtype)
    probes = np.argpartition(partial, x.shape[1] - n, axis=1)[:, -n:]
    scores = np.stack([q[:, i] @ x[:, p] for i, p in enumerate(probes)])
    scores[probes == own[:, None]] = LEAST
    return np.partition(scores, n - k, axis=1)[:, n - k]


def _alive(partial: np.ndarray, query_rest: np.ndarray, rest: np.ndarray, floors: np.ndarray) -> np.ndarray:
    """Which candidates may still reach the floors, by Cauchy and Schwarz."""
    return partial + query_rest[:, None] * rest >= floors[:, None] - SLACK


def _reaching(query_ids: np.ndarray, queries: np.ndarray, block: Candidates, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of queries, ids and scores: all candidates that may be among the ``k`` best of a query, whose floor they reach."""
    width, step = min(len(queries), len(block.block)), block.step  # beyond, one of them is zero
    queries, ids = queries[:width], block.ids
    kind = _kind(queries, block)
    x, rest = block.typed(width, kind)
    q, bounded = queries.astype(kind), kind.kind == "f"
    own = np.searchsorted(ids, query_ids)
    own[ids[np.minimum(own, len(ids) - 1)] != query_ids] = -1
    partial = q[:step].T @ x[:step]
    floors = floors.astype(kind)
    if kind == object:
        floors[floors == LEAST] = float("-inf")
    if bounded and (floors == LEAST).any():
        floors = np.maximum(floors, _probed(partial, q, x, own, k))
    query_rest = _remaining(queries, step).astype(kind) if bounded else None
    rest = rest.astype(kind) if bounded else None
    for n, start in enumerate(range(step, width, step), 1):
        if bounded:
            if _alive(partial[::16], query_rest[n, ::16], rest[n], floors[::16]).mean() < 0.5:  # else a test of all costs more than it spares
                keep = _alive(partial, query_rest[n], rest[n], floors)
                if np.count_nonzero(keep) * 64 < keep.size:  # few enough to finish one by one
                    rows, at = np.divmod(np.flatnonzero(keep), len(ids))
                    scores = partial[rows, at] + np.einsum("dp,dp->p", q[start:, rows], x[start:, at])
                    return _hits(rows, ids[at], scores, query_ids, floors, k)
                if (alive := keep.any(axis=0)).mean() < 0.8:
                    partial, x, rest, ids = partial[:, alive], x[:, alive], rest[:, alive], ids[alive]
        partial += q[start : start + step].T @ x[start : start + step]
    rows, at = np.divmod(np.flatnonzero(partial >= floors[:, None]), len(ids))
    return _hits(rows, ids[at], partial[rows, at], query_ids, floors, k)


def _hits(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Without the queries themselves, and with the ``k`` smallest ids at most that just reach a floor; ids ascend in each row."""
    keep = (ids != query_ids[rows]) & (scores >= floors[rows])
    rows, ids, scores = rows[keep], ids[keep], scores[keep]
    level = np.flatnonzero(scores == floors[rows])
    keep = np.ones(len(rows), bool)
    keep[level] = _places(rows[level]) < k
    scores = scores[keep]
    return rows[keep], ids[keep], scores if scores.dtype == object else scores.astype(np.int64)


def _places(rows: np.ndarray) -> np.ndarray:
    """Number of each entry among those of its row, from 0; rows ascend."""
    return np.arange(len(rows)) - np.searchsorted(rows, rows)


def best_of_blocks(query_ids: np.ndarray, queries: np.ndarray, blocks: Sequence[Candidates], k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The ``k`` best candidates of all blocks for each query, best first, as arrays ``query_id, vec_id, score`` for some queries at a time."""
    for start in range(0, len(query_ids), TILE):
        some, part = query_ids[start : start + TILE], queries[:, start : start + TILE]
        floors = np.full(len(some), LEAST, np.int64)
        rows, ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for block in (b for b in blocks if len(b.ids)):
            rows, ids, scores = (np.concatenate(x) for x in zip((rows, ids, scores), _reaching(some, part, block, floors, k)))
            order = np.lexsort((ids, -scores, rows))
            order = order[_places(rows[order]) < k]
            rows, ids, scores = rows[order], ids[order], scores[order]
            last = _places(rows) == k - 1
            floors = floors.astype(scores.dtype)
            floors[rows[last]] = scores[last]
        yield some[rows], ids, scores


def best_of_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, block: np.ndarray, k: int, step: int = DIMENSIONS) -> Iterator[tuple[int, int, int]]:
    """The ``k`` best candidates of the block for each query, as ``(query_id, vec_id, score)``."""
    for found in best_of_blocks(query_ids, queries, [Candidates(ids, block, step)], k):
        yield from zip(*(x.tolist() for x in found))


def _searched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Of rows ``cell, asked, ids, block, width``, the candidates of a cell first: the ``k`` best of a cell for its queries."""
    names, here, held = FOUND.replace(" long", "").split(", "), None, []
    for cell, asked, ids, block, width in _rows(batches):
        if cell != here:
            here, held = cell, []
        if not asked:
            held.append(Candidates(*_opened(ids, block, width)))
            continue
        for found in best_of_blocks(*_opened(ids, block, width), held, k):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names)


def _grid(candidates: tuple[int, int], queries: tuple[int, int], width: int, k: int, cells: int) -> tuple[int, int]:
    """Groups of candidates and of queries, of which rows and blocks are given. A cell can hold its candidates, there are about as
    many cells as said, and the least is moved: candidates once for each group of queries, queries and what they find once for
    each group of candidates."""
    least = -(-candidates[0] * width // HELD)
    grids = [(max(1, min(max(least, -(-cells // n)), candidates[1])), n) for n in range(1, max(1, min(cells, queries[1])) + 1)]
    return min(grids, key=lambda g: (-min(cells, g[0] * g[1]), g[1] * candidates[0] * width + g[0] * queries[0] * (width + 12 * k)))


def _numbered(blocks: DataFrame) -> DataFrame:
    """With ``no``, from 0. Blocks are few (one for each 8192 vectors); their numbers are ranks of their names, a long each."""
    order = blocks.select("first").withColumn("no", F.row_number().over(W.orderBy("first")) - 1)
    return blocks.hint("merge").join(order, "first")


def top_k(vectors: DataFrame, query: str, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` vectors with the greatest inner product with each query, but for itself.

    ``query`` is a condition on ``vec_id`` that says which rows are queries. Components count as floor(64 * x); shorter
    vectors count as filled with zeros. Ties go to the smaller id. With fewer candidates than ``k``, all are returned; no
    queries or no vectors give no rows. Every block of queries meets every block of candidates, which exact search over a
    share of all rows as queries needs; what moves is each block once for a row or column of the grid of cells, never pairs
    of blocks or of rows, and nothing is broadcast.
    """
    table = settled(scaled(vectors, key, vector), "scaled")
    blocks = settled(table.mapInArrow(lambda batches: _packed(batches, CANDIDATES), BLOCK), "blocks")
    asked = table.where(query)
    asked = asked.repartition(max(1, -(-asked.count() // QUERIES)))
    queries = settled(asked.mapInArrow(lambda batches: _packed(batches, QUERIES), BLOCK), "queries")
    rows, width = F.coalesce(F.sum(F.octet_length("ids") / 8), F.lit(0)).cast("long"), F.coalesce(F.max("width"), F.lit(0))
    (n, n_blocks, most), (m, m_blocks, _) = (df.agg(rows, F.count("*"), width).first() for df in (blocks, queries))
    down, across = _grid((n, n_blocks), (m, m_blocks), max(1, most), k, CELLS * table.sparkSession.sparkContext.defaultParallelism)
    # Cells are numbered row by row; candidates go to all cells of a row, queries to all of a column.
    row, place = F.col("no") % down * across, F.col("no") % across
    held = _numbered(blocks).select(F.explode(F.sequence(row, row + (across - 1))).alias("cell"), F.lit(False).alias("asked"), "ids", "block", "width")
    asking = _numbered(queries).select(F.explode(F.sequence(place, place + across * (down - 1), F.lit(across))).alias("cell"), F.lit(True).alias("asked"), "ids", "block", "width")
    met = held.union(asking).repartitionById(down * across, "cell").sortWithinPartitions("cell", "asked")
    found = met.mapInArrow(lambda batches: _searched(batches, k), FOUND)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
