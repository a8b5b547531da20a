"""Trends of a stream under the strict lateness rule, with the open windows of each trend as keyed state.

A batch touches the state of the trends it has points of, and no other; idle trends cost nothing. Three steps, one query:

1. Points are dealt by trend and stretch of arrival, so a trend with a large share of a batch lies in many tasks.
2. Each task turns the points of a trend and stretch into cells of each interval. Windows only close when some window is seen
   for the first time, so cells are cut at the first arrivals of the windows of the stretch: no cell holds points before and
   after a close. Points that are late whatever the state holds, since enough newer windows came before them in their own
   stretch, are only counted.
3. A trend's cells meet its state: the open windows of all its intervals, as a map on RocksDB, and what the trend is called.
   What comes out is the cells of windows that closed, the number of late points, and the trend's description.

So what one trend sends to one task is cells, bounded by its buckets and windows and not by its number of points.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from trendloom.operators.cells import SERIES, prepared_points
from trendloom.operators.lateness import BEFORE_ALL
from trendloom.operators.rules import with_trend_key
from trendloom.options import TrendOptions
from trendloom.plans.trends import trends_from_cells
from trendloom.schema import NO_BUCKET
from trendloom.sources.sinks import Sink, serve_batch

CELL, CLOSED, LATE, TREND = "cell", "closed", "late", "trend"
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Lets the changes of a batch be read back, and makes a commit as large as the change and not as the state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Cells of a trend and interval travel as arrays, since a row for each would cost a Python object for each.
_CELL = ("slice", "segment", "fresh", "win_start", "bucket", "n", "total", "fits")
_CUT = "kind string, trend_key string, agg_type string, seconds long, late long, metric string, tags map<string,string>, " + ", ".join(
    f"{c} array<bigint>" for c in _CELL
)
_RESULT = (
    "kind string, trend_key string, agg_type string, seconds long, late long, metric string, tags map<string,string>, "
    "win_start array<bigint>, bucket array<bigint>, n array<bigint>, total array<bigint>"
)
#: Cells in one row at most.
PIECE = 20_000
_LONGEST = 2**63
#: A stretch of arrival is this many of the blocks of the options: with the default an hour, so that most late points find
#: the newer windows that make them late in their own stretch.
STRETCH = 60


def _whole_sums(amounts: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    """Count and sum of ``amount``; a sum beyond 64 bits is null. Halves are summed apart so that none overflows."""
    whole = amounts["amount"].to_numpy(np.int64)
    parts = amounts.assign(high=whole >> 32, low=whole & 0xFFFFFFFF)
    summed = parts.groupby(by, sort=False).agg(n=("amount", "size"), high=("high", "sum"), low=("low", "sum")).reset_index()
    low = summed["low"].to_numpy()
    high = summed["high"].to_numpy() + (low >> 32)
    fits = (high >= -(2**31)) & (high < 2**31)
    total = (np.where(fits, high, 0) << 32) + (low & 0xFFFFFFFF)
    return summed.assign(total=pd.array(np.where(fits, total, 0), "Int64")).assign(total=lambda f: f["total"].where(fits)).drop(columns=["high", "low"])


def cut_cells(points: pd.DataFrame) -> pd.DataFrame:
    """Cells of the points of some trends and slices, cut at the first arrivals of minutes.

    ``segment`` counts the first arrivals before a point, within its trend and slice; ``fresh`` says that a point came at the
    first arrival of its own minute. Ordered by slice, segment, ``fresh`` and minute, cells are in the order of the rule.
    """
    group = ["trend_key", "agg_type", "slice"]
    rows = points.sort_values([*group, "arrival", "grain_start"], kind="stable", ignore_index=True)
    first = rows.groupby([*group, "grain_start"], sort=False)["arrival"].transform("min")
    rows["fresh"] = rows["arrival"] == first
    at = rows.groupby([*group, "arrival"], sort=False)
    opens = at["fresh"].transform("any")
    # One step at each arrival at which a minute is seen first.
    step = opens & (at.cumcount() == 0)
    rows["segment"] = step.groupby([rows[c] for c in group], sort=False).cumsum() - opens.astype("int64")
    cells = _whole_sums(rows, [*group, "segment", "fresh", "grain_start", "bucket"])
    series = list(SERIES)
    named = rows.drop_duplicates(series)[[*series, "metric", "tags"]]
    # The description travels once for each trend and task.
    described = cells.drop_duplicates(series).index
    texts = cells[series].merge(named, on=series, how="left")
    for column in ("metric", "tags"):
        cells[column] = texts[column].where(cells.index.isin(described), None)
    return cells


_NUMBERS = ("slice", "grain_start", "bucket", "amount", "arrival")


def window_cells(points: dict[str, np.ndarray], intervals: Sequence[tuple[int, int]]) -> Iterator[tuple[int, dict[str, np.ndarray], np.ndarray]]:
    """Cells of each interval out of the points of some trends and slices, cut at the first arrivals of windows.

    ``points`` has a whole number ``trend`` beside the columns of ``_NUMBERS``. Yields the length of the interval, the columns
    of its cells, and the number of points of each trend that are late whatever windows were open before the slice: once
    ``extra + 1`` newer windows came, each of them is open or older than all that are, so nothing older is open.
    """
    order = np.lexsort((points["grain_start"], points["arrival"], points["slice"], points["trend"]))
    trend, slice_, minute, arrival = (points[c][order] for c in ("trend", "slice", "grain_start", "arrival"))
    bucket, amount = points["bucket"][order], points["amount"][order]
    group = _numbered(trend, slice_)
    trends = int(trend.max()) + 1
    for seconds, extra in intervals:
        # Towards zero, as the batch windows are cut.
        start = minute - np.fmod(minute, seconds)
        starts, rank = np.unique(start, return_inverse=True)
        # In a group a window's place is its rank, from 1; 0 is none. Groups follow each other, so maxima run on within them.
        width = len(starts) + 2
        base = group * width
        seen = base + rank + 1
        for _ in range(extra + 1):
            newest = np.maximum.accumulate(seen)
            before = np.maximum(np.append(base[:1], newest[:-1]), base)
            # What is not the newest, each window once: the next newest is found among these.
            seen = np.where(seen == before, base, np.minimum(seen, before))
        kept = np.flatnonzero(base + rank + 1 >= newest)
        late = np.bincount(trend, minlength=trends) - np.bincount(trend[kept], minlength=trends)
        g, r, at = group[kept], rank[kept], arrival[kept]
        _, first, window = np.unique(g * width + r, return_index=True, return_inverse=True)
        fresh = at == at[first][window]
        moment = _numbered(g, at)
        opens = np.bincount(moment, weights=fresh) > 0
        # One step at each arrival at which a window is seen first.
        segment = (np.cumsum(opens) - opens)[moment]
        some = np.lexsort((bucket[kept], r, fresh, segment, g))
        lines = np.flatnonzero(_changes(g[some], segment[some], fresh[some], r[some], bucket[kept][some]))
        whole = amount[kept][some]
        low = np.add.reduceat(whole & 0xFFFFFFFF, lines)
        # Halves are summed apart so that none overflows.
        high = np.add.reduceat(whole >> 32, lines) + (low >> 32)
        fits = (high >= -(2**31)) & (high < 2**31)
        places = kept[some][lines]
        yield seconds, {
            "trend": trend[places], "slice": slice_[places], "segment": segment[some][lines], "fresh": fresh[some][lines],
            "win_start": start[places], "bucket": bucket[places], "n": np.diff(np.append(lines, len(some))),
            "total": (np.where(fits, high, 0) << 32) + (low & 0xFFFFFFFF), "fits": fits,
        }, late


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where rows in order differ from the row before; the first row does."""
    changes = np.zeros(len(columns[0]), bool)
    changes[:1] = True
    for column in columns:
        changes[1:] |= column[1:] != column[:-1]
    return changes


def _numbered(*columns: np.ndarray) -> np.ndarray:
    """Numbers, from 0, of the groups of equal rows in order."""
    return np.cumsum(_changes(*columns)) - 1


def _cut_partition(batches: Iterator[pa.RecordBatch], intervals: Sequence[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """The cells, late counts and descriptions of a task's points as rows of ``_CUT``; a trend is described once."""
    numbers: dict[tuple, int] = {}
    described: list[tuple] = []
    held: dict[str, list[np.ndarray]] = {c: [] for c in ("trend", *_NUMBERS)}
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, types = (pc.dictionary_encode(batch.column(c)) for c in SERIES)
        pairs = keys.indices.to_numpy().astype(np.int64) * len(types.dictionary) + types.indices.to_numpy()
        _, first, own = np.unique(pairs, return_index=True, return_inverse=True)
        codes = []
        for row in first.tolist():
            series = tuple(batch.column(c)[row].as_py() for c in SERIES)
            if series not in numbers:
                numbers[series] = len(numbers)
                described.append((*series, batch.column("metric")[row].as_py(), batch.column("tags")[row].as_py()))
            codes.append(numbers[series])
        held["trend"].append(np.array(codes, np.int64)[own])
        for name in _NUMBERS:
            held[name].append(batch.column(name).to_numpy(zero_copy_only=False))
    if not described:
        return
    keys, kinds, metrics, tags = (list(c) for c in zip(*described))
    yield _cut_rows(TREND, keys, kinds, metric=metrics, tags=tags)
    keys, kinds = np.array(keys, object), np.array(kinds, object)
    points = {name: np.concatenate(arrays) for name, arrays in held.items()}
    held.clear()
    for seconds, cells, late in window_cells(points, intervals):
        some = np.flatnonzero(late)
        yield _cut_rows(LATE, keys[some], kinds[some], seconds=np.full(len(some), seconds), late=late[some])
        trend = cells.pop("trend")
        # Cells are in order of trends, so a piece of a trend is a stretch of them.
        ends = np.append(np.union1d(np.flatnonzero(_changes(trend)), np.arange(0, len(trend), PIECE)), len(trend))
        for at in range(0, len(ends) - 1, 16):
            cut = ends[at : at + 17]
            of, places = trend[cut[:-1]], pa.array(cut - cut[0], pa.int32())
            arrays = {c: pa.ListArray.from_arrays(places, pa.array(v[cut[0] : cut[-1]], pa.int64())) for c, v in cells.items()}
            yield _cut_rows(CELL, keys[of], kinds[of], seconds=np.full(len(of), seconds), **arrays)


def _cut_rows(kind: str, trend_key, agg_type, **columns) -> pa.RecordBatch:
    types = {"string": pa.string(), "long": pa.int64(), "array<bigint>": pa.list_(pa.int64()), "map<string,string>": pa.map_(pa.string(), pa.string())}
    n = len(trend_key)
    columns |= {"kind": pa.repeat(kind, n), "trend_key": trend_key, "agg_type": agg_type}
    fields = [f.split() for f in _CUT.split(", ")]
    # Numbers are never null, as pandas would make floats of them.
    filled = [columns.get(f, np.zeros(n, np.int64) if t == "long" else pa.nulls(n, types[t])) for f, t in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(filled, fields)], names=[f for f, _ in fields])


class OpenWindows(StatefulProcessor):
    """Open windows of one trend. For each interval the newest ``extra_windows + 1`` windows are open."""

    def __init__(self, intervals: Sequence[tuple[int, int]]):
        self.intervals = tuple(intervals)

    def init(self, handle: StatefulProcessorHandle) -> None:
        value = "bucket array<bigint>, n array<bigint>, total array<bigint>"
        self.windows = handle.getMapState("windows", "seconds bigint, win_start bigint", value)
        self.trend = handle.getValueState("trend", "metric string, tags map<string,string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = pd.concat(list(rows), ignore_index=True)
        if not self.trend.exists():
            named = frames[frames["metric"].notna()]
            if len(named):
                self.trend.update((named["metric"].iloc[0], dict(named["tags"].iloc[0] or {})))
        open_: dict[int, dict[int, dict[int, list]]] = {s: {} for s, _ in self.intervals}
        for (seconds, start), (buckets, ns, totals) in self.windows.iterator():
            if seconds in open_:
                open_[seconds][start] = {b: [n, t] for b, n, t in zip(buckets, ns, totals)}
        stored = {(s, w) for s, held in open_.items() for w in held}
        closed, late, touched = [], {}, set()
        counted = frames[frames["kind"] == LATE].groupby("seconds")["late"].sum()
        for seconds, extra in self.intervals:
            some = frames[(frames["kind"] == CELL) & (frames["seconds"] == seconds)]
            late[seconds] = int(counted.get(seconds, 0))
            if len(some):
                # The windows of an interval are cut by it once more, which leaves them as they are.
                judged = judge(_cells_in(some), [(seconds, extra)], open_)
                closed += judged[0]
                late[seconds] += judged[1][seconds]
                touched |= judged[2]
        for place in stored:
            if place[1] not in open_[place[0]]:
                self.windows.removeKey(place)
        for seconds, start in touched:
            if start in open_[seconds]:
                held = sorted(open_[seconds][start].items())
                self.windows.updateValue(
                    (seconds, start), ([b for b, _ in held], [int(v[0]) for _, v in held], [None if v[1] is None else int(v[1]) for _, v in held])
                )
        out = [(LATE, *key, s, n, None, None, None, None, None, None) for s, n in late.items() if n]
        if closed:
            metric, tags = self.trend.get() or (None, None)
            out.append((TREND, *key, 0, 0, metric, dict(tags or {}), None, None, None, None))
        for seconds, _ in self.intervals:
            cells = [(w, b, n, t) for s, w, held in closed if s == seconds for b, (n, t) in held.items()]
            for at in range(0, len(cells), PIECE):
                out.append((CLOSED, *key, seconds, 0, None, None, *(list(c) for c in zip(*cells[at : at + PIECE]))))
        if out:
            yield pd.DataFrame(out, columns=[f.split()[0] for f in _RESULT.split(", ")])

    def close(self) -> None:
        pass


def _cells_in(rows: pd.DataFrame) -> pd.DataFrame:
    """The cells in rows of arrays, one row each."""
    cells = pd.DataFrame({c: np.concatenate([np.asarray(a, np.int64) for a in rows[c]]) for c in _CELL})
    cells["total"] = cells["total"].astype("Int64").where(cells["fits"] == 1)
    return cells.rename(columns={"win_start": "grain_start"})


def judge(
    cells: pd.DataFrame, intervals: Sequence[tuple[int, int]], open_: dict[int, dict[int, dict[int, list]]]
) -> tuple[list[tuple[int, int, dict]], dict[int, int], set[tuple[int, int]]]:
    """Runs the cells of one trend through its open windows, which are changed in place.

    Returns the windows that closed, the late points of each interval, and the windows that got points.
    """
    order = cells.sort_values(["slice", "segment", "fresh", "grain_start"], kind="stable")
    rows = list(zip(order["grain_start"].tolist(), order["bucket"].tolist(), order["n"].tolist(), order["total"].tolist()))
    closed, touched = [], set()
    late = {s: 0 for s, _ in intervals}
    for seconds, extra in intervals:
        held = open_[seconds]
        oldest = min(held) if held else None
        for minute, bucket, n, total in rows:
            # Towards zero, as the batch windows are cut.
            start = abs(minute) // seconds * seconds * (1 if minute >= 0 else -1)
            if start not in held:
                if oldest is not None and start < oldest:
                    late[seconds] += n
                    continue
                held[start] = {}
                if len(held) > extra + 1:
                    closed.append((seconds, oldest, held.pop(oldest)))
                oldest = min(held)
            touched.add((seconds, start))
            cell = held[start].setdefault(bucket, [0, 0])
            cell[0] += n
            missing = cell[1] is None or total is None or total is pd.NA or total != total
            both = None if missing else cell[1] + int(total)
            cell[1] = both if both is not None and -_LONGEST <= both < _LONGEST else None
    return closed, late, touched


def sliced_points(points: DataFrame, opts: TrendOptions) -> DataFrame:
    """The columns that are dealt: a trend, what it is called, a point's minute, bucket, whole value and arrival."""
    arrival = F.coalesce(F.col("arrival"), F.lit(BEFORE_ALL + 1))
    rows = prepared_points(with_trend_key(points), opts)
    return rows.select(
        *SERIES,
        F.call_function("div", arrival, F.lit(min(opts.arrival_block * STRETCH, _LONGEST - 1)).cast("bigint")).alias("slice"),
        "grain_start",
        F.coalesce("bucket", F.lit(NO_BUCKET).cast("bigint")).alias("bucket"),
        "amount",
        arrival.alias("arrival"),
        "metric",
        "tags",
    )


def keyed_windows(points: DataFrame, opts: TrendOptions | None = None) -> DataFrame:
    """The stream of closed cells (as arrays, see ``closed_cells``), late counts and descriptions; ``points`` need ``arrival``.

    Later batches must hold later arrivals, as offsets of a bus do. Points with the same arrival count as arriving oldest
    window first.
    """
    opts = opts or TrendOptions(emit="closed")
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sliced_points(points, opts).repartition(tasks, "trend_key", "slice")
    intervals = [(i.seconds, i.extra_windows) for i in opts.intervals]
    processor = OpenWindows(intervals)
    return (
        dealt.mapInArrow(lambda batches: _cut_partition(batches, intervals), _CUT)
        .groupBy(*SERIES)
        .transformWithStateInPandas(processor, outputStructType=_RESULT, outputMode="Append", timeMode="None")
    )


def closed_cells(rows: DataFrame) -> DataFrame:
    cells = F.arrays_zip("win_start", "bucket", "n", "total")
    return rows.where(F.col("kind") == CLOSED).select(*SERIES, "seconds", F.inline(cells))


def late_rows(rows: DataFrame) -> DataFrame:
    """Late points of a batch per trend and interval; they add up over batches."""
    return rows.where(F.col("kind") == LATE).select(*SERIES, "seconds", "late")


@contextmanager
def _settings(spark: SparkSession) -> Iterator[None]:
    """A query keeps the settings it was started with."""
    before = {name: spark.conf.get(name, None) for name in _SETTINGS}
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def run_keyed_trends(
    points: DataFrame,
    checkpoint: str,
    sinks: Sequence[Sink],
    opts: TrendOptions | None = None,
    trigger: dict | None = None,
    late_sinks: Sequence[Sink] = (),
    report: str | None = None,
) -> StreamingQuery:
    """One query for all intervals. ``late_sinks`` get the counts of late points of each batch, the table ``report`` what
    became of each sink.

    A batch that fails, in a task or in a sink, is run again from the state of the batch before, and file sinks replace what
    it wrote: nothing is lost or written twice.
    """
    opts = opts or TrendOptions(emit="closed")

    def emit(batch: DataFrame, batch_id: int) -> None:
        # Kept while the sinks are served, since computing it goes through the state.
        rows = batch.persist()
        try:
            trends = rows.where(F.col("kind") == TREND).select("trend_key", "metric", "tags")
            serve_batch(trends_from_cells(closed_cells(rows), opts, trends), sinks, batch_id, report=report)
            if late_sinks:
                serve_batch(late_rows(rows), late_sinks, batch_id, report=report and f"{report}/late")
        finally:
            rows.unpersist()

    with _settings(points.sparkSession):
        return (
            keyed_windows(points, opts)
            .writeStream.foreachBatch(emit)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


def _state(spark: SparkSession, checkpoint: str, variable: str, options: dict[str, str]) -> DataFrame:
    reader = spark.read.format("statestore").options(**options).option("path", checkpoint)
    return reader.option("stateVarName", variable).load()


def _cells_of(state: DataFrame, *more: str) -> DataFrame:
    cells = F.arrays_zip(F.col("value.bucket").alias("bucket"), F.col("value.n").alias("n"), F.col("value.total").alias("total"))
    return state.select(
        *more, F.col("key.trend_key").alias("trend_key"), F.col("key.agg_type").alias("agg_type"),
        F.col("user_map_key.seconds").alias("seconds"), F.col("user_map_key.win_start").alias("win_start"), F.inline(cells),
    )


def keyed_open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The windows a keyed query has open, as cells: its state read as a table, after the last batch or the given one."""
    options = {} if batch_id is None else {"batchId": str(batch_id)}
    with _settings(spark):
        state = _state(spark, checkpoint, "windows", options)
    return _cells_of(state.select("key", F.col("user_map_key"), F.col("user_map_value").alias("value")))


def keyed_trends(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``trend_key, metric, tags`` of every trend a keyed query knows."""
    with _settings(spark):
        state = _state(spark, checkpoint, "trend", {})
    return state.select(F.col("key.trend_key").alias("trend_key"), "value.metric", "value.tags")


def window_changes(spark: SparkSession, checkpoint: str, first: int, last: int | None = None) -> DataFrame:
    """What batches ``first`` to ``last`` did to open windows: ``batch_id, change_type`` and the window."""
    options = {"readChangeFeed": "true", "changeStartBatchId": str(first)}
    if last is not None:
        options["changeEndBatchId"] = str(last)
    with _settings(spark):
        state = _state(spark, checkpoint, "windows", options)
    return state.select(
        "batch_id", "change_type", F.col("key.trend_key").alias("trend_key"), F.col("user_map_key.seconds").alias("seconds"),
        F.col("user_map_key.win_start").alias("win_start"),
    )
