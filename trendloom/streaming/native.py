"""Trends of a stream with Spark's own watermark.

Lateness here is time behind the newest event of the whole stream, not windows seen per trend: idle
trends are closed too, and one slow trend cannot hold windows open. The state is one small row per
trend, window and value bucket, with a map-side combine before it, so a hot trend is spread over as many
state partitions as it has buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendloom import schema as S
from trendloom.operators.cells import SERIES, prepared_points
from trendloom.operators.rules import with_describing_key
from trendloom.options import TrendOptions
from trendloom.plans.trends import trends_from_cells
from trendloom.schema import Interval
from trendloom.sources.readers import with_event_time
from trendloom.sources.sinks import Sink, serve_batch


def _windowed(points: DataFrame, interval: Interval, opts: TrendOptions, delay: int | None) -> DataFrame:
    """Cells of one interval with their ``window``, closed by the watermark."""
    wait = interval.extra_windows * interval.seconds if delay is None else delay
    timed = with_event_time(prepared_points(with_describing_key(points), opts)).withWatermark("event_ts", f"{wait} seconds")
    return timed.groupBy(F.window("event_ts", f"{interval.seconds} seconds"), *SERIES, "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.try_sum("amount").alias("total")
    )


def _as_cells(windowed: DataFrame, interval: Interval) -> DataFrame:
    return windowed.select(
        *SERIES,
        F.lit(interval.seconds).cast("bigint").alias("seconds"),
        F.unix_seconds("window.start").alias("win_start"),
        "bucket",
        "n",
        "total",
    )


def native_cells(
    points: DataFrame, interval: Interval, opts: TrendOptions | None = None, delay: int | None = None
) -> DataFrame:
    """Streaming cells of one interval. ``delay`` in seconds defaults to the interval's extra windows."""
    return _as_cells(_windowed(points, interval, opts or TrendOptions(), delay), interval)


def rolled_cells(
    points: DataFrame, interval: Interval, opts: TrendOptions | None = None, delay: int | None = None
) -> DataFrame:
    """Streaming cells of a longer interval, summed from the closed windows of the shortest one.

    One lateness, that of the shortest interval, then holds for both; the longer windows only keep the
    bucket counts of windows that are already closed.
    """
    opts = opts or TrendOptions()
    base = min(opts.intervals, key=lambda i: i.seconds)
    if interval.seconds % base.seconds:
        raise ValueError(f"{interval.name} is not made of whole {base.name} windows")
    fine = _windowed(points, base, opts, delay)
    coarse = fine.groupBy(
        F.window(F.window_time("window"), f"{interval.seconds} seconds"), *SERIES, "bucket"
    ).agg(F.sum("n").alias("n"), F.try_sum("total").alias("total"))
    return _as_cells(coarse, interval)


def count_stream(
    points: DataFrame, interval: Interval, opts: TrendOptions | None = None, delay: int | None = None
) -> DataFrame:
    """Streaming counts of one interval, one row per closed trend window."""
    cells = native_cells(points, interval, opts, delay)
    counts = cells.where(F.col("agg_type") == S.AGG_COUNT)
    return counts.select("trend_key", "seconds", "win_start", F.col("total").alias("count"))


def start_native_trend(
    points: DataFrame,
    interval: Interval,
    checkpoint: str,
    sinks: Sequence[Sink],
    opts: TrendOptions | None = None,
    trigger: dict | None = None,
    delay: int | None = None,
    report: str | None = None,
) -> StreamingQuery:
    """One query for one interval. ``report`` is a table for what became of each sink, see ``sinks.read_report``.

    All cells of a window leave the state together, so a batch can rank them."""
    opts = opts or TrendOptions()
    cells = native_cells(points, interval, opts, delay)

    def emit(batch: DataFrame, batch_id: int) -> None:
        rows = trends_from_cells(batch, opts)
        serve_batch(rows, sinks, batch_id, f"interval_s={interval.seconds}/", report)

    return (
        cells.writeStream.outputMode("append")
        .foreachBatch(emit)
        .option("checkpointLocation", f"{checkpoint}/{interval.name}")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def run_native_trends(
    points: DataFrame,
    checkpoint: str,
    sinks: Sequence[Sink],
    opts: TrendOptions | None = None,
    trigger: dict | None = None,
    report: str | None = None,
) -> list[StreamingQuery]:
    """One query per interval, since a query has one watermark and the intervals wait differently."""
    opts = opts or TrendOptions()
    return [start_native_trend(points, i, checkpoint, sinks, opts, trigger, report=report) for i in opts.intervals]


def in_flight(spark: SparkSession, checkpoint: str, interval: Interval, operator: int = 0) -> DataFrame:
    """The windows a native query has open: its state, read as a table."""
    state = spark.read.format("statestore").option("operatorId", operator).load(f"{checkpoint}/{interval.name}")
    return state.select(
        F.col("key.trend_key").alias("trend_key"),
        F.col("key.agg_type").alias("agg_type"),
        F.lit(interval.seconds).cast("bigint").alias("seconds"),
        F.unix_seconds(F.col("key.window.start")).alias("win_start"),
        F.col("key.bucket").alias("bucket"),
        F.col("value.count").alias("n"),
        F.col("value.sum").alias("total"),
    )
