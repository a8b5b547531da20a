"""Registered streams over several batches: spans are added to the source in parts, and a query is started anew for each."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.queries import DENY, Query, _long, _named, event_spans
from trendloom import schema as S
from trendloom.functions.keys import flat_tags
from trendloom.operators.active import active_in_windows, merged_bitmaps, numbered_trends, trend_bitmaps
from trendloom.operators.cells import interval_name, roll_up, span_cells
from trendloom.operators.filters import valid_spans
from trendloom.operators.packed import merged, packed, percentiles
from trendloom.operators.points import typed_points
from trendloom.operators.quality import observe_points
from trendloom.options import TrendOptions
from trendloom.plans.trends import point_trends
from trendloom.session import shared_folder, written
from trendloom.sources.readers import read_points, read_spans
from trendloom.sources.sinks import Sink, read_report, write_points
from trendloom.sources.stored import store_points, stored_trends
from trendloom.streaming.app import points_of_spans, start_span_app
from trendloom.streaming.keyed import keyed_open_windows, run_keyed_trends
from trendloom.streaming.measures import balance, measures_of_query
from trendloom.streaming.native import in_flight, native_cells
from trendloom.streaming.rolled import run_rolled_trends

PARTS = 4


def _in_parts(rows: DataFrame, by: str, folder: str, parts: int = PARTS) -> Iterator[int]:
    """Adds the rows to the folder in stretches of a column of equal width, and pauses after each.

    The rows are dealt once and the parts then copied, so that a part has files for all cores whatever files the table has.
    """
    spark = rows.sparkSession
    low, high = rows.agg(F.min(by), F.max(by)).first()
    low, high = low or 0, high or 0
    width = (high - low) // parts + 1
    numbered = rows.withColumn("part", F.call_function("div", F.col(by) - low, F.lit(width).cast("bigint")).cast("int"))
    dealt = shared_folder(spark, "parts")
    numbered.repartition(spark.sparkContext.defaultParallelism, by).write.partitionBy("part").parquet(dealt)
    for part in range(parts):
        copied = spark.read.schema(numbered.schema).parquet(dealt).where(F.col("part") == part)
        copied.select(*rows.columns).write.mode("append").parquet(folder)
        yield part


def _spans_in_parts(spark: SparkSession, sf_dir: str, folder: str, by: str) -> Iterator[DataFrame]:
    """The stream of spans, each time one more part is there."""
    for _ in _in_parts(event_spans(spark, sf_dir).drop("event_id"), by, f"{folder}/spans"):
        yield read_spans(spark, f"{folder}/spans", streaming=True)


def _keyed(spark: SparkSession, sf_dir: str, opts: TrendOptions, failing: bool = False) -> str:
    """Runs the strict rule with keyed state over all parts, in order of arrival, and returns its folder."""
    folder = shared_folder(spark, "stream-keyed")
    rows, late = Sink("rows", path=f"{folder}/rows"), Sink("late", path=f"{folder}/late")
    for spans in _spans_in_parts(spark, sf_dir, folder, "arrival"):
        points = typed_points(valid_spans(spans, opts.deny), opts)
        if failing:
            # The batch has read and written its state and one sink has its rows when the other sink fails.
            stopped = run_keyed_trends(points, f"{folder}/checkpoint", [rows, Sink("broken", format="no-such-format")], opts)
            if _failed(stopped) is None:
                raise RuntimeError("the batch should have failed")
        run_keyed_trends(points, f"{folder}/checkpoint", [rows], opts, late_sinks=[late]).awaitTermination()
    return folder


def _failed(query) -> Exception | None:
    try:
        query.awaitTermination()
    except Exception as failure:  # noqa: BLE001 - any failure of the query is what is asked for
        return failure
    return None


def q_stream_keyed(spark, sf_dir):
    """Strict mode with keyed state, over parts: what closed windows hold, at all intervals and levels."""
    folder = _keyed(spark, sf_dir, TrendOptions(emit="closed"))
    return _long(spark.read.parquet(f"{folder}/rows").drop("batch_id"))


def q_stream_restart(spark, sf_dir):
    """The same when every batch fails in a sink at first and is run again after a restart."""
    folder = _keyed(spark, sf_dir, TrendOptions(emit="closed", service_level=False), failing=True)
    return _long(spark.read.parquet(f"{folder}/rows").drop("batch_id"))


def q_stream_keyed_late(spark, sf_dir):
    """Late points of a running strict stream, per trend and interval."""
    folder = _keyed(spark, sf_dir, TrendOptions(emit="closed"))
    late = spark.read.parquet(f"{folder}/late").groupBy("trend_key", "seconds").agg(F.sum("late").alias("late"))
    return late.select("trend_key", interval_name(F.col("seconds"), S.INTERVALS).alias("interval"), "late")


def q_stream_open(spark, sf_dir):
    """The windows that a stopped strict stream has open, read from its state."""
    folder = _keyed(spark, sf_dir, TrendOptions(emit="closed"))
    windows = keyed_open_windows(spark, f"{folder}/checkpoint").groupBy("trend_key", "seconds", "win_start")
    return _named(windows.agg(F.sum("n").alias("points"), F.sum("total").alias("total")), "points", "total")


def q_stream_rolled(spark, sf_dir):
    """All intervals of a stream from one grouping of its spans, with statistics and counts."""
    folder = shared_folder(spark, "stream-rolled")
    for spans in _spans_in_parts(spark, sf_dir, folder, "start_time_us"):
        run_rolled_trends(spans, f"{folder}/job", [Sink("rows", path=f"{folder}/rows")])
    return _long(spark.read.parquet(f"{folder}/rows").drop("batch_id", "interval_s"))


def q_stream_span_app(spark, sf_dir):
    """The span app over parts: deny list, points, keyed storage."""
    folder = shared_folder(spark, "span-app")
    for spans in _spans_in_parts(spark, sf_dir, folder, "arrival"):
        start_span_app(spans, f"{folder}/points", f"{folder}/checkpoint", TrendOptions(deny=DENY), buckets=8).awaitTermination()
    points = read_points(spark, f"{folder}/points")
    return points.select("trend_key", "metric", flat_tags(F.col("tags")).alias("tags"), "value", "ts_sec", "arrival")


def q_stream_late(spark, sf_dir):
    """What became of the points of a stream with a watermark: its observed counts, and points closed, open and too late."""
    folder = shared_folder(spark, "stream-late")
    opts = TrendOptions(intervals=S.INTERVALS[:1])
    interval = S.INTERVALS[0]
    measures = None
    for spans in _spans_in_parts(spark, sf_dir, folder, "arrival"):
        points = observe_points(points_of_spans(spans, opts), "points")
        query = (
            native_cells(points, interval, opts)
            .writeStream.format("parquet").option("path", f"{folder}/cells").option("checkpointLocation", f"{folder}/checkpoint/{interval.name}")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        some = measures_of_query(query).where(F.col("measure").startswith("points."))
        measures = some if measures is None else measures.unionByName(some)
    seen = measures.groupBy("measure").agg(F.sum("value").alias("value"))
    closed = spark.read.parquet(f"{folder}/cells")
    arrived = seen.where("measure = 'points.points' OR measure = 'points.invalid_points'").select(
        F.lit("all").alias("part"), F.when(F.col("measure") == "points.points", F.col("value")).otherwise(-F.col("value")).alias("n")
    )
    whole = [df.select(F.lit("all").alias("part"), "n") for df in (closed, in_flight(spark, f"{folder}/checkpoint", interval))]
    counted = balance(arrived, *whole, by="part")
    return seen.unionByName(counted.select(F.expr("stack(3, 'closed', closed, 'open', open, 'late', late) AS (measure, value)")))


def q_stream_failures(spark, sf_dir):
    """What became of the sinks of a stream, one of them optional and broken, over all batches."""
    folder = shared_folder(spark, "stream-failures")
    sinks = [Sink("rows", path=f"{folder}/rows"), Sink("broken", format="no-such-format", optional=True)]
    for spans in _spans_in_parts(spark, sf_dir, folder, "arrival"):
        start_span_app(spans, f"{folder}/points", f"{folder}/checkpoint", sinks=sinks, report=f"{folder}/report").awaitTermination()
    told = read_report(spark, f"{folder}/report").groupBy("sink", "optional")
    return told.agg(F.count(F.lit(1)).alias("batches"), F.count_if(~F.col("ok")).alias("failures"), F.sum("rows").alias("rows"))


def q_stream_since(spark, sf_dir):
    """A stream of files that begins at a moment: what was written before it is left out."""
    folder = shared_folder(spark, "stream-since")
    moment = None
    for part in _in_parts(event_spans(spark, sf_dir).drop("event_id"), "arrival", f"{folder}/spans", 2):
        if part == 0:
            newest = spark.read.parquet(f"{folder}/spans").select(F.max(F.unix_micros("_metadata.file_modification_time"))).first()[0]
            moment = datetime.fromtimestamp((newest or 0) / 1_000_000 + 0.001, timezone.utc)
            time.sleep(0.01)
    spans = read_spans(spark, f"{folder}/spans", streaming=True, start=moment)
    start_span_app(spans, f"{folder}/points", f"{folder}/checkpoint", buckets=8).awaitTermination()
    points = read_points(spark, f"{folder}/points")
    return points.select("trend_key", "value", "ts_sec", "arrival")


def q_own_keys(spark, sf_dir):
    """Trends of stored points whose keys are their own and tell nothing: metric and tags come from the points."""
    folder = shared_folder(spark, "own-keys")
    points = points_of_spans(event_spans(spark, sf_dir))
    write_points(points.withColumn("trend_key", F.md5("trend_key")), folder, buckets=8)
    return _long(point_trends(read_points(spark, folder), TrendOptions(intervals=S.INTERVALS[2:])))


def q_stored_trends(spark, sf_dir):
    """Trends of points stored in a bucketed table, at all intervals and levels."""
    folder = shared_folder(spark, "stored")
    table = "points_" + folder.rsplit("-", 1)[1]
    points = points_of_spans(event_spans(spark, sf_dir))
    store_points(points.withColumn("trend_key", F.md5("trend_key")), table, folder, buckets=8)
    return _long(stored_trends(spark.table(table)))


def _stored_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    opts = TrendOptions()
    return roll_up(span_cells(valid_spans(event_spans(spark, sf_dir)), opts), S.INTERVALS[:1])


def q_packed_percentiles(spark, sf_dir):
    """Percentiles chosen when packed minutes are read back and merged."""
    minutes = written(packed(_stored_minutes(spark, sf_dir)), "packed")
    asked = percentiles(merged(minutes, [i.seconds for i in S.INTERVALS]), (10, 50, 95, 99, 100))
    return _named(asked, "points", "p10", "p50", "p95", "p99", "p100")


def q_active_windows(spark, sf_dir):
    """Distinct trends of every window, by merging the bitmaps of its minutes."""
    minutes = written(_stored_minutes(spark, sf_dir), "minutes")
    bitmaps = written(trend_bitmaps(minutes, numbered_trends(minutes)), "bitmaps")
    active = active_in_windows(merged_bitmaps(bitmaps, [i.seconds for i in S.INTERVALS]))
    return active.select("agg_type", interval_name(F.col("seconds"), S.INTERVALS).alias("interval"), (F.col("win_start") + F.col("seconds")).alias("ts_sec"), "trends")


STREAMS: dict[str, Callable[[SparkSession, str], DataFrame] | Query] = {
    "stream_keyed": q_stream_keyed,
    "stream_restart": q_stream_restart,
    "stream_keyed_late": q_stream_keyed_late,
    "stream_open": q_stream_open,
    "stream_rolled": q_stream_rolled,
    "stream_span_app": q_stream_span_app,
    "stream_late": q_stream_late,
    "stream_failures": q_stream_failures,
    "stream_since": q_stream_since,
    "own_keys": q_own_keys,
    "stored_trends": q_stored_trends,
    "packed_percentiles": q_packed_percentiles,
    "active_windows": q_active_windows,
}
