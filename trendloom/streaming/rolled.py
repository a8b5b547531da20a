"""All intervals of a stream of spans from one reading and one grouping of them.

The spans are grouped once, by names, error flag, minute and duration bucket, so a span is one keyed row whatever the number
of its trends and intervals. Closed minutes become cells in a table; each longer interval is a small query over that table.
The table of minutes grows in order of time, so the longer windows need no wait of their own: a window closes when a later
minute has closed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trendloom.operators.cells import SERIES, tally_spans, trend_total
from trendloom.operators.filters import valid_spans
from trendloom.options import TrendOptions
from trendloom.plans.trends import trends_from_cells
from trendloom.schema import Interval
from trendloom.sources.sinks import Sink, serve_batch

MINUTE_SCHEMA = T.StructType(
    [
        T.StructField("trend_key", T.StringType()),
        T.StructField("agg_type", T.StringType()),
        T.StructField("grain_start", T.LongType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("total", T.LongType()),
    ]
)


def minute_cells(spans: DataFrame, opts: TrendOptions, delay: int) -> DataFrame:
    """The stream of cells of closed minutes; ``delay`` in seconds is how long a minute waits for late spans.

    The watermark goes by the minutes of spans: a minute closes when one that starts ``delay`` seconds after its end is seen.
    """
    tally = tally_spans(valid_spans(spans, opts.deny), opts)
    timed = tally.rows.withColumn("minute", F.timestamp_seconds("grain_start")).withWatermark("minute", f"{delay} seconds")
    part = [c for c in tally.part if c != "grain_start"]
    groups = timed.groupBy(F.window("minute", f"{opts.grain} seconds"), *part).agg(
        F.count(F.lit(1)).alias("n"), F.try_sum("amount").alias("total")
    )
    closed = groups.withColumn("grain_start", F.unix_seconds("window.start")).drop("window")
    return tally.spread(closed).select(*SERIES, "grain_start", "bucket", "n", trend_total().alias("total"))


def read_minutes(spark: SparkSession, folder: str, streaming: bool = False) -> DataFrame:
    """The table of closed minutes."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(MINUTE_SCHEMA).parquet(f"{folder}/minutes")


def interval_cells(minutes: DataFrame, interval: Interval, grain: int) -> DataFrame:
    """Cells of one interval from the stream of minutes, a window at a time."""
    seconds = F.lit(interval.seconds).cast("bigint").alias("seconds")
    if interval.seconds == grain:
        return minutes.select(*SERIES, seconds, F.col("grain_start").alias("win_start"), "bucket", "n", "total")
    timed = minutes.withColumn("minute", F.timestamp_seconds("grain_start")).withWatermark("minute", "0 seconds")
    rolled = timed.groupBy(F.window("minute", f"{interval.seconds} seconds"), *SERIES, "bucket").agg(
        F.sum("n").alias("n"), F.try_sum("total").alias("total")
    )
    return rolled.select(*SERIES, seconds, F.unix_seconds("window.start").alias("win_start"), "bucket", "n", "total")


def _emitter(interval: Interval, opts: TrendOptions, sinks: Sequence[Sink], report: str | None) -> Callable[[DataFrame, int], None]:
    def emit(batch: DataFrame, batch_id: int) -> None:
        # A minute's groups are several cells of one bucket; they add up before they are ranked.
        cells = batch.groupBy(*SERIES, "seconds", "win_start", "bucket").agg(F.sum("n").alias("n"), F.try_sum("total").alias("total"))
        serve_batch(trends_from_cells(cells, opts), sinks, batch_id, f"interval_s={interval.seconds}/", report)

    return emit


def start_minutes(spans: DataFrame, folder: str, opts: TrendOptions, delay: int | None = None, trigger: dict | None = None) -> StreamingQuery:
    """The query that reads the spans; ``delay`` defaults to the extra windows of the shortest interval."""
    shortest = min(opts.intervals, key=lambda i: i.seconds)
    wait = shortest.extra_windows * shortest.seconds if delay is None else delay
    return (
        minute_cells(spans, opts, wait)
        .writeStream.format("parquet")
        .option("path", f"{folder}/minutes")
        .option("checkpointLocation", f"{folder}/checkpoint/minutes")
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_intervals(spark: SparkSession, folder: str, sinks: Sequence[Sink], opts: TrendOptions, trigger: dict | None = None, report: str | None = None) -> list[StreamingQuery]:
    """One query for each interval over the table of minutes; the table must be there."""
    queries = []
    for interval in opts.intervals:
        cells = interval_cells(read_minutes(spark, folder, streaming=True), interval, opts.grain)
        queries.append(
            cells.writeStream.foreachBatch(_emitter(interval, opts, sinks, report))
            .option("checkpointLocation", f"{folder}/checkpoint/{interval.name}")
            .outputMode("append")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    return queries


def run_rolled_trends(spans: DataFrame, folder: str, sinks: Sequence[Sink], opts: TrendOptions | None = None, delay: int | None = None, report: str | None = None) -> None:
    """Everything there is to read, once: first the minutes, then all intervals."""
    opts = opts or TrendOptions()
    start_minutes(spans, folder, opts, delay).awaitTermination()
    for query in start_intervals(spans.sparkSession, folder, sinks, opts, report=report):
        query.awaitTermination()
