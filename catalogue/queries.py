"""Registered queries: every operator over whole tables, with maps flattened to text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom import schema as S
from trendloom.functions import histogram as H
from trendloom.functions.encoding import encode_name
from trendloom.functions.keys import flat_tags, trend_key
from trendloom.functions.spans import has_names, is_denied, is_error
from trendloom.operators.aggregates import DEFAULT_AGGREGATES, Aggregate
from trendloom.operators.cells import (
    assign_windows,
    interval_name,
    point_cells,
    roll_up,
    span_cells,
    tally_points,
)
from trendloom.operators.filters import is_valid_point, valid_spans
from trendloom.operators.lateness import accepted_cells, late_counts
from trendloom.operators.points import DEFAULT_TRANSFORMERS, PointSpec, to_points, typed_points
from trendloom.operators.quality import active_trends, quality_summary, time_in_topic
from trendloom.operators.rules import DEFAULT_RULES, Rule, classify
from trendloom.operators.stats import window_stats
from trendloom.options import HistogramOptions, TrendOptions
from trendloom.plans.trends import point_trends, span_trends, strict_span_trends, tally_of_spans
from trendloom.sources.readers import broken_messages, decode_messages, read_points, read_spans
from trendloom.sources.sinks import Sink, require_all, to_messages, write_fanout, write_points
from trendloom.sources.tables import spans_from_events, spans_from_lineitem
from trendloom.session import shared_folder, with_small_tasks
from trendloom.streaming.native import count_stream, run_native_trends
from trendloom.streaming.strict import run_strict_trends

DENY = ("^svc\\.[01]$", "7")
EXTRA_TAGS = '{"k1": "v1", "product": "override"}'
ONE_MINUTE = S.INTERVALS[:1]
LINE_BLOCK = 60 * 2**44

Query = Callable[[SparkSession, str], DataFrame]


def event_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    with_small_tasks(spark)
    return spans_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def line_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_small_tasks(spark)
    return spans_from_lineitem(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def _event_points(spark: SparkSession, sf_dir: str, opts: TrendOptions | None = None) -> DataFrame:
    return to_points(valid_spans(event_spans(spark, sf_dir)), opts, keep=["event_id"])


def _flat(points: DataFrame) -> DataFrame:
    return points.withColumn("tags", flat_tags(F.col("tags")))


def _named(df: DataFrame, *stats: str) -> DataFrame:
    """Trend, interval name and window end, with the chosen columns."""
    return df.select(
        "trend_key",
        interval_name(F.col("seconds"), S.INTERVALS).alias("interval"),
        (F.col("win_start") + F.col("seconds")).alias("ts_sec"),
        *stats,
    )


HISTOGRAM_COLUMNS = ("mean", "min", "p95", "p99", "std", "p50", "max")


# Spans


def q_valid_spans(spark, sf_dir):
    return valid_spans(event_spans(spark, sf_dir)).select("event_id", "service_name", "operation_name")


def q_denied_spans(spark, sf_dir):
    spans = event_spans(spark, sf_dir).where(has_names())
    return spans.select("event_id", "service_name", is_denied(DENY).alias("denied"))


def q_allowed_spans(spark, sf_dir):
    return valid_spans(event_spans(spark, sf_dir), DENY).select("event_id", "service_name")


def q_span_status(spark, sf_dir):
    return event_spans(spark, sf_dir).select("event_id", is_error().alias("error"))


# Points


def _points_of(metric: Column) -> Query:
    def run(spark, sf_dir):
        points = _flat(_event_points(spark, sf_dir, TrendOptions(service_level=False)))
        return points.where(metric()).select("event_id", "metric", "tags", "value", "ts_sec")

    return run


def q_all_points(spark, sf_dir):
    return _flat(_event_points(spark, sf_dir)).select("event_id", "metric", "tags", "value", "ts_sec")


def _encoded(encoder: str) -> Query:
    def run(spark, sf_dir):
        return event_spans(spark, sf_dir).select(
            "event_id",
            encode_name(F.col("service_name"), encoder).alias("service"),
            encode_name(F.col("operation_name"), encoder).alias("operation"),
        )

    return run


def q_trend_keys(spark, sf_dir):
    points = _event_points(spark, sf_dir)
    return points.select("event_id", trend_key(F.col("metric"), F.col("tags")).alias("trend_key"))


def _mixed_points(spark, sf_dir):
    """Names that hit each rule, two rules at once, none, and a type that is not a gauge."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    case = F.col("event_id") % 8
    name = (
        F.when(case == 0, F.lit("Success-Span"))
        .when(case == 1, F.lit("failure-span"))
        .when(case == 2, F.lit("DURATION"))
        .when(case == 3, F.lit("p.latency"))
        .when(case == 4, F.lit("success-span-duration"))
        .when(case == 5, F.lit("latency-failure-span"))
        .when(case == 6, F.lit("received"))
        .otherwise(F.lit("duration"))
    )
    mtype = F.when(F.col("event_id") % 5 == 0, F.lit("count")).otherwise(F.lit("Gauge"))
    metric = F.concat(name, F.lit("."), F.col("event_type"))
    return events.select("event_id", metric.alias("metric"), F.create_map(F.lit("mtype"), mtype).alias("tags"))


def q_classify(spark, sf_dir):
    return classify(_mixed_points(spark, sf_dir)).select("event_id", "metric", "agg_type")


def q_own_rule(spark, sf_dir):
    """A rule of one's own before the standard ones."""
    rules = (Rule("received", S.AGG_COUNT, "count"), Rule("latency", S.AGG_COUNT), *DEFAULT_RULES)
    return classify(_mixed_points(spark, sf_dir), rules).select("event_id", "metric", "agg_type")


def q_own_transformer(spark, sf_dir):
    """A third kind of point beside the standard ones, for slow spans only."""

    def slow() -> PointSpec:
        value = F.col("duration_us").cast("double") * 2
        return PointSpec(F.lit("slow-latency"), value, "microseconds", tags={"slow": F.lit("yes")}, when=F.col("duration_us") > 5_000_000)

    opts = TrendOptions(transformers=(*DEFAULT_TRANSFORMERS, slow), service_level=False)
    points = _event_points(spark, sf_dir, opts).where(F.col("metric") == "slow-latency")
    return _flat(points).select("event_id", "metric", "tags", "value", "ts_sec")


def q_own_aggregate(spark, sf_dir):
    """The largest value of a window, by an aggregate and a rule of one's own."""
    largest = Aggregate("Largest", {"largest": "largest"}, lambda _: {"largest": F.max("bucket")}, lambda value, _: value)
    opts = TrendOptions(rules=(*DEFAULT_RULES, Rule("queue", "Largest", "level")), aggregates=(*DEFAULT_AGGREGATES, largest))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    points = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat(F.lit("queue-depth."), F.col("event_type")).alias("metric"),
        F.create_map(F.lit("mtype"), F.lit("level")).alias("tags"),
        (F.col("user_id") % 8 + 1).cast("double").alias("value"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts_sec"),
    )
    return _long(point_trends(points, opts))


def q_span_source(spark, sf_dir):
    """Spans stored as JSON and read back by the span source."""
    folder = shared_folder(spark, "spans")
    event_spans(spark, sf_dir).drop("event_id").write.json(folder)
    spans = read_spans(spark, folder, format="json")
    return spans.select("service_name", "operation_name", "start_time_us", "duration_us", is_error().alias("error"), "arrival")


def q_bad_messages(spark, sf_dir):
    """Messages of spans, a stated part of them damaged or empty: how many are read, and how many are left out."""
    spans = event_spans(spark, sf_dir)
    body = F.to_json(F.struct(*[c for c in spans.columns if c != "event_id"]))
    sent = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("x"), body)).when(F.col("event_id") % 25 != 1, body)
    raw = spans.select(sent.cast("binary").alias("value"))
    kept = decode_messages(raw, S.SPAN_SCHEMA).select(F.lit("kept").alias("part"), "service_name")
    broken = broken_messages(raw, S.SPAN_SCHEMA).select(F.lit("broken").alias("part"), F.lit(None).cast("string").alias("service_name"))
    return kept.union(broken).groupBy("part", "service_name").agg(F.count(F.lit(1)).alias("messages"))


def q_valid_points(spark, sf_dir):
    """Points with signed, zero and not-a-number values."""
    points = _event_points(spark, sf_dir, TrendOptions(service_level=False))
    value = (
        F.when(F.col("event_id") % 11 == 0, -F.col("value"))
        .when(F.col("event_id") % 13 == 0, F.lit(float("nan")))
        .otherwise(F.col("value"))
    )
    key = F.when(F.col("event_id") % 17 != 0, F.col("trend_key"))
    checked = points.withColumn("value", value).withColumn("trend_key", key)
    return checked.select("event_id", "metric", is_valid_point().alias("valid"))


def q_window_assign(spark, sf_dir):
    points = _event_points(spark, sf_dir, TrendOptions(service_level=False)).where(F.col("metric") == "duration")
    named = assign_windows(points, S.INTERVALS).withColumn("interval", interval_name(F.col("seconds"), S.INTERVALS))
    return named.select("event_id", "ts_sec", "interval", "win_start", "win_end")


# Aggregations


def q_count_trends_multi(spark, sf_dir):
    opts = TrendOptions()
    cells = roll_up(span_cells(valid_spans(event_spans(spark, sf_dir)), opts), opts.intervals)
    counts = cells.where(F.col("agg_type") == S.AGG_COUNT)
    return _named(counts, F.col("total").alias("count"))


def q_service_rollup(spark, sf_dir):
    """Success and failure counts per service and operation, and per service alone, in one grouping."""
    spans = valid_spans(event_spans(spark, sf_dir)).select(
        encode_name(F.col("service_name"), "period").alias("service"),
        encode_name(F.col("operation_name"), "period").alias("operation"),
        F.expr("start_time_us div 60000000 * 60").alias("win_start"),
        is_error().alias("error"),
    )
    sets = [["service", "operation", "win_start"], ["service", "win_start"]]
    return spans.groupingSets(
        [[F.col(c) for c in group] for group in sets], F.col("service"), F.col("operation"), F.col("win_start")
    ).agg(F.count_if(~F.col("error")).alias("successes"), F.count_if("error").alias("failures"))


def q_hist_buckets(spark, sf_dir):
    opts = HistogramOptions()
    held = H.recorded(F.col("duration_us"), opts)
    spans = event_spans(spark, sf_dir).select("event_id", held.alias("recorded"))
    low = spans.withColumn("low", H.bucket_low(F.col("recorded"), opts))
    return low.withColumn("middle", H.bucket_middle(F.col("low"), opts))


def _line_cells(spark, sf_dir, opts: TrendOptions) -> DataFrame:
    return roll_up(span_cells(valid_spans(line_spans(spark, sf_dir)), opts), opts.intervals)


def _duration_stats(opts: TrendOptions) -> Query:
    def run(spark, sf_dir):
        cells = _line_cells(spark, sf_dir, opts).where(F.col("agg_type") == S.AGG_HISTOGRAM)
        return _named(window_stats(cells, opts), "points", *HISTOGRAM_COLUMNS)

    return run


def q_point_cells(spark, sf_dir):
    """Cells of the one-minute grain, counted from the points themselves."""
    points = typed_points(valid_spans(line_spans(spark, sf_dir)))
    return point_cells(points, TrendOptions()).select("trend_key", "grain_start", "bucket", "n", "total")


def _long(df: DataFrame) -> DataFrame:
    return _flat(df).select("out_key", "metric", "tags", "value", "ts_sec")


def q_stats_long(spark, sf_dir):
    return _long(span_trends(event_spans(spark, sf_dir)))


def q_extra_tags(spark, sf_dir):
    opts = TrendOptions(extra_tags=EXTRA_TAGS, intervals=ONE_MINUTE)
    return _long(span_trends(event_spans(spark, sf_dir), opts))


def q_point_trends(spark, sf_dir):
    """Trends of service-level points, aggregated from points read back from storage."""
    opts = TrendOptions(intervals=S.INTERVALS[2:])
    folder = shared_folder(spark, "points")
    write_points(_event_points(spark, sf_dir).drop("event_id"), folder, buckets=8)
    points = read_points(spark, folder)
    return _long(point_trends(points.where(F.try_element_at("tags", F.lit("operationName")).isNull()), opts))


# Lateness


def _of_kind(cells: DataFrame, agg_type: str) -> DataFrame:
    return cells.where(F.col("agg_type") == agg_type)


def q_strict_counts(spark, sf_dir):
    opts = TrendOptions(emit="closed").limited(S.AGG_COUNT)
    cells = accepted_cells(tally_of_spans(event_spans(spark, sf_dir), opts), opts)
    return _named(window_stats(cells, opts), "points", "count")


def q_strict_duration(spark, sf_dir):
    opts = TrendOptions(emit="closed").limited(S.AGG_HISTOGRAM)
    cells = accepted_cells(tally_of_spans(event_spans(spark, sf_dir), opts), opts)
    return _named(window_stats(cells, opts), "points", *HISTOGRAM_COLUMNS)


def q_strict_dense(spark, sf_dir):
    """Strict mode over dense spans, where slices of arrival are cut by closing windows."""
    opts = TrendOptions(emit="all", arrival_block=LINE_BLOCK).limited(S.AGG_HISTOGRAM)
    cells = accepted_cells(tally_of_spans(line_spans(spark, sf_dir), opts), opts)
    return _named(window_stats(cells, opts), "points", *HISTOGRAM_COLUMNS)


def q_strict_points(spark, sf_dir):
    """Strict mode over points instead of spans, as when they are read back from a bus."""
    opts = TrendOptions(emit="closed", intervals=S.INTERVALS[:2], arrival_block=LINE_BLOCK, service_level=False)
    points = typed_points(valid_spans(line_spans(spark, sf_dir)), opts).where(F.col("metric") == "duration")
    cells = accepted_cells(tally_points(points, opts), opts)
    return _named(window_stats(cells, opts), "points", *HISTOGRAM_COLUMNS)


def q_strict_long(spark, sf_dir):
    opts = TrendOptions(emit="closed", intervals=S.INTERVALS[1:2], extra_tags=EXTRA_TAGS)
    return _long(strict_span_trends(event_spans(spark, sf_dir), opts))


def q_late_points(spark, sf_dir):
    opts = TrendOptions(arrival_block=LINE_BLOCK)
    counted = late_counts(tally_of_spans(line_spans(spark, sf_dir), opts), opts)
    return counted.withColumn("interval", interval_name(F.col("seconds"), S.INTERVALS)).drop("seconds")


def q_closed_vs_all(spark, sf_dir):
    """Windows with accepted points, and how many of them are closed, per interval."""
    opts = TrendOptions(emit="all", service_level=False)
    cells = accepted_cells(tally_of_spans(event_spans(spark, sf_dir), opts), opts)
    windows = _of_kind(cells, S.AGG_HISTOGRAM).select("trend_key", "seconds", "win_start", "closed").distinct()
    counted = windows.groupBy("seconds").agg(
        F.count(F.lit(1)).alias("windows"), F.count_if("closed").alias("closed_windows")
    )
    return counted.withColumn("interval", interval_name(F.col("seconds"), S.INTERVALS)).drop("seconds")


# Measures


def q_quality_summary(spark, sf_dir):
    return quality_summary(event_spans(spark, sf_dir), TrendOptions(deny=DENY))


def q_time_in_topic(spark, sf_dir):
    return time_in_topic(_event_points(spark, sf_dir))


def q_active_trends(spark, sf_dir):
    return active_trends(typed_points(valid_spans(event_spans(spark, sf_dir))))


# Sinks


def q_keyed_sink(spark, sf_dir):
    """Points written by trend and read back: all rows there, each trend in one bucket."""
    folder = shared_folder(spark, "keyed")
    write_points(to_points(valid_spans(line_spans(spark, sf_dir))), folder, buckets=16)
    stored = spark.read.parquet(folder)
    return stored.groupBy("trend_key").agg(
        F.count(F.lit(1)).alias("points"), F.count_distinct("key_bucket").alias("buckets")
    )


def q_message_sink(spark, sf_dir):
    """Aggregated rows in message form, taken apart again."""
    opts = TrendOptions(intervals=S.INTERVALS[3:])
    messages = to_messages(span_trends(event_spans(spark, sf_dir), opts), "out_key")
    body = F.from_json("value", "metric string, tags map<string,string>, value double, ts_sec bigint")
    rows = messages.select(F.col("key").alias("out_key"), body.alias("b")).select("out_key", "b.*")
    return _long(rows)


def q_sink_fanout(spark, sf_dir):
    """Two enabled sinks and one disabled, and what arrived in each."""
    rows = span_trends(event_spans(spark, sf_dir), TrendOptions(intervals=S.INTERVALS[3:]))
    columns, messages = shared_folder(spark, "columns"), shared_folder(spark, "messages")
    results = write_fanout(
        rows,
        [
            Sink("columns", path=columns),
            Sink("messages", format="json", path=messages, as_messages=True),
            Sink("off", path=shared_folder(spark, "off"), enabled=False),
        ],
    )
    failed = [r for r in results if not r["ok"]]
    if failed:
        raise RuntimeError(str(failed))
    stored = spark.read.parquet(columns).select(F.lit("columns").alias("sink"), F.col("out_key"))
    sent = spark.read.schema("key string, value string").json(messages)
    both = stored.unionByName(sent.select(F.lit("messages").alias("sink"), F.col("key").alias("out_key")))
    return both.groupBy("sink", "out_key").agg(F.count(F.lit(1)).alias("rows"))


def q_optional_sink(spark, sf_dir):
    """What a fan-out reports of a good sink, an optional one that fails, and one that is off."""
    rows = span_trends(event_spans(spark, sf_dir))
    sinks = [
        Sink("columns", path=shared_folder(spark, "columns")),
        Sink("broken", format="no-such-format", path=shared_folder(spark, "broken"), optional=True),
        Sink("off", path=shared_folder(spark, "off"), enabled=False),
    ]
    results = write_fanout(rows, sinks)
    require_all(results)
    return spark.createDataFrame([(r["sink"], r["rows"], r["ok"]) for r in results], "sink string, rows long, ok boolean")


# Streams


def _stream_points(spark: SparkSession, sf_dir: str, opts: TrendOptions) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # A pattern, because a file stream takes a folder or a pattern but not one file.
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parque[t]")
    return typed_points(valid_spans(spans_from_events(stream)), opts)


def q_stream_counts(spark, sf_dir):
    """One-minute success and failure counts of a stream, as the watermark closes them."""
    opts = TrendOptions(intervals=ONE_MINUTE)
    folder = shared_folder(spark, "stream-counts")
    counts = count_stream(_stream_points(spark, sf_dir, opts), S.INTERVALS[0], opts)
    query = (
        counts.writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rows = spark.read.schema(counts.schema).parquet(f"{folder}/rows")
    return _named(rows, "count")


def q_stream_stats(spark, sf_dir):
    """Five-minute statistics of a stream, written by the streaming fan-out."""
    opts = TrendOptions(intervals=S.INTERVALS[1:2])
    folder = shared_folder(spark, "stream-stats")
    sink = Sink("rows", path=f"{folder}/rows", mode="overwrite")
    points = _stream_points(spark, sf_dir, opts)
    for query in run_native_trends(points, f"{folder}/checkpoint", [sink], opts):
        query.awaitTermination()
    rows = spark.read.parquet(f"{folder}/rows")
    return _long(rows.drop("batch_id", "interval_s"))


def q_stream_strict(spark, sf_dir):
    """Strict mode over a stream: what the windows closed so far hold."""
    opts = TrendOptions(emit="closed", service_level=False)
    folder = shared_folder(spark, "stream-strict")
    sink = Sink("rows", path=f"{folder}/rows", mode="overwrite")
    query = run_strict_trends(_stream_points(spark, sf_dir, opts), f"{folder}/checkpoint", [sink], opts)
    query.awaitTermination()
    return _long(spark.read.parquet(f"{folder}/rows").drop("batch_id"))


QUERIES: dict[str, Query] = {
    "valid_spans": q_valid_spans,
    "denied_spans": q_denied_spans,
    "allowed_spans": q_allowed_spans,
    "span_status": q_span_status,
    "duration_points": _points_of(lambda: F.col("metric") == "duration"),
    "status_points": _points_of(lambda: F.col("metric") != "duration"),
    "all_points": q_all_points,
    "encode_period": _encoded("period"),
    "encode_base64": _encoded("base64"),
    "encode_noop": _encoded("noop"),
    "trend_keys": q_trend_keys,
    "classify": q_classify,
    "own_rule": q_own_rule,
    "own_transformer": q_own_transformer,
    "own_aggregate": q_own_aggregate,
    "span_source": q_span_source,
    "bad_messages": q_bad_messages,
    "valid_points": q_valid_points,
    "window_assign": q_window_assign,
    "count_trends_multi": q_count_trends_multi,
    "service_rollup": q_service_rollup,
    "hist_buckets": q_hist_buckets,
    "duration_stats_1m": _duration_stats(TrendOptions(intervals=ONE_MINUTE)),
    "duration_stats_rollup": _duration_stats(TrendOptions()),
    "duration_stats_ceil": _duration_stats(
        TrendOptions(intervals=ONE_MINUTE, histogram=HistogramOptions(rank_rule="ceil"))
    ),
    "duration_stats_micros": _duration_stats(
        TrendOptions(intervals=S.INTERVALS[3:], histogram=HistogramOptions(50_000_000, 3, "micros"))
    ),
    "point_cells": q_point_cells,
    "stats_long": q_stats_long,
    "extra_tags": q_extra_tags,
    "point_trends": q_point_trends,
    "strict_counts": q_strict_counts,
    "strict_duration": q_strict_duration,
    "strict_dense": q_strict_dense,
    "strict_points": q_strict_points,
    "strict_long": q_strict_long,
    "late_points": q_late_points,
    "closed_vs_all": q_closed_vs_all,
    "quality_summary": q_quality_summary,
    "time_in_topic": q_time_in_topic,
    "active_trends": q_active_trends,
    "keyed_sink": q_keyed_sink,
    "message_sink": q_message_sink,
    "sink_fanout": q_sink_fanout,
    "optional_sink": q_optional_sink,
    "stream_counts": q_stream_counts,
    "stream_stats": q_stream_stats,
    "stream_strict": q_stream_strict,
}
