"""Streams of spans: one grouping for all intervals, the span app, and what running streams report."""

import time

import pytest
from pyspark.sql import functions as F

from catalogue.queries import event_spans
from tests.helpers import spans, tag
from tests.test_streams import flat
from trendloom.operators.dictionary import dictionary_of_points, dictionary_of_spans, trend_id
from trendloom.options import TrendOptions
from trendloom.plans.trends import span_trends, strict_span_trends
from trendloom.schema import INTERVALS
from trendloom.sources.readers import read_points, read_spans
from trendloom.sources.sinks import Sink
from trendloom.streaming.app import points_of_spans, start_span_app
from trendloom.streaming.measures import DROPPED, MeasureLog, balance, measures_of, read_measures
from trendloom.streaming.native import start_native_trend
from trendloom.streaming.rolled import minute_cells, read_minutes, run_rolled_trends

SECOND = 1_000_000


def some_spans(spark, times, **more):
    return spans(spark, [dict(start_time_us=t * SECOND, duration_us=1000 * (i + 1), **more) for i, t in enumerate(times)])


def put(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def test_intervals_from_closed_minutes(spark, tmp_path):
    source, job, out = (str(tmp_path / n) for n in ("in", "job", "out"))
    times = [5, 50, 70, 130, 310, 620, 700, 930, 1000, 3700, 3800, 7300, 7600]
    for start in range(0, len(times), 4):
        put(some_spans(spark, times[start : start + 4], tags=[tag("error", "BOOL", v_bool=start == 4)]), source)
        run_rolled_trends(read_spans(spark, source, streaming=True), job, [Sink("rows", path=out)])
    whole = None
    for start in range(0, len(times), 4):
        part = some_spans(spark, times[start : start + 4], tags=[tag("error", "BOOL", v_bool=start == 4)])
        whole = part if whole is None else whole.unionByName(part)
    # 7600 is in the minute of 7560: minutes up to that of 7260 have closed, and longer windows up to 7260.
    ends = {60: 7560 - 60, 300: 7260, 900: 7260, 3600: 7260}
    names = {i.name: ends[i.seconds] for i in INTERVALS}
    want = [r for r in flat(span_trends(whole)) if any(f"interval={n}," in r[1] and r[3] <= end for n, end in names.items())]
    assert flat(spark.read.parquet(out).drop("batch_id", "interval_s")) == want
    assert read_minutes(spark, job).agg(F.max("grain_start")).first()[0] == 7260


def test_a_span_is_one_keyed_row(spark, tmp_path):
    """The only exchange of spans is by the columns of the group; trends and intervals come after it."""
    put(some_spans(spark, [1, 2]), str(tmp_path / "in"))
    stream = minute_cells(read_spans(spark, str(tmp_path / "in"), streaming=True), TrendOptions(), 60)
    query = stream.writeStream.format("memory").queryName("cells").trigger(availableNow=True).start()
    query.awaitTermination()
    updated = [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]]
    assert max(updated) <= 2


def test_span_app(spark, tmp_path):
    """Deny list, points, storage by trend, a further sink, and an optional one that fails."""
    source, out = str(tmp_path / "in"), str(tmp_path / "points")
    opts = TrendOptions(deny=("^internal",))
    all_spans = None
    for i in range(3):
        part = some_spans(spark, [10 * i, 20 * i]).unionByName(some_spans(spark, [i], service_name="internal-x")).unionByName(some_spans(spark, [i], operation_name=""))
        all_spans = part if all_spans is None else all_spans.unionByName(part)
        put(part, source)
        sinks = [Sink("json", format="json", path=str(tmp_path / "json"), as_messages=True), Sink("bad", path=str(tmp_path / "x"), format="no-such-format", optional=True)]
        start_span_app(read_spans(spark, source, streaming=True), out, str(tmp_path / "check"), opts, buckets=4, sinks=sinks).awaitTermination()
    columns = ["trend_key", "value", "ts_sec"]
    want = sorted(map(tuple, points_of_spans(all_spans, opts).select(*columns).collect()))
    assert sorted(map(tuple, read_points(spark, out).select(*columns).collect())) == want and len(want) == 6 * 4
    assert spark.read.json(str(tmp_path / "json")).count() == len(want)


def test_span_app_keeps_no_batch_in_memory(spark, sf_dir, tmp_path, monkeypatch):
    """Further sinks get what was stored: all rows, once, with no block of a batch that one task would have to read whole."""
    source = str(tmp_path / "spans")
    event_spans(spark, sf_dir).drop("event_id").limit(500).write.parquet(source)

    def refused(self, *_):
        raise AssertionError("a batch is kept")

    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.persist", refused)
    sinks = [Sink("rows", path=str(tmp_path / "rows")), Sink("more", path=str(tmp_path / "more"))]
    start_span_app(read_spans(spark, source, streaming=True), str(tmp_path / "points"), str(tmp_path / "check"), sinks=sinks).awaitTermination()
    want = points_of_spans(read_spans(spark, source))
    for name in ("rows", "more"):
        got = spark.read.parquet(str(tmp_path / name)).drop("batch_id")
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_required_sinks_stop_a_native_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    put(points_of_spans(some_spans(spark, [5, 400])), source)

    def run(optional):
        bad = Sink("bad", path=str(tmp_path / "x"), format="no-such-format", optional=optional)
        start_native_trend(read_points(spark, source, streaming=True), INTERVALS[0], str(tmp_path / f"c{optional}"), [bad, Sink("rows", path=str(tmp_path / "rows"))]).awaitTermination()

    with pytest.raises(Exception, match="no-such-format"):
        run(False)
    run(True)
    assert spark.read.parquet(str(tmp_path / "rows")).count() > 0


def test_measures_of_running_streams(spark, tmp_path):
    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    listener = MeasureLog(spark, log)
    spark.streams.addListener(listener)
    try:
        for times in ([5, 70, 400], [10, 390, 800, 20]):
            put(some_spans(spark, times), source)
            start_span_app(read_spans(spark, source, streaming=True), str(tmp_path / "points"), str(tmp_path / "check")).awaitTermination()
        for _ in range(100):
            if (tmp_path / "log").exists() and spark.read.parquet(log).where("measure = 'points.points'").agg(F.sum("value")).first()[0] == 28:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    got = {r.measure: r.value for r in read_measures(spark, log).collect()}
    assert got["input_rows"] == 7 and got["points.points"] == 28 and got["points.duration_points"] == 14 and got[DROPPED] == 0


def test_rows_of_a_report():
    report = {
        "id": "q", "runId": "r", "name": None, "batchId": 3, "numInputRows": 9, "observedMetrics": {"points": {"points": 4, "ratio": 0.5}},
        "stateOperators": [{"numRowsDroppedByWatermark": 2}, {"numRowsDroppedByWatermark": 1}],
    }
    rows = {r[4]: r[5] for r in measures_of(report)}
    assert rows == {"input_rows": 9, DROPPED: 3, "points.points": 4}


def test_balance(spark):
    cells = spark.createDataFrame([("a", 3), ("a", 2), ("b", 1)], "agg_type string, n long")
    got = balance(spark.createDataFrame([("a", 9), ("b", 1), ("c", 4)], "agg_type string, n long"), cells, cells.where("n = 3"))
    assert sorted(map(tuple, got.collect())) == [("a", 9, 5, 3, 1), ("b", 1, 1, 0, 0), ("c", 4, 0, 0, 4)]


def test_dictionaries(spark):
    """One row per trend; the smallest description counts; nulls and tags named like statistics do no harm."""
    from tests.helpers import points

    a = points(spark, "success-span", [(1, 1)], {"mtype": "gauge", "x": None})
    b = points(spark, "duration", [(1, 1), (2, 2), (0, 3)], {"mtype": "gauge", "stat": "own"})
    named = a.unionByName(b).withColumn("trend_key", F.lit("k1")).unionByName(b)
    found = dictionary_of_points(named)
    assert found.count() == found.select("trend_key").distinct().count() == 2
    assert {r.out_key for r in found.collect()} == {"duration,mtype=gauge,stat=own"}
    assert dictionary_of_points(a).first().tags == {"mtype": "gauge", "x": None}
    every = dictionary_of_spans(some_spans(spark, [1, 2]), TrendOptions(service_level=False)).collect()
    assert sorted(r.metric for r in every) == ["duration", "failure-span", "success-span"]
    assert spark.range(1).select(trend_id(F.lit(None).cast("string")).alias("i")).first().i is None
    trends = span_trends(some_spans(spark, [1, 2])).collect()
    assert all(r.tags["serviceName"] == "testService" and r.tags["stat"] and r.out_key.startswith(r.metric) for r in trends)
    assert strict_span_trends(some_spans(spark, [1, 70, 200])).count() > 0
