import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import points
from trendloom.functions.keys import flat_tags
from trendloom.operators.quality import observe_points
from trendloom.options import TrendOptions
from trendloom.plans.trends import point_trends, strict_point_trends
from trendloom.schema import INTERVALS
from trendloom.sources.readers import broken_messages, decode_messages, read_points, read_spans
from trendloom.sources.sinks import (
    FanoutError,
    Sink,
    require_all,
    start_point_stream,
    to_messages,
    write_fanout,
    write_points,
)
from trendloom.streaming.native import in_flight, native_cells, rolled_cells, start_native_trend
from trendloom.streaming.strict import open_windows, run_strict_trends

ORDER = [1, 65, 2, 130, 310, 70, 610, 600, 900, 1300, 100, 1500, 3700, 3600, 3800, 7300]


def add_file(spark, folder, pairs, first_arrival):
    df = points(spark, "success-span", pairs).withColumn("arrival", F.col("arrival") + first_arrival)
    df.coalesce(1).write.mode("append").parquet(folder)


def flat(df):
    return sorted(map(tuple, df.select("out_key", flat_tags(F.col("tags")), "value", "ts_sec").collect()))


def test_strict_stream_with_restarts_equals_batch(spark, tmp_path):
    source, work, out = str(tmp_path / "in"), str(tmp_path / "work"), str(tmp_path / "out")
    opts = TrendOptions(emit="closed")
    pairs = [(i + 1, s) for i, s in enumerate(ORDER)]
    for start in range(0, len(pairs), 5):
        add_file(spark, source, pairs[start : start + 5], start)
        stream = read_points(spark, source, streaming=True, start="earliest")
        run_strict_trends(stream, work, [Sink("rows", path=out)], opts).awaitTermination()
    whole = points(spark, "success-span", pairs)
    assert flat(spark.read.parquet(out).drop("batch_id")) == flat(strict_point_trends(whole, opts))
    left = open_windows(spark, work)
    assert left.groupBy("seconds").count().where("count > 2").count() == 0
    assert left.where("seconds = 60").agg(F.max("win_start")).first()[0] == 7260


def test_native_stream_counts_restart_and_state(spark, tmp_path):
    source, work, out = str(tmp_path / "in"), str(tmp_path / "work"), str(tmp_path / "out")
    opts = TrendOptions(intervals=INTERVALS[:1])

    def run():
        stream = read_points(spark, source, streaming=True, start="earliest")
        start_native_trend(stream, INTERVALS[0], work, [Sink("rows", path=out)], opts).awaitTermination()

    add_file(spark, source, [(1, 5), (1, 30), (1, 70)], 0)
    run()
    assert {(r.win_start, r.n) for r in in_flight(spark, work, INTERVALS[0]).collect()} == {(0, 2), (60, 1)}
    add_file(spark, source, [(1, 20), (1, 200)], 3)
    run()
    rows = spark.read.parquet(out)
    assert {(r.ts_sec, r.value) for r in rows.collect()} == {(60, 3.0), (120, 1.0)}


def test_longer_intervals_from_closed_minutes(spark, tmp_path):
    source = str(tmp_path / "in")
    add_file(spark, source, [(1, 5), (1, 100), (2, 310), (1, 2000)], 0)
    stream = read_points(spark, source, streaming=True)
    query = (
        rolled_cells(stream, INTERVALS[1])
        .writeStream.format("memory").queryName("rolled").outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {(r.win_start, r.total) for r in spark.table("rolled").collect()}
    assert got == {(0, 2), (300, 2)}
    plain = native_cells(stream, INTERVALS[1])
    assert plain.isStreaming and "trend_key" in plain.columns


def test_fanout_reports_each_sink(spark, tmp_path):
    df = points(spark, "duration", [(1, 1), (2, 2)])
    results = write_fanout(
        df,
        [
            Sink("a", path=str(tmp_path / "a")),
            Sink("broken", format="no-such-format"),
            Sink("off", path=str(tmp_path / "off"), enabled=False),
            Sink("b", format="json", path=str(tmp_path / "b"), as_messages=True),
        ],
    )
    assert [(r["sink"], r["rows"], r["ok"]) for r in results] == [("a", 2, True), ("broken", None, False), ("b", 2, True)]
    assert not (tmp_path / "off").exists()
    try:
        require_all(results)
        raise AssertionError("a failed sink must be raised")
    except FanoutError as failure:
        assert "broken" in str(failure)


def test_points_come_back_by_key(spark, tmp_path):
    df = points(spark, "duration", [(i, i) for i in range(1, 30)])
    write_points(df, str(tmp_path / "p"), buckets=4)
    back = read_points(spark, str(tmp_path / "p"))
    assert sorted(r.value for r in back.collect()) == sorted(r.value for r in df.collect())


def test_messages(spark):
    df = points(spark, "duration", [(5, 7)])
    message = to_messages(df).first()
    assert message.key == "duration,mtype=gauge,unit=short" and json.loads(message.value)["value"] == 5.0
    raw = spark.createDataFrame([(message.value, 41), ("not json", 42)], "value string, offset bigint")
    rows = decode_messages(raw, df.schema).collect()
    assert len(rows) == 1 and rows[0].value == 5.0 and rows[0].ts_sec == 7 and rows[0].arrival is not None
    assert [r.broken for r in broken_messages(raw, df.schema).collect()] == ["not json"]


def test_points_are_added(spark, tmp_path):
    df = points(spark, "duration", [(1, 1)])
    for _ in range(2):
        write_points(df, str(tmp_path / "p"), buckets=4)
    assert read_points(spark, str(tmp_path / "p")).count() == 2
    with pytest.raises(ValueError):
        read_points(spark, str(tmp_path / "p"), streaming=True, start="latest")


def test_point_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(2):
        add_file(spark, source, [(i + 1, 10 * i)], i)
        stream = read_points(spark, source, streaming=True)
        query = start_point_stream(stream, out, str(tmp_path / "check"), buckets=2)
        query.processAllAvailable()
        query.stop()
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == [1.0, 2.0]


def test_an_optional_sink_may_fail(spark, tmp_path):
    results = write_fanout(points(spark, "duration", [(1, 1)]), [Sink("a", path=str(tmp_path / "a")), Sink("b", format="no-such-format", optional=True)])
    require_all(results)
    assert [r["ok"] for r in results] == [True, False]


def test_keys_of_their_own(spark):
    """A null key is derived, and an own key tells nothing of its trend: metric and tags are those of the points."""
    df = points(spark, "success-span", [(1, 1), (2, 2)])
    keyless = df.withColumn("trend_key", F.lit(None).cast("string"))
    assert flat(point_trends(keyless)) == flat(point_trends(df))
    twice = df.withColumn("trend_key", F.lit("a=b,a=c,a=d"))
    assert flat(point_trends(twice)) == flat(point_trends(df))


def test_json_spans(spark, tmp_path):
    (tmp_path / "s.json").write_text(
        json.dumps({"service_name": "s", "operation_name": "o", "start_time_us": 5, "duration_us": 6,
                    "tags": [{"key": "error", "type": "BOOL", "v_bool": True}]}) + "\n"
    )
    row = read_spans(spark, str(tmp_path), format="json").first()
    assert row.duration_us == 6 and row.tags[0].v_bool is True and row.arrival is None


def test_observed_points(spark):
    from pyspark.sql import Observation

    seen = Observation("seen")
    observe_points(points(spark, "success-span", [(1, 1), (0, 2)]), seen).count()
    assert seen.get["points"] == 2 and seen.get["invalid_points"] == 1


def test_start_at_a_moment(spark, tmp_path):
    import os
    from datetime import datetime

    source = str(tmp_path / "in")
    add_file(spark, source, [(1, 5)], 0)
    for f in (tmp_path / "in").glob("*.parquet"):
        os.utime(f, (1_000_000, 1_000_000))
    add_file(spark, source, [(2, 6)], 1)
    assert [r.value for r in read_points(spark, source, start="2001-01-01T00:00:00").collect()] == [2.0]
    assert read_points(spark, source, start=datetime.fromtimestamp(1_000_000)).count() == 2
    stream = read_points(spark, source, streaming=True, start="2001-01-01")
    query = stream.writeStream.format("memory").queryName("since").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r.value for r in spark.table("since").collect()] == [2.0]
    with pytest.raises(ValueError):
        read_points(spark, source, start="yesterday")


def test_parts_of_one_file_lie_in_several(spark, tmp_path):
    """A table in one file is dealt once, so that every part of a stream is read by several tasks."""
    from catalogue.streams import PARTS, _in_parts

    table, folder = str(tmp_path / "table"), str(tmp_path / "parts")
    rows = spark.range(400).select("id", F.when(F.col("id") % 10 > 0, F.col("id") * 7 % 400).alias("arrival"), F.array("id").alias("tags"))
    rows.coalesce(1).write.parquet(table)
    seen = []
    for part in _in_parts(spark.read.parquet(table), "arrival", folder):
        files = spark.read.parquet(folder).select("*", F.input_file_name().alias("file"))
        new = [r for r in files.collect() if r.file not in seen]
        assert sorted(r.id for r in new) == [i for i in range(400) if i % 10 and i * 7 % 400 * PARTS // 400 == part]
        assert all(r.tags == [r.id] for r in new) and len({r.file for r in new}) > 1
        seen += {r.file for r in new}
    assert spark.read.parquet(folder).columns == ["id", "arrival", "tags"]
