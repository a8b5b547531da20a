"""Packed histograms, bitmaps of trends, bucketed points and two-pass ranks."""

import random

import pytest
from pyspark.sql import functions as F

from catalogue.queries import event_spans, line_spans
from tests.helpers import points
from tests.test_streams import flat
from trendloom.operators.active import active_in_windows, merged_bitmaps, numbered_trends, trend_bitmaps
from trendloom.operators.cells import point_cells, roll_up
from trendloom.operators.packed import merged, packed, percentiles, share_below, unpacked
from trendloom.operators.quality import time_in_topic
from trendloom.operators.stats import window_stats
from trendloom.options import HistogramOptions, TrendOptions
from trendloom.plans.trends import point_trends
from trendloom.schema import INTERVALS
from trendloom.sources.stored import register_points, store_points, stored_trends, stored_windows

OPTS = TrendOptions()


def latencies(spark, n=400, seed=1):
    draw = random.Random(seed)
    return points(spark, "duration", [(draw.choice((1, 5_000, 250_000, 9_000_000)) * draw.random() + 1, draw.randint(0, 9000)) for _ in range(n)])


def test_packed_rows_answer_like_cells(spark):
    minutes = roll_up(point_cells(latencies(spark), OPTS), INTERVALS[:1])
    rows = packed(minutes)
    assert all(r.counts[-1] == r.points and sorted(r.buckets) == r.buckets for r in rows.collect())
    assert sorted(map(tuple, unpacked(rows).collect())) == sorted(map(tuple, minutes.select("trend_key", "agg_type", "seconds", "win_start", "bucket", "n").collect()))
    got = percentiles(merged(rows, [i.seconds for i in INTERVALS]), (50, 95, 99)).collect()
    want = window_stats(roll_up(point_cells(latencies(spark), OPTS), INTERVALS), OPTS).collect()
    key = ("seconds", "win_start", "points", "p50", "p95", "p99")
    assert sorted(tuple(r[k] for k in key) for r in got) == sorted(tuple(r[k] for k in key) for r in want)
    # Merging in two steps is the same as in one.
    twice = merged(merged(rows, [300]), [900])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, merged(rows, [900]).collect()))


def test_packed_edges(spark):
    rows = packed(roll_up(point_cells(points(spark, "duration", [(1_000_000, 5), (3_000_000, 6), (9_000_000, 7)]), OPTS), INTERVALS[:1]))
    row = percentiles(rows, (1, 100), HistogramOptions(rank_rule="ceil")).first()
    assert row.points == 3 and row.p1 <= 1_000_000 and row.p100 <= 9_000_000 < row.p100 * 1.02
    shares = rows.select(share_below(500_000, HistogramOptions()).alias("a"), share_below(3_000_000, HistogramOptions()).alias("b"), share_below(10**9, HistogramOptions()).alias("c")).first()
    assert (shares.a, round(shares.b, 3), shares.c) == (0.0, 0.667, 1.0)
    assert merged(rows.limit(0), [300]).count() == 0 and packed(roll_up(point_cells(points(spark, "success-span", [(1, 1)]), OPTS), INTERVALS)).count() == 0
    with pytest.raises(ValueError):
        percentiles(rows, (0,))


def test_active_trends_of_windows(spark):
    draw = random.Random(3)
    rows = [(f"t{draw.randint(0, 60)}", "Count", 60, 60 * draw.randint(0, 200), -1, 1, 1) for _ in range(700)]
    cells = spark.createDataFrame(rows, "trend_key string, agg_type string, seconds long, win_start long, bucket long, n long, total long")
    numbers = numbered_trends(cells, stretches=7)
    assert sorted(r.number for r in numbers.collect()) == list(range(numbers.count()))
    merged_ = merged_bitmaps(trend_bitmaps(cells, numbers), (60, 900, 3600))
    got = {(r.seconds, r.win_start): r.trends for r in active_in_windows(merged_).collect()}
    want = {}
    for t, _, _, start, *_ in rows:
        for s in (60, 900, 3600):
            want.setdefault((s, start // s * s), set()).add(t)
    assert got == {k: len(v) for k, v in want.items()}


def test_many_trends_need_several_bitmaps(spark):
    cells = spark.range(70_000).select(F.concat(F.lit("t"), "id").alias("trend_key"), F.lit("Count").alias("agg_type"), F.lit(60).alias("seconds"), F.lit(0).alias("win_start"))
    bitmaps = trend_bitmaps(cells, numbered_trends(cells))
    assert bitmaps.count() == 3 and active_in_windows(bitmaps).first().trends == 70_000


def own_points(spark):
    rows = latencies(spark).withColumn("trend_key", F.lit("k-1"))
    return rows.unionByName(points(spark, "success-span", [(1, s) for s in range(0, 8000, 7)]))


def test_stored_points_are_not_exchanged(spark, tmp_path):
    store_points(own_points(spark), "stored_a", str(tmp_path / "a"), buckets=4)
    table = spark.table("stored_a")
    plan = stored_windows(table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert flat(stored_trends(table)) == flat(point_trends(own_points(spark)))


def test_stored_points_grow_and_are_found_again(spark, tmp_path):
    path = str(tmp_path / "b")
    for _ in range(2):
        store_points(latencies(spark), "stored_b", path, buckets=4)
    again = register_points(spark, "stored_c", path, buckets=4)
    both = latencies(spark).unionByName(latencies(spark))
    assert flat(stored_trends(again)) == flat(point_trends(both)) and flat(stored_trends(spark.table("stored_b"))) == flat(point_trends(both))
    with pytest.raises(ValueError):
        from trendloom.schema import Interval

        stored_windows(again, TrendOptions(intervals=(Interval("Day", 86400, 0),)))


@pytest.mark.parametrize("spread", [3, 70_000, 90_000_000])
def test_ranks_of_delays(spark, spread):
    draw = random.Random(spread)
    delays = {t: [draw.randint(-spread, spread // 2) for _ in range(n)] for t, n in (("a", 1), ("b", 200), ("c", 3))}
    rows = [("m", None, 1.0, 10_000, t, (10_000_000 - d) * 1000) for t, some in delays.items() for d in some]
    rows += [("m", None, 1.0, 10_000, "c", None), ("m", None, -1.0, 10_000, "c", 0), ("m", None, 1.0, 10_000, "d", None)]
    df = spark.createDataFrame(rows, "metric string, tags map<string,string>, value double, ts_sec long, trend_key string, arrival long")
    got = {r.trend_key: tuple(r)[1:] for r in time_in_topic(df).collect()}
    want = {"d": (1, None, None, None, None, None)}
    for t, some in delays.items():
        some, n = sorted(some), len(some)
        want[t] = (n + (t == "c"), some[0], *[some[max(1, -(-p * n // 100)) - 1] for p in (50, 95, 99)], some[-1])
    assert got == want


def test_windows_are_never_the_broadcast_side(spark, tmp_path):
    """A small table makes its windows look few; they must not go to every task, nor through the task of the dictionary."""
    stored = latencies(spark, 2_000, 9)
    store_points(stored, "few_points", str(tmp_path / "few"), buckets=2)
    rows = stored_trends(spark.table("few_points"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildLeft" not in plan and "Inner" not in plan
    assert flat(rows) == flat(point_trends(stored))


def test_tasks_get_little_of_a_large_shuffle(spark, sf_dir):
    """Queries lower Spark's default size of joined partitions, and leave a size that was set."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.unset(name)
    try:
        for spans in (event_spans, line_spans):
            spans(spark, sf_dir)
            assert spark.conf.get(name) == "16m"
            spark.conf.unset(name)
        spark.conf.set(name, "32m")
        event_spans(spark, sf_dir)
        assert spark.conf.get(name) == "32m"
    finally:
        spark.conf.unset(name)
