import math
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import points, simulate, spans, tag
from trendloom.functions import histogram as H
from trendloom.operators.aggregates import DEFAULT_AGGREGATES, Aggregate
from trendloom.operators.cells import assign_windows, roll_up, span_cells, tally_points
from trendloom.operators.lateness import accepted_cells, judged_cells, late_counts
from trendloom.operators.points import typed_points
from trendloom.operators.rules import DEFAULT_RULES, Rule
from trendloom.operators.stats import window_stats
from trendloom.options import HistogramOptions, TrendOptions
from trendloom.plans.trends import point_trends, span_trends, strict_point_trends
from trendloom.schema import INTERVALS, Interval

ONE = TrendOptions(intervals=INTERVALS[:1])


def by_stat(rows):
    return {r.tags["stat"]: r.value for r in rows.collect()}


def test_count_is_the_sum_of_values(spark):
    opts = TrendOptions(intervals=INTERVALS[2:3])
    rows = point_trends(points(spark, "success-spans", [(2, 5), (4, 6), (5.9, 7)]), opts).collect()
    assert [(r.value, r.tags["stat"], r.tags["interval"], r.ts_sec) for r in rows] == [(11.0, "count", "FifteenMinute", 900)]


def test_values_beyond_the_range_are_held_to_it(spark):
    stats = by_stat(point_trends(points(spark, "duration", [(10_000, 1), (1_800_100_000, 2)]), ONE))
    assert (stats["max"], stats["mean"], stats["*_95"]) == (1794048000.0, 899077000.0, 1794048000.0)
    assert stats["min"] == 10_000.0 and len(stats) == 7


@pytest.mark.parametrize("precision,unit,limit", [(2, "millis", 1_800_000), (3, "micros", 2_000_000_000), (0, "seconds", 5000)])
def test_buckets_against_integer_arithmetic(spark, precision, unit, limit):
    opts = HistogramOptions(limit, precision, unit)
    edges = {v for k in range(31) for v in (2**k - 1, 2**k, 2**k + 1) if v <= limit} | {0, limit}
    rng = random.Random(7)
    values = sorted(edges | {rng.randrange(limit) for _ in range(500)})
    df = spark.createDataFrame([(v,) for v in values], "v bigint").withColumn("low", H.bucket_low(F.col("v"), opts))
    m = (2 * 10**precision - 1).bit_length()
    for r in df.withColumn("mid", H.bucket_middle(F.col("low"), opts)).collect():
        b = max(0, r.v.bit_length() - m)
        low = r.v >> b << b
        assert (r.low, r.mid) == (low, low + (1 << b >> 1))


def test_statistics_against_a_model(spark):
    rng = random.Random(3)
    values = [rng.choice([rng.randrange(1, 2_000), rng.randrange(1, 3_000_000_000)]) for _ in range(400)]
    for rule in ("half_up", "ceil"):
        opts = TrendOptions(intervals=INTERVALS[:1], histogram=HistogramOptions(rank_rule=rule))
        stats = by_stat(point_trends(points(spark, "duration", [(v, 3) for v in values]), opts))
        held = [min(v, 1_800_000_000) // 1000 for v in values]
        lows, mids = [], []
        for v in held:
            b = max(0, v.bit_length() - 8)
            lows.append(v >> b << b)
            mids.append((v >> b << b) + (1 << b >> 1))
        lows.sort()
        n = len(mids)
        variance = n * sum(m * m for m in mids) - sum(mids) ** 2
        assert stats["mean"] == sum(mids) // n * 1000
        assert stats["std"] == math.isqrt(variance // (n * n)) * 1000
        for p, name in ((50, "*_50"), (95, "*_95"), (99, "*_99")):
            rank = math.floor(p / 100 * n + 0.5) if rule == "half_up" else -(-p * n // 100)
            assert stats[name] == lows[max(rank, 1) - 1] * 1000


def test_std_is_exact_next_to_squares(spark):
    cases = [[1, 3], [1, 1], [0, 7], [5], [10, 14, 14], [1, 2, 2, 3], [100, 200, 201]]
    rows = [(i, len(c), sum(c), sum(v * v for v in c)) for i, c in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, n bigint, t bigint, q bigint").selectExpr(
        "i", "n", "cast(t as decimal(38,0)) t", "cast(q as decimal(38,0)) q"
    )
    for step in H.truncated_std_steps("n", "t", "q", "s"):
        df = df.withColumns(step)
    for r in df.collect():
        c = cases[r.i]
        assert r.s == math.isqrt((len(c) * sum(v * v for v in c) - sum(c) ** 2) // len(c) ** 2), c


def test_window_bounds(spark):
    df = spark.createDataFrame([(145,)], "ts_sec bigint")
    assert [(r.win_start, r.win_end) for r in assign_windows(df, INTERVALS[:1]).collect()] == [(120, 180)]


def test_both_ways_to_count_spans_agree(spark):
    rows = [
        {"service_name": f"s.{i % 3}", "operation_name": f"o{i % 2}", "start_time_us": i * 17_000_000,
         "duration_us": (i * i * 977) % 5_000_000 if i % 7 else 0}
        for i in range(300)
    ]
    df = spans(spark, rows)
    fast = span_trends(df).select("out_key", "value", "ts_sec", F.col("tags")["stat"].alias("s"), F.col("tags")["interval"].alias("i"))
    slow = point_trends(typed_points(df)).select("out_key", "value", "ts_sec", F.col("tags")["stat"].alias("s"), F.col("tags")["interval"].alias("i"))
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))


def test_no_points_no_rows(spark):
    assert point_trends(points(spark, "duration", [(0, 1)]), ONE).count() == 0


def test_own_rule_and_aggregate(spark):
    largest = Aggregate("Largest", {"largest": "largest"}, lambda _: {"largest": F.max("bucket")}, lambda v, _: v)
    opts = TrendOptions(
        intervals=INTERVALS[:1], rules=(*DEFAULT_RULES, Rule("queue", "Largest", "level")),
        aggregates=(*DEFAULT_AGGREGATES, largest),
    )
    df = points(spark, "queue-depth", [(4, 1), (9, 2), (3, 3)], {"mtype": "Level"})
    assert by_stat(point_trends(df, opts)) == {"largest": 9.0}


def finals(spark, order, opts=None):
    opts = opts or TrendOptions(emit="closed")
    rows = strict_point_trends(points(spark, "success-span", [(1, s) for s in order]), opts).collect()
    out = {}
    for r in rows:
        out.setdefault(r.tags["interval"], {})[r.ts_sec] = r.value
    return out


def test_late_points_and_closed_windows(spark):
    got = finals(spark, [1, 65, 2, 130, 310, 610])
    assert {k: len(v) for k, v in got.items()} == {"OneMinute": 3, "FiveMinute": 1}
    assert got["OneMinute"] == {60: 2.0, 120: 1.0, 180: 1.0}


def test_sixty_two_minutes(spark):
    got = finals(spark, range(0, 3661, 60))
    assert {k: len(v) for k, v in got.items()} == {"OneMinute": 60, "FiveMinute": 11, "FifteenMinute": 4, "OneHour": 1}


def test_first_emission(spark):
    df = points(spark, "duration", [(1, 1), (2, 61), (10, 121)])
    rows = strict_point_trends(df, TrendOptions(emit="closed", intervals=INTERVALS[:1])).collect()
    assert len(rows) == 7 and {r.ts_sec for r in rows} == {60}
    assert strict_point_trends(df.where("arrival < 2"), TrendOptions(emit="closed", intervals=INTERVALS[:1])).count() == 0


def test_gap_window_and_early_window(spark):
    opts = TrendOptions(emit="closed", intervals=INTERVALS[:1])
    assert finals(spark, [0, 180, 60], opts) == {"OneMinute": {60: 1.0}}
    late = late_counts(tally_points(points(spark, "success-span", [(1, 60), (1, 0)]), opts), opts).first()
    assert (late.points, late.accepted, late.late) == (2, 1, 1)


@pytest.mark.parametrize("block", [1, 5, 1000])
def test_strict_rule_against_a_point_by_point_model(spark, block):
    rng = random.Random(block)
    intervals = tuple(Interval(f"I{s}x{e}", s, e) for s, e in ((10, 0), (20, 1), (50, 2), (100, 3)))
    opts = TrendOptions(intervals=intervals, arrival_block=block)
    orders, frames = {}, None
    for trend in range(25):
        spread = rng.choice([5, 40, 150])
        order = [max(0, i * 2 + rng.randrange(-spread, spread)) for i in range(120)]
        df = points(spark, "success-span", [(1, s) for s in order], {"mtype": "gauge", "t": str(trend)})
        orders[f"success-span,mtype=gauge,t={trend}"] = order
        frames = df if frames is None else frames.unionByName(df)
    cells = judged_cells(tally_points(frames, opts), opts).collect()
    for key, order in orders.items():
        for interval in intervals:
            final, live, dropped = simulate(order, interval.seconds, interval.extra_windows)
            own = [c for c in cells if c.trend_key == key and c.seconds == interval.seconds]
            assert {c.win_start: c.n for c in own if c.accepted and c.closed} == final
            assert {c.win_start: c.n for c in own if c.accepted and not c.closed} == live
            assert sum(c.n for c in own if not c.accepted) == dropped


def test_limited_to_an_aggregate(spark):
    """Only the trends of the aggregate are grouped and counted, and they are the same."""
    from trendloom.operators.cells import roll_up, span_cells

    rows = spans(spark, [dict(duration_us=d, start_time_us=s * 1_000_000, tags=[tag("error", "BOOL", v_bool=s % 2 == 0)]) for s, d in enumerate((0, 5, 7000, 10**7, 3))])
    every = TrendOptions()
    cells = [r for r in map(tuple, roll_up(span_cells(rows, every), every.intervals).collect())]
    for name in ("Count", "Histogram"):
        opts = every.limited(name)
        got = sorted(map(tuple, roll_up(span_cells(rows, opts), opts.intervals).collect()))
        assert got == sorted(c for c in cells if c[1] == name) and got
    assert "duration_us" in span_cells(rows, every)._jdf.queryExecution().optimizedPlan().toString()
    assert "AS low#" not in span_cells(rows, every.limited("Count"))._jdf.queryExecution().optimizedPlan().toString()


def test_cells_of_any_size_are_summed_exactly_in_one_pass(spark):
    cells = spark.createDataFrame(
        [("k", "Histogram", 60, 0, 1000, 5, 0), ("k", "Histogram", 60, 0, 1_794_048, 2**40, 0), ("k", "Histogram", 60, 60, 7, 1, 0)],
        "trend_key string, agg_type string, seconds long, win_start long, bucket long, n long, total long",
    )
    opts = TrendOptions()
    middles = {r["bucket"]: r["m"] for r in cells.select("bucket", H.bucket_middle(F.col("bucket"), opts.histogram).alias("m")).collect()}
    wide = window_stats(cells, opts)
    first, second = wide.orderBy("win_start").collect()
    n, total = 5 + 2**40, 5 * middles[1000] + 2**40 * middles[1_794_048]
    squares = 5 * middles[1000] ** 2 + 2**40 * middles[1_794_048] ** 2
    assert (first["points"], first["mean"]) == (n, total // n * 1000)
    assert first["std"] == math.isqrt((n * squares - total * total) // (n * n)) * 1000
    assert (second["mean"], second["std"]) == (7000, 0)
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" :+-").startswith("Window [") for line in plan.splitlines()) == 1


def test_late_counts_group_by_no_value(spark):
    rng = random.Random(5)
    rows = [(float(rng.randrange(1, 10**6)), rng.randrange(3000)) for _ in range(300)]
    df = points(spark, "duration", rows).withColumn("arrival", F.col("ts_sec") + F.lit(97) * F.col("value").cast("bigint") % 900)
    opts = TrendOptions(arrival_block=300)
    tally = tally_points(df, opts)
    counted = late_counts(tally, opts)
    part = F.when(F.col("accepted"), F.col("n")).otherwise(0)
    cells = judged_cells(tally, opts).groupBy("trend_key", "seconds").agg(F.sum("n"), F.sum(part), F.sum(F.col("n") - part))
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, cells.collect()))
    assert any(r["late"] for r in counted.collect())
    assert "closed" not in counted._jdf.queryExecution().optimizedPlan().toString()
    assert tally.without_buckets().rows.select("bucket").distinct().count() == 1
