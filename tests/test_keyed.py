"""The strict rule with keyed state: against the batch plan, with restarts, views of the state and its changes."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.helpers import points, simulate
from tests.test_streams import ORDER, add_file, flat
from trendloom.operators.lateness import late_counts
from trendloom.operators.cells import tally_points
from trendloom.options import TrendOptions
from trendloom.plans.trends import strict_point_trends
from trendloom.schema import INTERVALS
from trendloom.sources.readers import read_points
from trendloom.sources.sinks import Sink
from trendloom.streaming.keyed import _cells_in, _cut_partition, cut_cells, judge, keyed_open_windows, keyed_trends, run_keyed_trends, window_changes

PAIRS = [(i + 1, s) for i, s in enumerate(ORDER)]


def run(spark, source, work, sinks, **more):
    stream = read_points(spark, source, streaming=True)
    run_keyed_trends(stream, work, sinks, TrendOptions(emit="closed"), **more).awaitTermination()


def test_stream_in_parts_equals_batch(spark, tmp_path):
    source, work, out, late = (str(tmp_path / n) for n in ("in", "work", "out", "late"))
    for start in range(0, len(PAIRS), 5):
        add_file(spark, source, PAIRS[start : start + 5], start)
        run(spark, source, work, [Sink("rows", path=out)], late_sinks=[Sink("late", path=late)])
    whole = points(spark, "success-span", PAIRS)
    opts = TrendOptions(emit="closed")
    assert flat(spark.read.parquet(out).drop("batch_id")) == flat(strict_point_trends(whole, opts))
    want = {r.seconds: r.late for r in late_counts(tally_points(whole, opts), opts).where("late > 0").collect()}
    got = {r.seconds: r.late for r in spark.read.parquet(late).groupBy("seconds").agg(F.sum("late").alias("late")).collect()}
    assert got == want and want
    left = keyed_open_windows(spark, work).groupBy("seconds", "win_start").agg(F.sum("n").alias("n")).collect()
    for i in INTERVALS:
        _, live, _ = simulate(ORDER, i.seconds, i.extra_windows)
        assert {(r.win_start, r.n) for r in left if r.seconds == i.seconds} == set(live.items())
    assert [(r.metric, r.tags) for r in keyed_trends(spark, work).collect()] == [("success-span", {"mtype": "gauge", "unit": "short"})]


def test_a_batch_touches_only_its_own_trends(spark, tmp_path):
    source, work, out = (str(tmp_path / n) for n in ("in", "work", "out"))
    tags = [{"mtype": "gauge", "unit": "short", "name": n} for n in "abc"]
    for i, some in enumerate([tags, tags[1:2], tags[:1]]):
        for t in some:
            df = points(spark, "duration", [(5 + i, 100 * i + k) for k in range(3)], t).withColumn("arrival", F.col("arrival") + 1000 * i)
            df.coalesce(1).write.mode("append").parquet(source)
        run(spark, source, work, [Sink("rows", path=out)])
    changed = {(r.batch_id, r.trend_key.split("name=")[1][0]) for r in window_changes(spark, work, 0).collect()}
    assert changed == {(0, "a"), (0, "b"), (0, "c"), (1, "b"), (2, "a")}
    assert keyed_open_windows(spark, work, 0).select("trend_key").distinct().count() == 3


def test_failed_batch_is_run_again(spark, tmp_path):
    """The sinks of a batch fail after one of them has written; the next start gives every row once."""
    source, work, out = (str(tmp_path / n) for n in ("in", "work", "out"))
    good, bad = Sink("rows", path=out), Sink("bad", format="no-such-format")
    for start in range(0, len(PAIRS), 6):
        add_file(spark, source, PAIRS[start : start + 6], start)
        with pytest.raises(Exception, match="no-such-format"):
            run(spark, source, work, [good, bad])
        run(spark, source, work, [good])
    assert flat(spark.read.parquet(out).drop("batch_id")) == flat(strict_point_trends(points(spark, "success-span", PAIRS), TrendOptions(emit="closed")))


def test_a_batch_without_valid_points(spark, tmp_path):
    source, work, out = (str(tmp_path / n) for n in ("in", "work", "out"))
    add_file(spark, source, [(0, 10), (-1, 20)], 0)
    run(spark, source, work, [Sink("rows", path=out)])
    add_file(spark, source, PAIRS, 10)
    run(spark, source, work, [Sink("rows", path=out)])
    assert flat(spark.read.parquet(out).drop("batch_id")) == flat(strict_point_trends(points(spark, "success-span", PAIRS), TrendOptions(emit="closed")))


def test_optional_sinks_of_a_stream_may_fail(spark, tmp_path):
    source, work, out = (str(tmp_path / n) for n in ("in", "work", "out"))
    add_file(spark, source, PAIRS, 0)
    run(spark, source, work, [Sink("bad", path=str(tmp_path / "x"), format="no-such-format", optional=True), Sink("rows", path=out)])
    assert spark.read.parquet(out).count() > 0


def test_own_keys_of_a_stream(spark, tmp_path):
    source, work, out = (str(tmp_path / n) for n in ("in", "work", "out"))
    df = points(spark, "success-span", PAIRS).withColumn("trend_key", F.lit("abc-123"))
    df.coalesce(1).write.parquet(source)
    run(spark, source, work, [Sink("rows", path=out)])
    rows = spark.read.parquet(out)
    assert {(r.out_key, r.metric, r.tags["unit"]) for r in rows.collect()} == {("success-span,mtype=gauge,unit=short", "success-span", "short")}


def whole_frame(times, slices=3):
    n = len(times)
    return pd.DataFrame(
        {"trend_key": "t", "agg_type": "Count", "slice": [i * slices // max(1, n) for i in range(n)], "grain_start": [s // 60 * 60 for s in times],
         "bucket": -1, "amount": 1, "arrival": range(n), "metric": "m", "tags": [{}] * n}
    )


@pytest.mark.parametrize("seed", range(25))
def test_cells_cut_at_first_arrivals_judge_like_single_points(seed):
    draw = random.Random(seed)
    now, times = 0, []
    for _ in range(300):
        now += draw.choice((0, 5, 20, 90))
        times.append(max(0, now - draw.choice((0, 0, 30, 100, 400, 4000))))
    frame = whole_frame(times)
    if seed % 2:  # equal arrivals count oldest window first
        frame["arrival"] = frame["arrival"] // 7
        frame["slice"] = frame["arrival"] // 12
    ordered = frame.sort_values(["arrival", "grain_start"], kind="stable")["grain_start"].tolist()
    cells = cut_cells(frame.sample(frac=1, random_state=seed))
    for k in range(4):
        intervals = [(60, k), (300, k)]
        open_ = {60: {}, 300: {}}
        closed, late, touched = judge(cells, intervals, open_)
        for seconds, extra in intervals:
            final, live, dropped = simulate(ordered, seconds, extra)
            assert {w: sum(c[0] for c in held.values()) for s, w, held in closed if s == seconds} == final
            assert {w: sum(c[0] for c in held.values()) for w, held in open_[seconds].items()} == live
            assert late[seconds] == dropped
    assert len(cells) < len(frame)


def test_sums_beyond_64_bits_are_null():
    frame = whole_frame([1, 1, 70])
    frame["amount"] = np.array([2**63 - 1, 1, 2**62], np.int64)
    frame["arrival"] = frame["slice"] = 0
    cells = cut_cells(frame)
    assert [None if pd.isna(t) else int(t) for t in cells.sort_values("grain_start")["total"]] == [None, 2**62]
    open_ = {60: {}}
    judge(pd.concat([cells, cells]), [(60, 5)], open_)
    assert open_[60][0][-1] == [4, None] and open_[60][60][-1] == [2, None]


def arrow_points(draw, size, trends, slices, ties):
    now, times = 0, []
    for _ in range(size):
        now += draw.choice((0, 5, 20, 90))
        times.append(max(0, now - draw.choice((0, 0, 30, 100, 400, 4000, 9000))))
    arrival = [i // ties for i in range(size)]
    columns = {
        "trend_key": [draw.choice("abc"[:trends]) for _ in times], "agg_type": ["Count"] * size,
        "slice": [a * slices // size for a in arrival], "grain_start": [s // 60 * 60 for s in times],
        "bucket": [draw.choice((-1, 8)) for _ in times], "amount": [draw.choice((1, 2**61)) for _ in times], "arrival": arrival,
        "metric": ["m"] * size, "tags": pa.array([[("x", "y")]] * size, pa.map_(pa.string(), pa.string())),
    }
    return pd.DataFrame({c: v for c, v in columns.items() if c != "tags"}), pa.RecordBatch.from_pydict(columns)


@pytest.mark.parametrize("seed", range(12))
def test_what_a_stretch_sends_judges_like_single_points(seed):
    """Late points that a stretch knows of are only counted, the others go as cells of their interval."""
    draw = random.Random(seed)
    frame, batch = arrow_points(draw, 400, 3, (3, 40)[seed % 2], (1, 7)[seed % 3 == 0])
    shuffled = batch.take(pa.array(draw.sample(range(400), 400)))
    for k in range(4):
        intervals = [(60, k), (300, (k + 1) % 3), (3600, 0)]
        parts = [shuffled.slice(i, 150) for i in (0, 150, 300)]
        rows = pd.concat([b.to_pandas() for b in _cut_partition(iter(parts), intervals)], ignore_index=True)
        assert sorted(rows[rows.kind == "trend"].trend_key) == ["a", "b", "c"]
        for trend in "abc":
            ordered = frame[frame.trend_key == trend].sort_values(["arrival", "grain_start"], kind="stable")
            for seconds, extra in intervals:
                own = rows[(rows.trend_key == trend) & (rows.seconds == seconds)]
                open_ = {seconds: {}}
                closed, late, _ = judge(_cells_in(own[own.kind == "cell"]), [(seconds, extra)], open_)
                final, live, dropped = simulate(ordered["grain_start"].tolist(), seconds, extra)
                assert {w: sum(c[0] for c in held.values()) for _, w, held in closed} == final
                assert {w: sum(c[0] for c in held.values()) for w, held in open_[seconds].items()} == live
                assert late[seconds] + own[own.kind == "late"]["late"].sum() == dropped
                for w, held in [(w, h) for _, w, h in closed] + list(open_[seconds].items()):
                    # A sum that fits is exact, whatever else the rows hold.
                    assert all(total is None or 0 < total < 2**63 for _, total in held.values())


def test_rows_to_the_state_do_not_grow_with_points():
    """A stretch of one trend goes as one row for each interval and kind, and what is late in it as a number."""
    _, batch = arrow_points(random.Random(1), 4000, 1, 1, 1)
    rows = pd.concat([b.to_pandas() for b in _cut_partition(iter([batch]), [(60, 1), (3600, 0)])], ignore_index=True)
    assert len(rows) == 5 and set(rows.kind) == {"trend", "late", "cell"}
    cells = rows[(rows.kind == "cell") & (rows.seconds == 3600)].iloc[0]
    assert len(cells.n) < 400 and sum(cells.n) + rows[(rows.kind == "late") & (rows.seconds == 3600)]["late"].sum() == 4000
    assert next(_cut_partition(iter([batch.slice(0, 0)]), [(60, 1)]), None) is None


def test_sums_beyond_64_bits_go_as_null():
    _, batch = arrow_points(random.Random(2), 8, 1, 1, 1)
    of = {"grain_start": [0] * 8, "bucket": [3] * 3 + [4] * 5, "amount": [2**62, 2**62, 1, 2**53, 1, 0, 0, 0], "slice": [0] * 8}
    batch = pa.RecordBatch.from_pydict({**{n: batch.column(n) for n in batch.schema.names}, **of})
    rows = pd.concat([b.to_pandas() for b in _cut_partition(iter([batch]), [(60, 1)])], ignore_index=True)
    open_ = {60: {}}
    judge(_cells_in(rows[rows.kind == "cell"]), [(60, 1)], open_)
    assert open_ == {60: {0: {3: [3, None], 4: [5, 2**53 + 1]}}}
