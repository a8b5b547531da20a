"""Strict lateness: which points a trend still accepts, counted in windows per trend.

For every trend and interval the newest ``extra_windows + 1`` windows seen so far are open, starting
from the window of the first point. A point is accepted when its window is open or newer than the
oldest open one; opening one window too many closes the oldest.

Put without an order of processing: a window closes at the first arrival of the ``extra_windows + 1``-th
window later than it. So only the first arrival of each window matters, not the sequence of points:

1. ``first_arrivals``: the smallest arrival per trend and grain (the minute that nests in every
   interval), a plain aggregate.
2. ``gates``: per trend, over its minutes, the k-th smallest first arrival of later windows, for every
   interval at once. One row per minute, so the rows of a trend are bounded by its time range.
3. ``judged_cells``: points pre-aggregated by slices of arrival. A slice that lies wholly before or
   after the closing of its window is taken or left as one row. Only slices that contain the moment
   of closing are looked up point by point.

No task ever sorts or holds the points of one trend. Points with the same arrival count as arriving
oldest window first.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom.operators.cells import SERIES, Tally, trend_total, window_start
from trendloom.options import TrendOptions
from trendloom.session import written

BEFORE_ALL = -(2**63)
WINDOW = ("trend_key", "seconds", "win_start")
GATE = ("seconds", "win_start", "opens", "closes")
CELL = (*SERIES, "seconds", "win_start", "bucket")


def arrival_slices(tally: Tally) -> DataFrame:
    """Groups of a sliced tally with their first and last arrival."""
    return tally.rows.groupBy(*tally.part).agg(
        F.count(F.lit(1)).alias("n"),
        F.try_sum("amount").alias("total"),
        F.min("arrival").alias("earliest"),
        F.max("arrival").alias("latest"),
    )


def first_arrivals(spread: DataFrame, opts: TrendOptions, carried: DataFrame | None = None) -> DataFrame:
    """First arrival per trend and minute, as ``first_<seconds>`` for every interval, from spread slices.

    A window carried over counts as there from the start, for its own interval only.
    """
    names = {i.seconds: f"first_{i.seconds}" for i in opts.intervals}
    if carried is None:
        lowest = spread.groupBy("trend_key", "grain_start").agg(F.min("earliest").alias("first"))
        return lowest.select("trend_key", "grain_start", *[F.col("first").alias(n) for n in names.values()])
    seen = spread.select("trend_key", "grain_start", *[F.col("earliest").alias(n) for n in names.values()])
    there = carried.select(
        "trend_key",
        F.col("win_start").alias("grain_start"),
        *[F.when(F.col("seconds") == s, F.lit(BEFORE_ALL)).alias(n) for s, n in names.items()],
    )
    both = seen.unionByName(there)
    return both.groupBy("trend_key", "grain_start").agg(*[F.min(n).alias(n) for n in names.values()])


def gates(firsts: DataFrame, opts: TrendOptions) -> DataFrame:
    """Per trend and minute an array ``gates`` with, for every interval, the window the minute is in,
    ``opens`` (false before the window of the first point) and ``closes`` (null while open).

    The k-th smallest of the first arrivals of later windows is found by passing, k times, the larger of
    each minute's value and the running minimum on to the next running minimum. The minutes of a trend are ordered once, the
    newest first, for all intervals: what holds for later windows is the running minimum just before a window's first row,
    carried on through the window.
    """
    newest_first = Window.partitionBy("trend_key").orderBy(F.col("grain_start").desc())
    upto = newest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = newest_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wins = {i.seconds: f"win_{i.seconds}" for i in opts.intervals}
    rows = firsts.withColumns({win: window_start(F.col("grain_start"), s) for s, win in wins.items()})
    passed = {s: F.col(f"first_{s}") for s in wins}
    smallest: dict[int, str] = {}
    begins = {}
    for s, win in wins.items():
        begins[f"turns_{s}"] = F.coalesce(F.lag(win).over(newest_first) != F.col(win), F.lit(True))
        opening = F.when(F.col(f"first_{s}").isNotNull(), F.struct(F.col(f"first_{s}"), F.col(win)))
        begins[f"beginning_{s}"] = F.min(opening).over(whole)[win]
    rows = rows.withColumns(begins)
    for k in range(max(i.extra_windows for i in opts.intervals) + 1):
        asked = [i.seconds for i in opts.intervals if i.extra_windows >= k]
        rows = rows.withColumns({f"run_{s}": F.min(passed[s]).over(upto) for s in asked})
        rows = rows.withColumns({f"before_{s}": F.lag(f"run_{s}").over(newest_first) for s in asked})
        # A struct, so that a window without later ones is carried on as well.
        carried = {s: F.last(F.when(F.col(f"turns_{s}"), F.struct(F.col(f"before_{s}").alias("v"))), ignorenulls=True) for s in asked}
        rows = rows.withColumns({f"smallest_{s}_{k}": carried[s].over(upto)["v"] for s in asked})
        for s in asked:
            smallest[s] = f"smallest_{s}_{k}"
            both = passed[s].isNotNull() & F.col(smallest[s]).isNotNull()
            rows = rows.withColumn(f"passed_{s}_{k}", F.when(both, F.greatest(passed[s], F.col(smallest[s]))))
            passed[s] = F.col(f"passed_{s}_{k}")
    gate = [
        F.struct(
            F.lit(s).cast("bigint").alias("seconds"),
            F.col(win).alias("win_start"),
            (F.col(win) >= F.col(f"beginning_{s}")).alias("opens"),
            F.col(smallest[s]).alias("closes"),
        )
        for s, win in wins.items()
    ]
    return rows.select("trend_key", "grain_start", F.array(*gate).alias("gates"))


def _within(arrival: Column) -> Column:
    return F.col("opens") & (F.col("closes").isNull() | (arrival <= F.col("closes")))


def _judged(tally: Tally, opts: TrendOptions, carried: DataFrame | None = None) -> DataFrame:
    """Parts of the cells of every interval, with ``accepted`` and ``closes``.

    The rows of ``tally`` need ``arrival``, a whole number that orders the points of a trend; a null
    counts as having arrived first. ``carried`` holds the accepted cells of windows left open by earlier
    points, see the streaming use.
    """
    arrival = F.coalesce(F.col("arrival"), F.lit(BEFORE_ALL + 1))
    sliced = replace(tally, rows=tally.rows.withColumn("arrival", arrival)).with_slices(opts.arrival_block)
    # Written once: the gates, the slices taken whole and the cut ones all come from them.
    spread = tally.spread(written(arrival_slices(sliced), "slices"))
    bars = gates(first_arrivals(spread, opts, carried), opts)
    # Slices repeat long keys, which files hold once: by the size of its files the table would be broadcast far too often.
    joined = spread.join(bars.hint("merge"), ["trend_key", "grain_start"])
    graded = joined.select(
        *[c for c in joined.columns if c != "gates"], F.inline_outer("gates").alias(*GATE)
    )
    whole = _within(F.col("latest")) | ~_within(F.col("earliest"))
    taken = graded.where(whole).select(
        *CELL, "n", trend_total().alias("total"), _within(F.col("latest")).alias("accepted"), "closes"
    )
    # Columns of the grouping that are columns of the cell too are named apart before the rows come back.
    parts = {c: f"part_{c}" for c in sliced.part}
    cut = graded.where(~whole).select(
        *CELL, "by_count", "opens", "closes", *[F.col(c).alias(name) for c, name in parts.items()]
    )
    cut = written(cut, "cut-slices")
    # Raw rows are cut to the minutes and stretches of arrival in question before any of them is shuffled by its whole key.
    near = cut.select(*[F.col(parts[c]).alias(c) for c in ("grain_start", "slice")]).distinct()
    looked_up = sliced.rows.join(near, ["grain_start", "slice"], "left_semi").select(
        F.col("amount").alias("total"),
        F.lit(1).cast("bigint").alias("n"),
        "arrival",
        *[F.col(c).alias(name) for c, name in parts.items()],
    )
    single = looked_up.join(cut.hint("merge"), list(parts.values())).select(
        *CELL, "n", trend_total().alias("total"), _within(F.col("arrival")).alias("accepted"), "closes"
    )
    found = [taken, single]
    if carried is not None:
        kept = carried.select(*CELL, "n", "total", F.lit(True).alias("accepted"))
        windows = bars.select("trend_key", "grain_start", F.inline_outer("gates").alias(*GATE))
        own = windows.where(F.col("grain_start") == F.col("win_start")).select(*WINDOW, "closes")
        found.append(kept.join(own, list(WINDOW)).select(*taken.columns))
    return reduce(DataFrame.unionByName, found)


def judged_cells(tally: Tally, opts: TrendOptions, carried: DataFrame | None = None) -> DataFrame:
    """Cells of every interval with ``accepted`` and ``closed``, in the columns of CELL_SCHEMA; see ``_judged``."""
    return (
        _judged(tally, opts, carried)
        .withColumn("closed", F.col("closes").isNotNull())
        .groupBy(*CELL, "accepted", "closed")
        .agg(F.sum("n").alias("n"), F.try_sum("total").alias("total"))
    )


def accepted_cells(tally: Tally, opts: TrendOptions) -> DataFrame:
    """Cells of the accepted points, all of them or only those of closed windows (``opts.emit``)."""
    cells = judged_cells(tally, opts).where("accepted")
    return cells.where("closed") if opts.emit == "closed" else cells


def late_counts(tally: Tally, opts: TrendOptions) -> DataFrame:
    """Points, accepted points and late points per trend and interval.

    Only numbers of points are asked for, so slices are not cut by value, and parts of cells add up without being made cells.
    """
    return (
        _judged(tally.without_buckets(), opts)
        .groupBy("trend_key", "seconds")
        .agg(
            F.sum("n").alias("points"),
            F.sum(F.when(F.col("accepted"), F.col("n")).otherwise(0)).alias("accepted"),
            F.sum(F.when(F.col("accepted"), F.lit(0)).otherwise(F.col("n"))).alias("late"),
        )
    )
