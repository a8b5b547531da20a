"""Cells of a window to statistics, wide or one row per statistic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendloom import schema as S
from trendloom.functions.keys import description, key_entries, key_metric
from trendloom.operators.cells import SERIES, interval_name
from trendloom.options import TrendOptions

WINDOW_KEYS = (*SERIES, "seconds", "win_start")


def window_stats(cells: DataFrame, opts: TrendOptions, keep: Sequence[str] = ()) -> DataFrame:
    """One row per trend window with the statistics of every aggregate, null for the ones not its own.

    The running count over the buckets of a window gives exact weighted ranks. A window has at most
    ``bucket_limit`` cells, whatever the number of points behind them. ``keep`` names columns that all cells of a window share.
    """
    keys = (*WINDOW_KEYS, *keep)
    ordered = Window.partitionBy(*keys).orderBy("bucket")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One order for both, so that Spark goes through the cells of a window once.
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = cells.withColumns({"cum": F.sum("n").over(running), "n_all": F.sum("n").over(whole)})
    sums, derived = [], []
    for aggregate in opts.aggregates:
        if aggregate.cell is not None:
            rows = rows.withColumns(dict(aggregate.cell(opts.histogram)))
        own = F.col("agg_type") == aggregate.name
        sums += [column.alias(name) for name, column in aggregate.sums(opts.histogram).items()]
        if aggregate.derived is not None:
            derived += [
                {name: F.when(own, column) for name, column in step.items()}
                for step in aggregate.derived(opts.histogram)
            ]
    wide = rows.groupBy(*keys).agg(F.sum("n").alias("points"), *sums)
    for step in derived:
        wide = wide.withColumns(step)
    stats = []
    for aggregate in opts.aggregates:
        own = F.col("agg_type") == aggregate.name
        stats += [F.when(own, F.col(name)).alias(name) for name in aggregate.stats.values()]
    return wide.select(*keys, "points", *stats)


def offered_stats(opts: TrendOptions) -> Column:
    """The statistics of a window as an array of names and values, null for an aggregate that is not known."""
    offered: Column = F
    for aggregate in opts.aggregates:
        rows = [
            F.struct(F.lit(stat).alias("stat"), F.col(name).cast("double").alias("value"))
            for stat, name in aggregate.stats.items()
        ]
        offered = offered.when(F.col("agg_type") == aggregate.name, F.array(*rows))
    return offered


def stat_rows(wide: DataFrame, opts: TrendOptions) -> DataFrame:
    """One row per statistic, in the columns of POINT_SCHEMA; the timestamp is the window end.

    Metric and tags are read back from the trend key, or from the part of it that describes the trend, which is also
    ``out_key``: it names the trend, not the statistic. ``operators.dictionary`` is the way for keys that don't describe.
    """
    # The outer form keeps Spark from deriving a filter over the whole array and repeating its expressions.
    known = wide.where(F.col("agg_type").isin([a.name for a in opts.aggregates]))
    own = F.filter(key_entries(F.col("out_key")), lambda e: ~e["key"].isin(S.TAG_INTERVAL, S.TAG_STAT))
    described = known.withColumn("out_key", description(F.col("trend_key"))).select(
        "out_key",
        key_metric(F.col("out_key")).alias("metric"),
        own.alias("own"),
        interval_name(F.col("seconds"), opts.intervals).alias("interval"),
        (F.col("win_start") + F.col("seconds")).alias("ts_sec"),
        offered_stats(opts).alias("offered"),
    )
    # The key is read once for a window: a statistic only appends its own two tags.
    # The outer form keeps Spark from deriving a filter over the whole array and repeating its expressions.
    long = described.select("*", F.inline_outer("offered").alias("stat", "value"))
    return long.select("out_key", "metric", aggregated_tags(F.col("own")).alias("tags"), "value", "ts_sec")


def aggregated_tags(own: Column) -> Column:
    """The tags of a trend, an array of names and values, with those of the row's ``interval`` and ``stat``."""
    added = [
        F.struct(F.lit(name).alias("key"), F.col(column).alias("value"))
        for name, column in ((S.TAG_INTERVAL, "interval"), (S.TAG_STAT, "stat"))
    ]
    return F.map_from_entries(F.concat(own, F.array(*added)))
