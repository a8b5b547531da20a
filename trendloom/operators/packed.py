"""Packed histograms: one row per trend and window, from which any percentile can be asked later.

A row holds the values of its buckets in order and how many points lie up to and including each. Rows of the same trend are
merged by adding, so the minutes of a day can be kept and asked for any longer window. A row has at most as many entries as
the histogram has buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom import schema as S
from trendloom.functions import histogram as H
from trendloom.operators.cells import SERIES, window_start
from trendloom.operators.stats import WINDOW_KEYS
from trendloom.options import HistogramOptions


def packed(cells: DataFrame) -> DataFrame:
    """``trend_key, agg_type, seconds, win_start, points, buckets, counts`` out of cells of histograms, in CELL_SCHEMA.

    ``counts[i]`` is the number of points in ``buckets[0]`` to ``buckets[i]``.
    """
    once = cells.where(F.col("agg_type") == S.AGG_HISTOGRAM).groupBy(*WINDOW_KEYS, "bucket").agg(F.sum("n").alias("n"))
    rows = once.groupBy(*WINDOW_KEYS).agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("cells"), F.sum("n").alias("points"))
    start = F.array().cast("array<bigint>")
    running = F.aggregate(
        "cells", start, lambda seen, c: F.concat(seen, F.array(F.coalesce(F.try_element_at(seen, F.lit(-1)), F.lit(0).cast("bigint")) + c["n"]))
    )
    return rows.select(*WINDOW_KEYS, "points", F.transform("cells", lambda c: c["bucket"]).alias("buckets"), running.alias("counts"))


def unpacked(rows: DataFrame) -> DataFrame:
    """The cells of packed rows: ``trend_key, agg_type, seconds, win_start, bucket, n``."""
    each = rows.select(*WINDOW_KEYS, F.posexplode(F.arrays_zip("buckets", "counts")).alias("i", "c"), "counts")
    before = F.coalesce(F.get("counts", F.col("i") - 1), F.lit(0).cast("bigint"))
    return each.select(*WINDOW_KEYS, F.col("c.buckets").alias("bucket"), (F.col("c.counts") - before).alias("n"))


def merged(rows: DataFrame, seconds: Sequence[int]) -> DataFrame:
    """Packed rows of longer windows out of those of windows that nest in them, for every length asked for."""
    cells = unpacked(rows).withColumnRenamed("seconds", "own").withColumnRenamed("win_start", "at")
    fanned = cells.withColumn("seconds", F.explode(F.array(*[F.lit(s).cast("bigint") for s in seconds])))
    nested = fanned.where(F.col("seconds") % F.col("own") == 0).withColumn("win_start", window_start(F.col("at"), F.col("seconds")))
    return packed(nested.select(*SERIES, "seconds", "win_start", "bucket", "n"))


def percentile_of(percent: int, opts: HistogramOptions) -> Column:
    """The percentile of a packed row, in microseconds: the lowest bucket that reaches its rank."""
    rank = H.rank_of(percent, F.col("points"), opts.rank_rule)
    below = F.size(F.filter("counts", lambda c: c < rank))
    return F.get("buckets", below) * F.lit(opts.unit_us).cast("bigint")


def share_below(value_us: int, opts: HistogramOptions) -> Column:
    """The share of points in buckets up to the one of the value."""
    low = H.bucket_low(H.recorded(F.lit(value_us).cast("bigint"), opts), opts)
    upto = F.size(F.filter("buckets", lambda b: b <= low))
    return F.coalesce(F.get("counts", upto - 1), F.lit(0)) / F.col("points")


def percentiles(rows: DataFrame, percents: Sequence[int], opts: HistogramOptions | None = None) -> DataFrame:
    """Packed rows with one column ``p<percent>`` for each percentile asked for."""
    opts = opts or HistogramOptions()
    if any(not 0 < p <= 100 for p in percents):
        raise ValueError(f"percentiles must be above 0 and at most 100, got {list(percents)}")
    return reduce(lambda df, p: df.withColumn(f"p{p}", percentile_of(p, opts)), percents, rows).drop("buckets", "counts")
