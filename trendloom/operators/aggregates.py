"""Aggregates a rule can name.

An aggregate says how a point's value is quantised before grouping (``bucket``) and how the cells of a
window become statistics, in steps that Spark plans as one aggregation between projections:
``cell`` columns per cell, ``sums`` aggregate columns over the cells, ``derived`` columns per window.
Cell and sum expressions may use ``bucket``, ``n`` (points), ``total`` (sum of whole values), ``cum``
(points up to and including this bucket) and ``n_all`` (points of the window). ``stats`` names the
column of each statistic.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom import schema as S
from trendloom.functions import histogram as H
from trendloom.options import HistogramOptions

Columns = Mapping[str, Column]


@dataclass(frozen=True)
class Aggregate:
    name: str
    stats: Mapping[str, str]
    sums: Callable[[HistogramOptions], Columns]
    bucket: Callable[[Column, HistogramOptions], Column] | None = None
    cell: Callable[[HistogramOptions], Columns] | None = None
    derived: Callable[[HistogramOptions], Sequence[Columns]] | None = None


def count_sums(_: HistogramOptions) -> Columns:
    return {"count": F.try_sum("total")}


def duration_bucket(value_us: Column, opts: HistogramOptions) -> Column:
    return H.bucket_low(H.recorded(value_us, opts), opts)


def histogram_cell(opts: HistogramOptions) -> Columns:
    return {"middle": H.bucket_middle(F.col("bucket"), opts)}


def percentile(percent: int, opts: HistogramOptions) -> Column:
    """Lowest bucket that reaches the rank of the percentile, in microseconds."""
    reached = F.col("cum") >= H.rank_of(percent, F.col("n_all"), opts.rank_rule)
    return F.min(F.when(reached, F.col("bucket"))) * F.lit(opts.unit_us).cast("bigint")


def histogram_sums(opts: HistogramOptions) -> Columns:
    """Bucket lows for min, max and percentiles; exact sums of bucket middles for mean and std."""
    unit = F.lit(opts.unit_us).cast("bigint")
    # Middles are below 2^bits. Their squares are summed in two halves of so many bits; a window has at most bucket_limit cells.
    bits = opts.max_value.bit_length() + 1
    limit = 2**61 // (2**bits * H.bucket_limit(opts))
    n, middle = F.col("n"), F.col("middle")
    fits = middle.between(F.lit(-1), F.lit(2**bits - 1)) & (n < F.lit(limit))

    def short(part: Column) -> Column:
        return F.coalesce(F.sum(F.when(fits, part * n)), F.lit(0)).cast("decimal(38,0)")

    def wide(factor: Column) -> Column:
        product = factor.cast("decimal(20,0)") * n.cast("decimal(18,0)")
        return F.coalesce(F.sum(F.when(~fits, product)), F.lit(0).cast("decimal(38,0)"))

    square = middle * middle
    high, low = F.shiftright(square, bits), square.bitwiseAND(F.lit(2**bits - 1).cast("bigint"))
    # Sums of decimals cost many times those of whole numbers, so only cells that don't fit 64 bits go by decimals.
    return {
        "hist_n": F.sum("n"),
        "hist_total": short(middle) + wide(middle),
        "hist_squares": short(high) * F.lit(2**bits).cast("decimal(18,0)") + short(low) + wide(square),
        "min": F.min("bucket") * unit,
        "max": F.max("bucket") * unit,
        "p50": percentile(50, opts),
        "p95": percentile(95, opts),
        "p99": percentile(99, opts),
    }


def histogram_derived(opts: HistogramOptions) -> Sequence[Columns]:
    """Mean and standard deviation, cut to whole units, in microseconds."""
    unit = F.lit(opts.unit_us).cast("bigint")
    steps = H.truncated_std_steps("hist_n", "hist_total", "hist_squares", "hist_root")
    return [*steps, {"mean": F.col("hist_root_mean") * unit, "std": F.col("hist_root") * unit}]


# The statistics of each aggregate.
COUNT_STATS = {S.STAT_COUNT: "count"}
HISTOGRAM_STATS = {
    S.STAT_MEAN: "mean",
    S.STAT_MIN: "min",
    S.STAT_P95: "p95",
    S.STAT_P99: "p99",
    S.STAT_STD: "std",
    S.STAT_P50: "p50",
    S.STAT_MAX: "max",
}

DEFAULT_AGGREGATES = (
    Aggregate(S.AGG_COUNT, COUNT_STATS, count_sums),
    Aggregate(
        S.AGG_HISTOGRAM, HISTOGRAM_STATS, histogram_sums, duration_bucket, histogram_cell, histogram_derived
    ),
)
