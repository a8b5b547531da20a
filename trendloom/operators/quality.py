"""Counts of what was dropped and why."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from trendloom import schema as S
from trendloom.functions import histogram as H
from trendloom.functions.spans import has_names, is_denied, is_error
from trendloom.operators.filters import is_valid_point
from trendloom.options import TrendOptions


#: Bits of a delay that a bin leaves open, and the percentiles of delays.
BIN = 15
PERCENTS = (50, 95, 99)


def quality_summary(spans: DataFrame, opts: TrendOptions | None = None) -> DataFrame:
    """One row of counts over spans: invalid, denied, spans per kind of point, and invalid points."""
    opts = opts or TrendOptions()
    named = has_names()
    denied = named & is_denied(opts.deny)
    valid = named & ~denied
    levels = 2 if opts.service_level else 1
    specs = [make() for make in opts.transformers]
    bad_points = []
    for spec in specs:
        made = F.lit(True) if spec.when is None else F.coalesce(spec.when, F.lit(False))
        value = spec.value.cast("double")
        bad = made & ~F.coalesce((value > 0) & ~F.isnan(value), F.lit(False))
        bad_points.append(F.when(bad, F.lit(levels)).otherwise(F.lit(0)))
    per_span = spans.select(
        named.alias("named"),
        denied.alias("denied"),
        valid.alias("valid"),
        is_error().alias("error"),
        reduce(lambda a, b: a + b, bad_points, F.lit(0)).alias("bad"),
    )
    return per_span.agg(
        F.count(F.lit(1)).alias("spans"),
        F.count_if(~F.col("named")).alias("invalid_spans"),
        F.count_if("denied").alias("denied_spans"),
        F.count_if(F.col("valid") & ~F.col("error")).alias("success_spans"),
        F.count_if(F.col("valid") & F.col("error")).alias("failure_spans"),
        F.count_if("valid").alias("duration_spans"),
        F.coalesce(F.sum(F.when(F.col("valid"), F.col("bad").cast("bigint"))), F.lit(0)).alias("invalid_points"),
    )


def active_trends(points: DataFrame, opts: TrendOptions | None = None) -> DataFrame:
    """Number of trends per aggregate."""
    from trendloom.operators.cells import SERIES, prepared_points

    keys = prepared_points(points, opts or TrendOptions()).select(*SERIES).distinct()
    return keys.groupBy("agg_type").agg(F.count(F.lit(1)).alias("trends"))


def time_in_topic(points: DataFrame, arrival_us: str = "arrival", rank_rule: str = "ceil") -> DataFrame:
    """Distribution, per trend, of event time minus arrival time in milliseconds (usually negative).

    Exact ranks in two passes, without ordering all delays of a trend. The first counts delays in bins of ``BIN`` bits and
    says which bins hold the ranks; the second orders the delays of those bins alone. So one task gets the bins of a trend
    (a year of delays has under a million) or the distinct delays of one bin (32,768 at most), whatever the points.
    """
    millis = F.col("ts_sec") * 1000 - F.call_function("div", F.col(arrival_us), F.lit(1000).cast("bigint"))
    delays = points.where(is_valid_point()).select("trend_key", millis.alias("ms")).withColumn("bin", F.shiftright("ms", BIN))
    binned = delays.groupBy("trend_key", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("ms").alias("low"), F.max("ms").alias("high"))
    trend = Window.partitionBy("trend_key")
    running = trend.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A point without a time of arrival counts as a point, and has no delay to rank.
    ranked = binned.where("bin IS NOT NULL").withColumn("cum", F.sum("n").over(running)).withColumn("n_all", F.sum("n").over(trend))
    ranks = F.array(*[F.struct(F.lit(p).alias("percent"), H.rank_of(p, F.col("n_all"), rank_rule).alias("rank")) for p in PERCENTS])
    held = ranked.withColumn("before", F.col("cum") - F.col("n")).withColumn("r", F.explode(ranks))
    wanted = held.where((F.col("before") < F.col("r.rank")) & (F.col("r.rank") <= F.col("cum"))).select(
        "trend_key", "bin", "r.percent", (F.col("r.rank") - F.col("before")).alias("rank")
    )
    bins = wanted.select("trend_key", "bin").distinct()
    counted = delays.join(bins, ["trend_key", "bin"]).groupBy("trend_key", "bin", "ms").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy("trend_key", "bin").orderBy("ms").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fine = counted.withColumn("cum", F.sum("n").over(inside))
    met = fine.join(wanted, ["trend_key", "bin"]).where(F.col("cum") >= F.col("rank"))
    found = met.groupBy("trend_key").agg(*[F.min(F.when(F.col("percent") == p, F.col("ms"))).alias(f"p{p}_ms") for p in PERCENTS])
    ends = binned.groupBy("trend_key").agg(F.sum("n").alias("points"), F.min("low").alias("min_ms"), F.max("high").alias("max_ms"))
    return ends.join(found, "trend_key", "left").select("trend_key", "points", "min_ms", *[f"p{p}_ms" for p in PERCENTS], "max_ms")


def observe_points(points: DataFrame, name: str | Observation = "points") -> DataFrame:
    """The same points, with counts reported to query listeners (streams) or an Observation (batch)."""
    return points.observe(
        name,
        F.count(F.lit(1)).alias("points"),
        F.count_if(~is_valid_point()).alias("invalid_points"),
        F.count_if(F.col("metric") == S.METRIC_SUCCESS).alias("success_points"),
        F.count_if(F.col("metric") == S.METRIC_FAILURE).alias("failure_points"),
        F.count_if(F.col("metric") == S.METRIC_DURATION).alias("duration_points"),
    )
