"""Mergeable cells: points pre-aggregated to one row per trend, window and value bucket.

The widest window that nests in every interval (the grain, one minute by default) is aggregated from
the points, with a map-side combine. Every longer interval is then a sum over those cells, so the
points are grouped once, not once per interval. Grouping on the bucket as well spreads a hot trend over
as many reducers as it has buckets, and bounds what is left of it by the resolution of the histogram.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom import schema as S
from trendloom.functions import histogram as H
from trendloom.functions.encoding import encode_name
from trendloom.functions.keys import known_tags_key
from trendloom.functions.spans import is_error, point_seconds
from trendloom.operators.filters import valid_points
from trendloom.operators.points import DEFAULT_TRANSFORMERS, point_tags
from trendloom.operators.rules import agg_type_of, classify
from trendloom.options import TrendOptions
from trendloom.schema import Interval

SERIES = ("trend_key", "agg_type")


def window_start(ts_sec: Column, seconds: Column | int) -> Column:
    """Start of the epoch-aligned window a second falls in."""
    length = F.lit(seconds).cast("bigint") if isinstance(seconds, int) else seconds
    return F.call_function("div", ts_sec, length) * length


def assign_windows(df: DataFrame, intervals: Sequence[Interval], time: str = "ts_sec") -> DataFrame:
    """One row per interval, with ``seconds`` and the window bounds; the end is the publishing time."""
    lengths = F.array(*[F.lit(i.seconds).cast("bigint") for i in intervals])
    fanned = df.withColumn("seconds", F.explode(lengths))
    fanned = fanned.withColumn("win_start", window_start(F.col(time), F.col("seconds")))
    return fanned.withColumn("win_end", F.col("win_start") + F.col("seconds"))


def interval_name(seconds: Column, intervals: Sequence[Interval]) -> Column:
    named = F
    for interval in intervals:
        named = named.when(seconds == interval.seconds, F.lit(interval.name))
    return named


@dataclass(frozen=True)
class Tally:
    """Rows to count, how to group them, and which trends a group belongs to.

    ``rows`` hold the columns of ``part``, a whole ``amount`` and, where lateness matters, ``arrival``.
    ``spread`` turns a group into one row per trend it feeds: it adds the trend key, the aggregation, the
    value bucket, and ``by_count``, which says that the trend sums the rows and not their amounts.
    """

    rows: DataFrame
    part: tuple[str, ...]
    spread: Callable[[DataFrame], DataFrame]

    def with_slices(self, width: int) -> Tally:
        """The same with ``slice``, a stretch of arrival of the given width, as part of the grouping."""
        cut = F.call_function("div", F.col("arrival"), F.lit(width).cast("bigint"))
        return Tally(self.rows.withColumn("slice", cut), (*self.part, "slice"), self.spread)

    def without_buckets(self) -> Tally:
        """The same for numbers of points: whether a row has a bucket is kept, and not which."""
        names = [c for c in self.part if c in ("low", "bucket")]
        return replace(self, rows=self.rows.withColumns({c: F.least(F.col(c), F.lit(0).cast("bigint")) for c in names}))


def trend_total() -> Column:
    """What a spread group adds to its trend."""
    return F.when(F.col("by_count"), F.col("n")).otherwise(F.col("total"))


def prepared_points(points: DataFrame, opts: TrendOptions) -> DataFrame:
    """Valid, classified points with ``amount`` (whole value), ``bucket`` and ``grain_start``."""
    kept = valid_points(points)
    typed = (kept if "agg_type" in points.columns else classify(kept, opts.rules)).where(F.col("agg_type").isNotNull())
    bucket = F
    for aggregate in opts.aggregates:
        if aggregate.bucket is not None:
            bucket = bucket.when(F.col("agg_type") == aggregate.name, aggregate.bucket(F.col("amount"), opts.histogram))
    none = F.lit(S.NO_BUCKET).cast("bigint")
    return (
        typed.withColumn("amount", H.to_long(F.col("value")))
        .withColumn("bucket", none if bucket is F else bucket.otherwise(none))
        .withColumn("grain_start", window_start(F.coalesce("ts_sec", F.lit(0)), opts.grain))
    )


def tally_points(points: DataFrame, opts: TrendOptions) -> Tally:
    """Any points; each belongs to the one trend of its key."""
    rows = prepared_points(points, opts)
    return Tally(rows, (*SERIES, "grain_start", "bucket"), lambda groups: groups.withColumn("by_count", F.lit(False)))


def tally_spans(spans: DataFrame, opts: TrendOptions) -> Tally:
    """Valid spans under the two standard transformers.

    The points of a span follow from its names, error flag and duration, so spans are grouped by those,
    one row each, and the duration and status trends of both levels are read off the groups.
    """
    if tuple(opts.transformers) != DEFAULT_TRANSFORMERS:
        raise ValueError("tally_spans knows the standard transformers only, use tally_points")
    histogram = next((a for a in opts.aggregates if a.name == S.AGG_HISTOGRAM), None)
    timed, counted = _kinds(opts)
    zero, none = F.lit(0).cast("bigint"), F.lit(S.NO_BUCKET).cast("bigint")
    duration = F.coalesce(F.col("duration_us"), zero)
    low = zero if histogram is None else histogram.bucket(duration, opts.histogram)
    # Nothing here can be null, so that joins on these columns add no filters of their own to the plan.
    rows = spans.select(
        F.coalesce("service_name", F.lit("")).alias("service_name"),
        F.coalesce("operation_name", F.lit("")).alias("operation_name"),
        *([is_error().alias("error")] if counted else []),
        window_start(point_seconds(), opts.grain).alias("grain_start"),
        *([F.coalesce(F.when(duration > 0, low), none).alias("low")] if timed else []),
        F.greatest(duration, zero).alias("amount"),
        *[F.col(c) for c in ("arrival",) if c in spans.columns],
    )
    if not counted:
        rows = rows.where(F.col("low") >= 0)
    # What no kind of trend asks for is no part of the grouping.
    part = ("service_name", "operation_name", *(["error"] if counted else []), "grain_start", *(["low"] if timed else []))
    return Tally(rows, part, lambda groups: _spread_spans(groups, opts))


def _kinds(opts: TrendOptions) -> tuple[bool, bool]:
    """Whether some rule asks for duration trends, and some for status trends."""

    def served(name: str) -> bool:
        return any(r.contains.lower() in name for r in opts.rules)

    timed = served(S.METRIC_DURATION)
    return timed, served(S.METRIC_SUCCESS) or served(S.METRIC_FAILURE) or not timed


def _spread_spans(groups: DataFrame, opts: TrendOptions) -> DataFrame:
    """Trends of grouped spans: duration and status, with the operation and for the service alone."""
    service, operation = encode_name(F.col("service_name"), opts.encoder), encode_name(
        F.col("operation_name"), opts.encoder
    )
    timed, counted = _kinds(opts)
    levels = (operation, None) if opts.service_level else (operation,)
    variants = [(of_duration, op) for op in levels for of_duration in ([True] if timed else []) + ([False] if counted else [])]
    status = F.when(F.col("error"), F.lit(S.METRIC_FAILURE)).otherwise(F.lit(S.METRIC_SUCCESS)) if counted else F.lit("")
    is_duration = F.col("variant").isin([i for i, v in enumerate(variants) if v[0]])
    rows = groups.withColumn("variant", F.explode(F.array(*[F.lit(i) for i in range(len(variants))])))
    if timed:
        rows = rows.where(~is_duration | (F.col("low") >= 0))
    key, agg_type = F, F
    for i, (of_duration, op) in enumerate(variants):
        metric = F.lit(S.METRIC_DURATION) if of_duration else status
        unit = S.UNIT_MICROSECONDS if of_duration else S.UNIT_SHORT
        chosen = F.col("variant") == i
        key = key.when(chosen, known_tags_key(metric, point_tags(opts, unit, S.MTYPE_GAUGE, service, op, {})))
        agg_type = agg_type.when(chosen, agg_type_of(metric, F.lit(S.MTYPE_GAUGE), opts.rules))
    bucketed = F.lit(S.NO_BUCKET).cast("bigint")
    if timed:
        bucketed = F.when(is_duration, F.col("low")).otherwise(bucketed)
    named = rows.withColumns(
        {"trend_key": key, "agg_type": agg_type, "bucket": bucketed, "by_count": ~is_duration}
    )
    return named.where(F.col("agg_type").isNotNull()).drop("variant")


def grain_cells(tally: Tally) -> DataFrame:
    """Cells of the grain. A trend can have several cells for one bucket; they add up like any others."""
    groups = tally.rows.groupBy(*tally.part).agg(
        F.count(F.lit(1)).alias("n"), F.try_sum("amount").alias("total")
    )
    return tally.spread(groups).select(
        *SERIES, "grain_start", "bucket", "n", trend_total().alias("total")
    )


def point_cells(points: DataFrame, opts: TrendOptions) -> DataFrame:
    return grain_cells(tally_points(points, opts))


def span_cells(spans: DataFrame, opts: TrendOptions) -> DataFrame:
    return grain_cells(tally_spans(spans, opts))


def roll_up(cells: DataFrame, intervals: Sequence[Interval], keep: Sequence[str] = ()) -> DataFrame:
    """Cells of the grain to cells of every interval, as in CELL_SCHEMA. ``keep`` names columns that windows share."""
    return (
        assign_windows(cells, intervals, "grain_start")
        .groupBy(*SERIES, *keep, "seconds", "win_start", "bucket")
        .agg(F.sum("n").alias("n"), F.try_sum("total").alias("total"))
    )
