"""What trends are called: one row per trend, kept apart from the rows that are aggregated.

A point may come with a key of its own, which says nothing about its metric and tags. So aggregation works on a 128-bit id of
the key, which also makes every shuffled row shorter, and the description is joined to the finished windows: ``trend_key``
(the id), ``out_key``, ``metric`` and ``tags``. A trend with several descriptions goes by the smallest.

The dictionary is found by a grouping with a map-side combine over the describing columns alone. It is as large as the
number of trends; whether the join broadcasts it is left to its measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom import schema as S
from trendloom.functions.encoding import encode_name
from trendloom.functions.keys import known_tags_key, trend_key
from trendloom.operators.cells import interval_name
from trendloom.operators.filters import valid_points
from trendloom.operators.points import point_tags, tag_map
from trendloom.operators.stats import offered_stats
from trendloom.options import TrendOptions

#: What the second half of an id is hashed after.
SECOND = 7_919


def trend_id(key: Column) -> Column:
    """128 bits that stand for a key, null for none. Two of 10^9 trends share one with a probability below 1e-20."""
    return F.when(key.isNotNull(), F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(SECOND), key).alias("b")))


def with_trend_id(points: DataFrame) -> DataFrame:
    """The same points with the id in place of the key."""
    return points.withColumn("trend_key", trend_id(F.col("trend_key")))


def _dictionary(described: DataFrame) -> DataFrame:
    """One row per trend out of rows of ``trend_key, metric, entries``."""
    least = described.distinct().groupBy("trend_key").agg(F.min(F.struct("metric", "entries")).alias("d"))
    tags = F.map_from_entries("d.entries")
    return least.select("trend_key", trend_key(F.col("d.metric"), tags).alias("out_key"), F.col("d.metric").alias("metric"), tags.alias("tags"))


def dictionary_of_points(points: DataFrame) -> DataFrame:
    """The trends of valid points, by the id of their key; ``points`` need ``trend_key``, ``metric`` and ``tags``."""
    entries = F.sort_array(F.map_entries(F.coalesce("tags", F.create_map().cast("map<string,string>"))))
    kept = valid_points(points).select(trend_id(F.col("trend_key")).alias("trend_key"), "metric", entries.alias("entries"))
    return _dictionary(kept)


def dictionary_of_spans(spans: DataFrame, opts: TrendOptions) -> DataFrame:
    """The trends that valid spans can have under the standard transformers, from their names alone."""
    names = spans.select(F.coalesce("service_name", F.lit("")).alias("s"), F.coalesce("operation_name", F.lit("")).alias("o")).distinct()
    service, operation = encode_name(F.col("s"), opts.encoder), encode_name(F.col("o"), opts.encoder)
    kinds = [(S.METRIC_DURATION, S.UNIT_MICROSECONDS), (S.METRIC_SUCCESS, S.UNIT_SHORT), (S.METRIC_FAILURE, S.UNIT_SHORT)]
    rows = []
    for with_operation in (True, False) if opts.service_level else (True,):
        for metric, unit in kinds:
            tags = point_tags(opts, unit, S.MTYPE_GAUGE, service, operation if with_operation else None, {})
            key = known_tags_key(F.lit(metric), tags)
            rows.append(F.struct(key.alias("out_key"), F.lit(metric).alias("metric"), F.array_sort(F.map_entries(tag_map(tags))).alias("entries")))
    every = names.select(F.inline(F.array(*rows))).distinct()
    return every.select(trend_id(F.col("out_key")).alias("trend_key"), "out_key", "metric", F.map_from_entries("entries").alias("tags"))


def described_stats(wide: DataFrame, trends: DataFrame, opts: TrendOptions) -> DataFrame:
    """One row per statistic, in the columns of POINT_SCHEMA, out of windows and the dictionary of their trends.

    ``out_key`` names the trend and not the statistic: it is the key of the trend's metric and tags, whatever key its points
    came with.
    """
    names = trends.select("trend_key", *[c for c in ("out_key",) if c in trends.columns], "metric", "tags").dropDuplicates(["trend_key"])
    own = F.map_filter(F.coalesce("tags", F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(S.TAG_INTERVAL, S.TAG_STAT))
    out_key = F.col("out_key") if "out_key" in trends.columns else trend_key(F.col("metric"), F.col("tags"))
    # Taken apart once per trend, so that a statistic only appends its own two tags.
    described = names.select("trend_key", out_key.alias("out_key"), "metric", F.map_keys(own).alias("names"), F.map_values(own).alias("texts"))
    known = wide.where(F.col("agg_type").isin([a.name for a in opts.aggregates])).select(
        "trend_key",
        interval_name(F.col("seconds"), opts.intervals).alias("interval"),
        (F.col("win_start") + F.col("seconds")).alias("ts_sec"),
        offered_stats(opts).alias("offered"),
    )
    # Windows are many more than trends, but may be estimated as fewer. From the left side of an outer join they are never
    # broadcast, nor made into all their statistics by the one task of a small dictionary. Windows without a trend go after it.
    met = known.join(described, "trend_key", "left").withColumn("offered", F.when(F.col("metric").isNotNull(), F.col("offered")))
    long = met.select("*", F.inline_outer("offered").alias("stat", "value")).where(F.col("stat").isNotNull())
    tags = F.map_from_arrays(
        F.concat("names", F.array(F.lit(S.TAG_INTERVAL), F.lit(S.TAG_STAT))), F.concat("texts", F.array(F.col("interval"), F.col("stat")))
    )
    return long.select("out_key", "metric", tags.alias("tags"), "value", "ts_sec")
