"""Points stored by trend and hour, so that trends are computed without moving them.

A table is bucketed by trend and hour and sorted inside its files. All windows up to an hour lie in one hour, so the grouping
of points, its sums over longer intervals and the ranks inside windows all find their rows together. A trend with a large
share of all points is spread over as many buckets as it has hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.operators.cells import SERIES, prepared_points, roll_up, window_start
from trendloom.operators.dictionary import described_stats
from trendloom.operators.enrich import add_tags
from trendloom.operators.rules import with_trend_key
from trendloom.operators.stats import window_stats
from trendloom.options import TrendOptions
from trendloom.functions.keys import trend_key

HOUR = 3600
PLACE = ("trend_key", "hour")


def store_points(points: DataFrame, table: str, path: str, buckets: int = 64, mode: str = "append") -> None:
    """Points as the bucketed table ``table`` with its files under ``path``; appended, or ``mode="overwrite"``.

    The rows are dealt like the buckets, so each bucket of a write is one file.
    """
    keyed = with_trend_key(points).withColumn("hour", window_start(F.coalesce("ts_sec", F.lit(0)), HOUR))
    dealt = keyed.repartition(buckets, *PLACE)
    dealt.write.mode(mode).option("path", path).bucketBy(buckets, *PLACE).sortBy(*PLACE, "ts_sec").saveAsTable(table)


def register_points(spark: SparkSession, table: str, path: str, buckets: int = 64) -> DataFrame:
    """Makes a table that another session stored known to this one, under the same number of buckets."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({', '.join(PLACE)}) "
        f"SORTED BY ({', '.join(PLACE)}, ts_sec) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def stored_windows(points: DataFrame, opts: TrendOptions | None = None) -> DataFrame:
    """Statistics of every window of a bucketed table, with its ``hour``; intervals must divide an hour."""
    opts = opts or TrendOptions()
    if any(HOUR % i.seconds for i in opts.intervals):
        raise ValueError("intervals of stored points must divide an hour")
    rows = prepared_points(points, opts)
    cells = rows.groupBy(*SERIES, "hour", "grain_start", "bucket").agg(F.count(F.lit(1)).alias("n"), F.try_sum("amount").alias("total"))
    return window_stats(roll_up(cells, opts.intervals, keep=("hour",)), opts, keep=("hour",))


def stored_dictionary(points: DataFrame) -> DataFrame:
    """What the trends of a bucketed table are called; found inside the buckets, then once per trend."""
    entries = F.sort_array(F.map_entries(F.coalesce("tags", F.create_map().cast("map<string,string>"))))
    inside = points.select(*PLACE, "metric", entries.alias("entries")).distinct()
    least = inside.groupBy("trend_key").agg(F.min(F.struct("metric", "entries")).alias("d"))
    tags = F.map_from_entries("d.entries")
    return least.select("trend_key", trend_key(F.col("d.metric"), tags).alias("out_key"), F.col("d.metric").alias("metric"), tags.alias("tags"))


def stored_trends(points: DataFrame, opts: TrendOptions | None = None) -> DataFrame:
    """Trends of a bucketed table of points. Points are not exchanged; finished windows meet the dictionary of trends."""
    opts = opts or TrendOptions()
    return add_tags(described_stats(stored_windows(points, opts), stored_dictionary(points), opts), opts.extra_tags)
