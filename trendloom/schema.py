"""Row shapes shared by every operator, and the fixed interval table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TAG_TYPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("v_str", T.StringType()),
        T.StructField("v_bool", T.BooleanType()),
        T.StructField("v_long", T.LongType()),
    ]
)

#: One tracing span. Times are microseconds; tags keep their order.
SPAN_SCHEMA = T.StructType(
    [
        T.StructField("trace_id", T.StringType()),
        T.StructField("span_id", T.StringType()),
        T.StructField("parent_span_id", T.StringType()),
        T.StructField("service_name", T.StringType()),
        T.StructField("operation_name", T.StringType()),
        T.StructField("start_time_us", T.LongType()),
        T.StructField("duration_us", T.LongType()),
        T.StructField("tags", T.ArrayType(TAG_TYPE)),
        T.StructField("arrival", T.LongType()),
    ]
)

#: One metric point, raw or aggregated. ``arrival`` is only read by the strict lateness mode.
POINT_SCHEMA = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("value", T.DoubleType()),
        T.StructField("ts_sec", T.LongType()),
        T.StructField("trend_key", T.StringType()),
        T.StructField("arrival", T.LongType()),
    ]
)

#: One mergeable cell of a trend window. ``bucket`` is NO_BUCKET for aggregates that do not quantise.
CELL_SCHEMA = T.StructType(
    [
        T.StructField("trend_key", T.StringType()),
        T.StructField("agg_type", T.StringType()),
        T.StructField("seconds", T.LongType()),
        T.StructField("win_start", T.LongType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("total", T.LongType()),
    ]
)

NO_BUCKET = -1

# Tag names, metric names, units and statistic names of the point format.
TAG_SERVICE = "serviceName"
TAG_OPERATION = "operationName"
TAG_MTYPE = "mtype"
TAG_UNIT = "unit"
TAG_PRODUCT = "product"
TAG_INTERVAL = "interval"
TAG_STAT = "stat"
SPAN_ERROR_TAG = "error"
METRIC_DURATION = "duration"
METRIC_SUCCESS = "success-span"
METRIC_FAILURE = "failure-span"
MTYPE_GAUGE = "gauge"
UNIT_MICROSECONDS = "microseconds"
UNIT_SHORT = "short"
STAT_MEAN = "mean"
STAT_MAX = "max"
STAT_MIN = "min"
STAT_COUNT = "count"
STAT_STD = "std"
STAT_P50 = "*_50"
STAT_P95 = "*_95"
STAT_P99 = "*_99"
AGG_COUNT = "Count"
AGG_HISTOGRAM = "Histogram"


@dataclass(frozen=True)
class Interval:
    """A tumbling interval; ``extra_windows`` older windows stay open beside the newest one."""

    name: str
    seconds: int
    extra_windows: int

    def __post_init__(self) -> None:
        if self.seconds <= 0:
            raise ValueError(f"interval {self.name} needs a positive length, got {self.seconds}")
        if self.extra_windows < 0:
            raise ValueError(f"interval {self.name} cannot keep {self.extra_windows} extra windows")


# The intervals every trend is computed for.
INTERVALS = (
    Interval("OneMinute", 60, 1),
    Interval("FiveMinute", 300, 1),
    Interval("FifteenMinute", 900, 0),
    Interval("OneHour", 3600, 0),
)
