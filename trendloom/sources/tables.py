"""Spans derived from the event and line item tables, as columns over those tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.schema import TAG_TYPE

DAY_START_SEC = 1_704_067_200


def _tag(key: str, type_: str, v_str: str | None = None, v_bool: bool | None = None, v_long: int | None = None) -> Column:
    return F.struct(
        F.lit(key).alias("key"),
        F.lit(type_).alias("type"),
        F.lit(v_str).cast("string").alias("v_str"),
        F.lit(v_bool).cast("boolean").alias("v_bool"),
        F.lit(v_long).cast("bigint").alias("v_long"),
    )


def _tags_of_case(case: Column) -> Column:
    none = F.array().cast(f"array<{TAG_TYPE.simpleString()}>")
    return (
        F.when(case == 1, F.array(_tag("error", "BOOL", v_bool=True)))
        .when(case == 2, F.array(_tag("error", "BOOL", v_bool=False)))
        .when(case == 3, F.array(_tag("ERROR", "STRING", v_str="False")))
        .when(case == 4, F.array(_tag("error", "STRING", v_str="500")))
        .when(case == 5, F.array(_tag("error", "LONG", v_long=100)))
        .when(case == 6, F.array(_tag("http.status", "LONG", v_long=200), _tag("error", "BOOL", v_bool=True)))
        .otherwise(none)
    )


def spans_from_events(events: DataFrame) -> DataFrame:
    """One span per event: sparse, in order of time; ``arrival`` is up to three hours later.

    The session time zone must be UTC, as event times carry no zone.
    """
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    delay = ((F.col("event_id") * 7919) % 10800) * 1_000_000
    duration = (
        F.when(F.col("event_id") % 53 == 0, F.lit(0.0))
        .when(F.col("event_id") % 50 == 0, F.col("value") * 10)
        .otherwise(F.col("value") * 10_000_000)
    )
    return events.select(
        "event_id",
        F.when(F.col("event_id") % 97 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("svc."), (F.col("user_id") % 8).cast("string")))
        .alias("service_name"),
        F.concat(F.lit("op."), F.col("event_type")).alias("operation_name"),
        start.alias("start_time_us"),
        F.floor(duration).cast("bigint").alias("duration_us"),
        _tags_of_case(F.col("event_id") % 7).alias("tags"),
        (start + delay).alias("arrival"),
    )


def spans_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One span per line: dense, one day of event time, up to three minutes of delay.

    ``arrival`` orders by second of arrival, then order key, then line number, in one whole number:
    2^44 per second leaves room for order keys up to 2^41.
    """
    second = (F.col("l_orderkey") * 37) % 86400
    arrival_second = second + (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17) % 180
    none = F.array().cast(f"array<{TAG_TYPE.simpleString()}>")
    return lineitem.select(
        F.concat(F.lit("svc."), F.col("l_returnflag"), F.lit("."), F.col("l_linestatus")).alias("service_name"),
        F.concat(F.lit("op."), F.col("l_linenumber").cast("string")).alias("operation_name"),
        ((F.lit(DAY_START_SEC) + second) * 1_000_000 + F.col("l_partkey") % 1_000_000).alias("start_time_us"),
        F.floor(F.col("l_extendedprice") * 1000).cast("bigint").alias("duration_us"),
        none.alias("tags"),
        (arrival_second * F.lit(2**44) + F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("arrival"),
    )
