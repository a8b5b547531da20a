"""Small literal inputs and a point-by-point model of the strict rule."""

from __future__ import annotations

from pyspark.sql import types as T

from trendloom.schema import POINT_SCHEMA, SPAN_SCHEMA

SERVICE, OPERATION = "testService", "testSpan"


def spans(spark, rows):
    full = []
    for i, row in enumerate(rows):
        base = dict(
            trace_id=str(i), span_id=str(i), parent_span_id=None, service_name=SERVICE, operation_name=OPERATION,
            start_time_us=1_529_042_838_469_123, duration_us=1000, tags=[], arrival=i,
        )
        full.append({**base, **row})
    return spark.createDataFrame(full, SPAN_SCHEMA)


def tag(key, type_=None, v_str=None, v_bool=None, v_long=None):
    return dict(key=key, type=type_, v_str=v_str, v_bool=v_bool, v_long=v_long)


def points(spark, metric, values_at, tags=None):
    """Points of one trend from (value, second) pairs in order of arrival."""
    tags = tags or {"mtype": "gauge", "unit": "short"}
    key = ",".join([metric] + [f"{k}={v}" for k, v in sorted(tags.items())])
    rows = [(metric, tags, float(v), int(s), key, i) for i, (v, s) in enumerate(values_at)]
    return spark.createDataFrame(rows, T.StructType(POINT_SCHEMA.fields))


def simulate(seconds_in_order, length, extra):
    """Final and open windows of one trend, point by point: {window: count}, {window: count}, dropped."""
    live, final, dropped = {}, {}, 0
    for s in seconds_in_order:
        w = s // length * length
        if not live or w in live:
            live[w] = live.get(w, 0) + 1
        elif w > min(live):
            live[w] = 1
            if len(live) > extra + 1:
                oldest = min(live)
                final[oldest] = live.pop(oldest)
        else:
            dropped += 1
    return final, live, dropped
