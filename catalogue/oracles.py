"""Comparison SQL for the registered queries, written apart from the operators.

Trends are counted point by point and interval by interval here, ranks by row number, and lateness by the
running floor of each trend in order of arrival.
"""

from __future__ import annotations

ROLLUP = (60, 300, 900, 3600)
NAMES = {60: "OneMinute", 300: "FiveMinute", 900: "FifteenMinute", 3600: "OneHour"}
EXTRA = {60: 1, 300: 1, 900: 0, 3600: 0}

EVENT_SPANS = """
espans AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN '' ELSE concat('svc.', CAST(user_id % 8 AS VARCHAR)) END AS service_name,
    concat('op.', event_type) AS operation_name,
    epoch_us(ts) AS start_us,
    CAST(floor(CASE WHEN event_id % 53 = 0 THEN 0 WHEN event_id % 50 = 0 THEN value * 10
                    ELSE value * 10000000 END) AS BIGINT) AS duration_us,
    event_id % 7 IN (1, 4, 5, 6) AS error,
    epoch_us(ts) + ((event_id * 7919) % 10800) * 1000000 AS arrival
  FROM events)
"""

LINE_SPANS = """
lspans AS (
  SELECT concat('svc.', l_returnflag, '.', l_linestatus) AS service_name,
    concat('op.', CAST(l_linenumber AS VARCHAR)) AS operation_name,
    1704067200000000 + ((l_orderkey * 37) % 86400) * 1000000 + l_partkey % 1000000 AS start_us,
    CAST(floor(l_extendedprice * 1000) AS BIGINT) AS duration_us,
    false AS error,
    (((l_orderkey * 37) % 86400) + ((l_orderkey * 31 + l_linenumber * 17) % 180)) * 17592186044416
      + l_orderkey * 8 + l_linenumber AS arrival,
    0 AS event_id
  FROM lineitem)
"""


def _points(spans: str, levels: tuple[str, ...] = ("op", "svc"), product: str = "tracing") -> str:
    """Points of all valid spans, one SELECT per metric and level."""
    parts = []
    for level in levels:
        op = "operationName={o}," if level == "op" else ""
        for kind in ("duration", "status"):
            unit = "microseconds" if kind == "duration" else "short"
            metric = "'duration'" if kind == "duration" else "CASE WHEN error THEN 'failure-span' ELSE 'success-span' END"
            value = "CAST(duration_us AS DOUBLE)" if kind == "duration" else "CAST(1 AS DOUBLE)"
            operation = "replace(operation_name, '.', '___')"
            tags = f"'mtype=gauge,' || " + (f"'operationName=' || {operation} || ',' || " if op else "")
            tags += f"'product={product},serviceName=' || replace(service_name, '.', '___') || ',unit={unit}'"
            parts.append(
                f"SELECT event_id, {metric} AS metric, {tags} AS tags, {value} AS value, "
                f"start_us // 1000000 AS ts_sec, arrival, '{level}' AS level "
                f"FROM {spans} WHERE service_name <> '' AND operation_name <> ''"
            )
    return "points AS (SELECT *, metric || ',' || tags AS trend_key FROM (" + " UNION ALL ".join(parts) + "))"


def _fan(seconds: tuple[int, ...] = ROLLUP, source: str = "points", name: str = "fan") -> str:
    rows = ", ".join(f"({s}, '{NAMES[s]}', {EXTRA[s]})" for s in seconds)
    return (
        f"{name} AS (SELECT p.*, i.seconds, i.interval_name, i.extra, (p.ts_sec // i.seconds) * i.seconds AS win "
        f"FROM {source} p, (VALUES {rows}) i(seconds, interval_name, extra) WHERE p.value > 0)"
    )


# Accepted points: the floor is the oldest open window of a trend, rising in order of arrival.
FLOOR = """
f0 AS (SELECT *, first_value(win) OVER o AS w0 FROM fan
       WINDOW o AS (PARTITION BY trend_key, seconds ORDER BY arrival, ts_sec ROWS UNBOUNDED PRECEDING)),
f1 AS (SELECT *, CASE WHEN win >= w0 THEN win END AS wr FROM f0),
f2 AS (SELECT *, max(wr) OVER (PARTITION BY trend_key, seconds ORDER BY arrival, ts_sec
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM f1),
f3 AS (SELECT *, CASE WHEN wr > m THEN m WHEN wr < m THEN wr END AS cand FROM f2),
f4 AS (SELECT *, CASE WHEN extra = 0
         THEN max(wr) OVER (PARTITION BY trend_key, seconds ORDER BY arrival, ts_sec ROWS UNBOUNDED PRECEDING)
         ELSE coalesce(max(cand) OVER (PARTITION BY trend_key, seconds ORDER BY arrival, ts_sec
           ROWS UNBOUNDED PRECEDING), w0) END AS floor_now FROM f3),
f5 AS (SELECT *, lag(floor_now) OVER (PARTITION BY trend_key, seconds ORDER BY arrival, ts_sec) AS floor_before,
         max(floor_now) OVER (PARTITION BY trend_key, seconds) AS floor_end FROM f4),
judged AS (SELECT *, win >= coalesce(floor_before, w0) AS accepted, win < floor_end AS closed FROM f5)
"""


def _hist(
    source: str, where: str = "true", rank: str = "half_up", unit: int = 1000, limit: int = 1800000, bits: int = 8,
    percents: tuple[int, ...] = (50, 95, 99),
) -> str:
    """Histogram statistics per trend window, value by value."""
    def rank_of(p: int) -> str:
        if rank == "half_up":
            return f"greatest(1, CAST(floor({p / 100.0}::DOUBLE * n + 0.5) AS BIGINT))"
        return f"greatest(1, ({p} * n + 99) // 100)"

    picks = ", ".join(f"min(CASE WHEN rn >= {rank_of(p)} THEN lo END) * {unit} AS p{p}" for p in percents)
    return f"""
h0 AS (SELECT trend_key, seconds, interval_name, win,
         least(CAST(trunc(value) AS BIGINT), {limit} * {unit}) // {unit} AS v
       FROM {source} WHERE metric = 'duration' AND {where}),
h1 AS (SELECT *, greatest(0, length(bin(greatest(v, 1))) - {bits}) AS b FROM h0),
h2 AS (SELECT *, (v >> b) << b AS lo, ((v >> b) << b) + ((CAST(1 AS BIGINT) << b) >> 1) AS mid FROM h1),
h3 AS (SELECT *, row_number() OVER (PARTITION BY trend_key, seconds, win ORDER BY lo) AS rn,
         count(*) OVER (PARTITION BY trend_key, seconds, win) AS n FROM h2),
hist AS (SELECT trend_key, seconds, interval_name, win, count(*) AS points,
         CAST((sum(mid) // count(*)) * {unit} AS BIGINT) AS mean, min(lo) * {unit} AS "min", {picks},
         CAST(floor(sqrt(CAST(count(*) * sum(CAST(mid AS HUGEINT) * mid) - sum(mid) * sum(mid) AS DOUBLE)
           / CAST(count(*) AS DOUBLE) / CAST(count(*) AS DOUBLE))) AS BIGINT) * {unit} AS std,
         max(lo) * {unit} AS "max"
       FROM h3 GROUP BY trend_key, seconds, interval_name, win)
"""


HIST_COLUMNS = 'points, mean, "min", p95, p99, std, p50, "max"'
HIST_OUT = f"SELECT trend_key, interval_name AS interval, win + seconds AS ts_sec, {HIST_COLUMNS} FROM hist"


def _counts(source: str, where: str = "true") -> str:
    return (
        "counts AS (SELECT trend_key, seconds, interval_name, win, count(*) AS points, "
        f"CAST(sum(CAST(trunc(value) AS BIGINT)) AS BIGINT) AS count FROM {source} "
        f"WHERE metric <> 'duration' AND {where} GROUP BY trend_key, seconds, interval_name, win)"
    )


def _long(extra: dict[str, str] | None = None) -> str:
    """Statistic rows out of ``hist`` and ``counts``; tag names sort as text."""
    stats = {"mean": "mean", "min": '"min"', "*_95": "p95", "*_99": "p99", "std": "std", "*_50": "p50", "max": '"max"'}
    parts = [
        f"SELECT trend_key, seconds, interval_name, win, '{stat}' AS stat, CAST({column} AS DOUBLE) AS value FROM hist"
        for stat, column in stats.items()
    ]
    parts.append(
        "SELECT trend_key, seconds, interval_name, win, 'count' AS stat, CAST(count AS DOUBLE) AS value FROM counts"
    )
    extra = extra or {}
    drop = " AND ".join([f"NOT starts_with(t, '{k}=')" for k in extra]) or "true"
    added = ", ".join([f"'{k}={v}'" for k, v in extra.items()])
    tags = f"""array_to_string(list_sort(list_concat(
      list_filter(string_split(trend_key, ',')[2:], lambda t: {drop}),
      ['interval=' || interval_name, 'stat=' || stat{', ' + added if added else ''}])), ',')"""
    key = "metric || ',' || tags" if extra else "trend_key"
    return f"""
r AS ({' UNION ALL '.join(parts)}),
t AS (SELECT *, string_split(trend_key, ',')[1] AS metric, {tags} AS tags FROM r)
SELECT {key} AS out_key, metric, tags, value, win + seconds AS ts_sec FROM t
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


DENIED = "(regexp_matches(service_name, '^svc\\.[01]$') OR regexp_matches(service_name, '7'))"
NAMED = "service_name <> '' AND operation_name <> ''"
E_OP = _points("espans", ("op",))
E_ALL = _points("espans")
L_ALL = _points("lspans")


def _encode(expression: str) -> str:
    return _with(EVENT_SPANS) + (
        f" SELECT event_id, {expression.format('service_name')} AS service, "
        f"{expression.format('operation_name')} AS operation FROM espans"
    )


POINT_OUT = " SELECT event_id, metric, tags, value, ts_sec FROM points"

ORACLES: dict[str, str] = {
    "valid_spans": _with(EVENT_SPANS) + f" SELECT event_id, service_name, operation_name FROM espans WHERE {NAMED}",
    "denied_spans": _with(EVENT_SPANS) + f" SELECT event_id, service_name, {DENIED} AS denied FROM espans WHERE {NAMED}",
    "allowed_spans": _with(EVENT_SPANS) + f" SELECT event_id, service_name FROM espans WHERE {NAMED} AND NOT {DENIED}",
    "span_status": _with(EVENT_SPANS) + " SELECT event_id, error FROM espans",
    "duration_points": _with(EVENT_SPANS, E_OP) + POINT_OUT + " WHERE metric = 'duration'",
    "status_points": _with(EVENT_SPANS, E_OP) + POINT_OUT + " WHERE metric <> 'duration'",
    "all_points": _with(EVENT_SPANS, E_ALL) + POINT_OUT,
    "encode_period": _encode("replace({}, '.', '___')"),
    "encode_base64": _encode("replace(to_base64(encode({})), '=', '_')"),
    "encode_noop": _encode("{}"),
    "trend_keys": _with(EVENT_SPANS, E_ALL) + " SELECT event_id, trend_key FROM points",
    "classify": """
WITH n AS (SELECT event_id, concat(CASE event_id % 8 WHEN 0 THEN 'Success-Span' WHEN 1 THEN 'failure-span'
    WHEN 2 THEN 'DURATION' WHEN 3 THEN 'p.latency' WHEN 4 THEN 'success-span-duration'
    WHEN 5 THEN 'latency-failure-span' WHEN 6 THEN 'received' ELSE 'duration' END, '.', event_type) AS metric
  FROM events)
SELECT event_id, metric, CASE WHEN event_id % 5 = 0 THEN NULL
  WHEN metric ILIKE '%success-span%' OR metric ILIKE '%failure-span%' THEN 'Count'
  WHEN metric ILIKE '%duration%' OR metric ILIKE '%latency%' THEN 'Histogram' END AS agg_type FROM n
""",
    "own_rule": """
WITH n AS (SELECT event_id, concat(CASE event_id % 8 WHEN 0 THEN 'Success-Span' WHEN 1 THEN 'failure-span'
    WHEN 2 THEN 'DURATION' WHEN 3 THEN 'p.latency' WHEN 4 THEN 'success-span-duration'
    WHEN 5 THEN 'latency-failure-span' WHEN 6 THEN 'received' ELSE 'duration' END, '.', event_type) AS metric
  FROM events)
SELECT event_id, metric, CASE
  WHEN event_id % 5 = 0 THEN CASE WHEN metric ILIKE '%received%' THEN 'Count' END
  WHEN metric ILIKE '%latency%' OR metric ILIKE '%success-span%' OR metric ILIKE '%failure-span%' THEN 'Count'
  WHEN metric ILIKE '%duration%' THEN 'Histogram' END AS agg_type FROM n
""",
    "own_transformer": _with(EVENT_SPANS)
    + f""" SELECT event_id, 'slow-latency' AS metric, 'mtype=gauge,operationName=' || replace(operation_name, '.', '___')
  || ',product=tracing,serviceName=' || replace(service_name, '.', '___') || ',slow=yes,unit=microseconds' AS tags,
  CAST(duration_us AS DOUBLE) * 2 AS value, start_us // 1000000 AS ts_sec
FROM espans WHERE {NAMED} AND duration_us > 5000000""",
    "own_aggregate": """
WITH p AS (SELECT concat('queue-depth.', event_type) AS metric, epoch_us(ts) // 1000000 AS t, user_id % 8 + 1 AS v FROM events),
f AS (SELECT metric, i.name, (t // i.s) * i.s + i.s AS ts_sec, v
  FROM p, (VALUES (60, 'OneMinute'), (300, 'FiveMinute'), (900, 'FifteenMinute'), (3600, 'OneHour')) i(s, name))
SELECT metric || ',mtype=level' AS out_key, metric, 'interval=' || name || ',mtype=level,stat=largest' AS tags,
  CAST(max(v) AS DOUBLE) AS value, ts_sec FROM f GROUP BY metric, name, ts_sec
""",
    "span_source": _with(EVENT_SPANS)
    + " SELECT service_name, operation_name, start_us AS start_time_us, duration_us, error, arrival FROM espans",
    "bad_messages": _with(EVENT_SPANS)
    + """ SELECT 'kept' AS part, service_name, count(*) AS messages FROM espans
WHERE event_id % 10 <> 0 AND event_id % 25 <> 1 GROUP BY service_name
UNION ALL SELECT 'broken', NULL, count(*) FROM espans WHERE event_id % 10 = 0 OR event_id % 25 = 1""",
    "valid_points": _with(EVENT_SPANS, E_OP)
    + """ SELECT event_id, metric, event_id % 17 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0 AND value > 0 AS valid
FROM points""",
    "window_assign": _with(EVENT_SPANS, E_OP)
    + """ SELECT event_id, ts_sec, i.name AS interval, (ts_sec // i.s) * i.s AS win_start, (ts_sec // i.s) * i.s + i.s AS win_end
FROM points, (VALUES (60, 'OneMinute'), (300, 'FiveMinute'), (900, 'FifteenMinute'), (3600, 'OneHour')) i(s, name)
WHERE metric = 'duration'""",
    "count_trends_multi": _with(EVENT_SPANS, E_ALL, _fan(), _counts("fan"))
    + " SELECT trend_key, interval_name AS interval, win + seconds AS ts_sec, count FROM counts",
    "service_rollup": _with(EVENT_SPANS)
    + f""", s AS (SELECT replace(service_name, '.', '___') AS service, replace(operation_name, '.', '___') AS operation,
    start_us // 60000000 * 60 AS win_start, error FROM espans WHERE {NAMED})
SELECT service, operation, win_start, count(*) FILTER (WHERE NOT error) AS successes,
  count(*) FILTER (WHERE error) AS failures FROM s GROUP BY ALL
UNION ALL
SELECT service, NULL, win_start, count(*) FILTER (WHERE NOT error), count(*) FILTER (WHERE error) FROM s
GROUP BY service, win_start""",
    "hist_buckets": _with(EVENT_SPANS)
    + """, v AS (SELECT event_id, least(duration_us, 1800000000) // 1000 AS recorded FROM espans),
w AS (SELECT *, greatest(0, length(bin(greatest(recorded, 1))) - 8) AS b FROM v)
SELECT event_id, recorded, (recorded >> b) << b AS low,
  ((recorded >> b) << b) + ((CAST(1 AS BIGINT) << b) >> 1) AS middle FROM w""",
    "duration_stats_1m": _with(LINE_SPANS, L_ALL, _fan((60,)), _hist("fan")) + HIST_OUT,
    "duration_stats_rollup": _with(LINE_SPANS, L_ALL, _fan(), _hist("fan")) + HIST_OUT,
    "duration_stats_ceil": _with(LINE_SPANS, L_ALL, _fan((60,)), _hist("fan", rank="ceil")) + HIST_OUT,
    "duration_stats_micros": _with(
        LINE_SPANS, L_ALL, _fan((3600,)), _hist("fan", unit=1, limit=50000000, bits=11)
    )
    + HIST_OUT,
    "point_cells": _with(LINE_SPANS, L_ALL)
    + """, p AS (SELECT trend_key, (ts_sec // 60) * 60 AS grain_start, CAST(trunc(value) AS BIGINT) AS amount, metric
    FROM points WHERE value > 0),
q AS (SELECT *, least(amount, 1800000000) // 1000 AS v FROM p),
b AS (SELECT *, greatest(0, length(bin(greatest(v, 1))) - 8) AS b FROM q)
SELECT trend_key, grain_start, CASE WHEN metric = 'duration' THEN (v >> b) << b ELSE -1 END AS bucket,
  count(*) AS n, CAST(sum(amount) AS BIGINT) AS total FROM b GROUP BY ALL""",
    "stats_long": _with(EVENT_SPANS, E_ALL, _fan(), _hist("fan"), _counts("fan")) + "," + _long(),
    "extra_tags": _with(EVENT_SPANS, E_ALL, _fan((60,)), _hist("fan"), _counts("fan"))
    + ","
    + _long({"k1": "v1", "product": "override"}),
    "point_trends": _with(
        EVENT_SPANS, E_ALL, _fan((900, 3600)), _hist("fan", "level = 'svc'"), _counts("fan", "level = 'svc'")
    )
    + ","
    + _long(),
    "strict_counts": _with(EVENT_SPANS, E_ALL, _fan(), FLOOR, _counts("judged", "accepted AND closed"))
    + " SELECT trend_key, interval_name AS interval, win + seconds AS ts_sec, points, count FROM counts",
    "strict_duration": _with(EVENT_SPANS, E_ALL, _fan(), FLOOR, _hist("judged", "accepted AND closed")) + HIST_OUT,
    "strict_dense": _with(LINE_SPANS, L_ALL, _fan(), FLOOR, _hist("judged", "accepted")) + HIST_OUT,
    "strict_points": _with(
        LINE_SPANS, _points("lspans", ("op",)), _fan((60, 300)), FLOOR, _hist("judged", "accepted AND closed")
    )
    + HIST_OUT,
    "strict_long": _with(
        EVENT_SPANS,
        E_ALL,
        _fan((300,)),
        FLOOR,
        _hist("judged", "accepted AND closed"),
        _counts("judged", "accepted AND closed"),
    )
    + ","
    + _long({"k1": "v1", "product": "override"}),
    "late_points": _with(LINE_SPANS, L_ALL, _fan(), FLOOR)
    + """ SELECT trend_key, interval_name AS interval, count(*) AS points, count(*) FILTER (WHERE accepted) AS accepted,
  count(*) FILTER (WHERE NOT accepted) AS late FROM judged GROUP BY ALL""",
    "closed_vs_all": _with(EVENT_SPANS, E_OP, _fan(), FLOOR)
    + """, w AS (SELECT DISTINCT trend_key, interval_name, win, closed FROM judged WHERE accepted AND metric = 'duration')
SELECT interval_name AS interval, count(*) AS windows, count(*) FILTER (WHERE closed) AS closed_windows
FROM w GROUP BY interval_name""",
    "quality_summary": _with(EVENT_SPANS)
    + f""", s AS (SELECT *, {NAMED} AS named, {NAMED} AND {DENIED} AS denied FROM espans)
SELECT count(*) AS spans, count(*) FILTER (WHERE NOT named) AS invalid_spans, count(*) FILTER (WHERE denied) AS denied_spans,
  count(*) FILTER (WHERE named AND NOT denied AND NOT error) AS success_spans,
  count(*) FILTER (WHERE named AND NOT denied AND error) AS failure_spans,
  count(*) FILTER (WHERE named AND NOT denied) AS duration_spans,
  2 * count(*) FILTER (WHERE named AND NOT denied AND duration_us <= 0) AS invalid_points FROM s""",
    "time_in_topic": _with(EVENT_SPANS, E_ALL)
    + """, d AS (SELECT trend_key, ts_sec * 1000 - arrival // 1000 AS ms FROM points WHERE value > 0),
k AS (SELECT *, row_number() OVER (PARTITION BY trend_key ORDER BY ms) AS rn, count(*) OVER (PARTITION BY trend_key) AS n FROM d)
SELECT trend_key, count(*) AS points, min(ms) AS min_ms,
  min(CASE WHEN rn >= (50 * n + 99) // 100 THEN ms END) AS p50_ms,
  min(CASE WHEN rn >= (95 * n + 99) // 100 THEN ms END) AS p95_ms,
  min(CASE WHEN rn >= (99 * n + 99) // 100 THEN ms END) AS p99_ms, max(ms) AS max_ms FROM k GROUP BY trend_key""",
    "active_trends": _with(EVENT_SPANS, E_ALL)
    + """ SELECT CASE WHEN metric = 'duration' THEN 'Histogram' ELSE 'Count' END AS agg_type,
  count(DISTINCT trend_key) AS trends FROM points WHERE value > 0 GROUP BY 1""",
    "keyed_sink": _with(LINE_SPANS, L_ALL)
    + " SELECT trend_key, count(*) AS points, CAST(1 AS BIGINT) AS buckets FROM points GROUP BY trend_key",
    "message_sink": _with(EVENT_SPANS, E_ALL, _fan((3600,)), _hist("fan"), _counts("fan")) + "," + _long(),
    "sink_fanout": "WITH long AS ("
    + _with(EVENT_SPANS, E_ALL, _fan((3600,)), _hist("fan"), _counts("fan"))
    + ","
    + _long()
    + """) SELECT sink, out_key, count(*) AS rows FROM long, (VALUES ('columns'), ('messages')) s(sink) GROUP BY ALL""",
    "optional_sink": "WITH long AS ("
    + _with(EVENT_SPANS, E_ALL, _fan(), _hist("fan"), _counts("fan"))
    + ","
    + _long()
    + ") SELECT 'columns' AS sink, count(*) AS rows, true AS ok FROM long UNION ALL SELECT 'broken', NULL, false",
    # A stream closes what ends before its newest event less the wait of the interval.
    "stream_counts": _with(EVENT_SPANS, E_ALL, _fan((60,)), _counts("fan"))
    + """, newest AS (SELECT max(ts_sec) AS t FROM points WHERE value > 0)
SELECT trend_key, interval_name AS interval, win + seconds AS ts_sec, count FROM counts, newest
WHERE win + seconds <= t - 60""",
    "stream_stats": _with(
        EVENT_SPANS,
        E_ALL,
        _fan((300,)),
        "newest AS (SELECT max(ts_sec) AS t FROM points WHERE value > 0)",
        "done AS (SELECT fan.* FROM fan, newest WHERE win + seconds <= t - 300)",
        _hist("done"),
        _counts("done"),
    )
    + ","
    + _long(),
    "stream_strict": _with(
        EVENT_SPANS,
        E_OP,
        _fan(),
        FLOOR,
        _hist("judged", "accepted AND closed"),
        _counts("judged", "accepted AND closed"),
    )
    + ","
    + _long(),
    "stored_trends": _with(EVENT_SPANS, E_ALL, _fan(), _hist("fan"), _counts("fan")) + "," + _long(),
    "packed_percentiles": _with(EVENT_SPANS, E_ALL, _fan(), _hist("fan", percents=(10, 50, 95, 99, 100)))
    + " SELECT trend_key, interval_name AS interval, win + seconds AS ts_sec, points, p10, p50, p95, p99, p100 FROM hist",
    "active_windows": _with(EVENT_SPANS, E_ALL, _fan())
    + """ SELECT CASE WHEN metric = 'duration' THEN 'Histogram' ELSE 'Count' END AS agg_type, interval_name AS interval,
  win + seconds AS ts_sec, count(DISTINCT trend_key) AS trends FROM fan GROUP BY ALL""",
    "stream_failures": _with(EVENT_SPANS, E_ALL)
    + """ SELECT 'rows' AS sink, false AS optional, CAST(4 AS BIGINT) AS batches, CAST(0 AS BIGINT) AS failures, count(*) AS rows FROM points
UNION ALL SELECT 'broken', true, 4, 4, NULL""",
    "stream_since": _with(EVENT_SPANS, E_ALL)
    + """, b AS (SELECT min(arrival) + (max(arrival) - min(arrival)) // 2 + 1 AS half FROM espans)
SELECT trend_key, value, ts_sec, arrival FROM points, b WHERE arrival >= half""",
    "own_keys": _with(EVENT_SPANS, E_ALL, _fan((900, 3600)), _hist("fan"), _counts("fan")) + "," + _long(),
    "stream_keyed": _with(
        EVENT_SPANS,
        E_ALL,
        _fan(),
        FLOOR,
        _hist("judged", "accepted AND closed"),
        _counts("judged", "accepted AND closed"),
    )
    + ","
    + _long(),
    "stream_restart": _with(
        EVENT_SPANS,
        E_OP,
        _fan(),
        FLOOR,
        _hist("judged", "accepted AND closed"),
        _counts("judged", "accepted AND closed"),
    )
    + ","
    + _long(),
    "stream_keyed_late": _with(EVENT_SPANS, E_ALL, _fan(), FLOOR)
    + """ SELECT trend_key, interval_name AS interval, count(*) AS late FROM judged WHERE NOT accepted GROUP BY ALL""",
    "stream_open": _with(EVENT_SPANS, E_ALL, _fan(), FLOOR)
    + """ SELECT trend_key, interval_name AS interval, win + seconds AS ts_sec, count(*) AS points,
  CAST(sum(CAST(trunc(value) AS BIGINT)) AS BIGINT) AS total FROM judged WHERE accepted AND NOT closed GROUP BY ALL""",
    # A minute closes a minute late; a longer window when a later minute has closed.
    "stream_rolled": _with(
        EVENT_SPANS,
        E_ALL,
        _fan(),
        "newest AS (SELECT max(ts_sec // 60 * 60) AS t FROM points)",
        "last AS (SELECT max(ts_sec // 60 * 60) AS c FROM points, newest WHERE ts_sec // 60 * 60 + 120 <= t)",
        "done AS (SELECT fan.* FROM fan, newest, last WHERE CASE WHEN seconds = 60 THEN win + 120 <= t ELSE win + seconds <= c END)",
        _hist("done"),
        _counts("done"),
    )
    + ","
    + _long(),
    "stream_span_app": _with(EVENT_SPANS, f"allowed AS (SELECT * FROM espans WHERE NOT {DENIED})", _points("allowed"))
    + " SELECT trend_key, metric, tags, value, ts_sec, arrival FROM points",
    # The watermark of a part is the newest valid point of the parts before it, less a minute.
    "stream_late": _with(EVENT_SPANS, E_ALL)
    + """, b AS (SELECT min(arrival) AS low, (max(arrival) - min(arrival)) // 4 + 1 AS width FROM espans),
p AS (SELECT points.*, (arrival - low) // width AS part, value > 0 AS valid FROM points, b),
m AS (SELECT part, max(ts_sec) AS newest FROM p WHERE valid GROUP BY part),
w AS (SELECT p.*, coalesce((SELECT max(newest) FROM m WHERE m.part < p.part), 0) - 60 AS mark,
  (SELECT max(newest) FROM m) - 60 AS last FROM p),
j AS (SELECT *, ts_sec // 60 * 60 + 60 AS ends FROM w WHERE valid)
SELECT 'points.points' AS measure, count(*) AS value FROM p
UNION ALL SELECT 'points.invalid_points', count(*) FILTER (NOT valid) FROM p
UNION ALL SELECT 'points.success_points', count(*) FILTER (metric = 'success-span') FROM p
UNION ALL SELECT 'points.failure_points', count(*) FILTER (metric = 'failure-span') FROM p
UNION ALL SELECT 'points.duration_points', count(*) FILTER (metric = 'duration') FROM p
UNION ALL SELECT 'late', count(*) FILTER (ends <= mark) FROM j
UNION ALL SELECT 'closed', count(*) FILTER (ends > mark AND ends <= last) FROM j
UNION ALL SELECT 'open', count(*) FILTER (ends > mark AND ends > last) FROM j""",
}
