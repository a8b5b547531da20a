"""Spans to metric points.

A transformer is a function returning a :class:`PointSpec`, a description of one point in column
expressions. ``to_points`` turns all of them into one narrow generator, without a shuffle or a UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom import schema as S
from trendloom.functions.encoding import encode_name
from trendloom.functions.keys import known_tags_key
from trendloom.functions.spans import is_error, point_seconds
from trendloom.operators.rules import agg_type_of
from trendloom.options import TrendOptions


@dataclass(frozen=True)
class PointSpec:
    """One point per span: ``metric`` and ``value`` are columns over the span row.

    ``when`` (optional) limits the spans that make the point, ``tags`` adds tags of its own.
    """

    metric: Column
    value: Column
    unit: str
    mtype: str = S.MTYPE_GAUGE
    tags: Mapping[str, Column] = field(default_factory=dict)
    when: Column | None = None


def duration_point() -> PointSpec:
    return PointSpec(F.lit(S.METRIC_DURATION), F.col("duration_us").cast("double"), S.UNIT_MICROSECONDS)


def status_point() -> PointSpec:
    name = F.when(is_error(), F.lit(S.METRIC_FAILURE)).otherwise(F.lit(S.METRIC_SUCCESS))
    return PointSpec(name, F.lit(1.0), S.UNIT_SHORT)


DEFAULT_TRANSFORMERS: tuple[Callable[[], PointSpec], ...] = (duration_point, status_point)


def point_tags(
    opts: TrendOptions, unit: str, mtype: str, service: Column, operation: Column | None, own: Mapping[str, Column]
) -> dict[str, Column | str]:
    """Tags of a point; later groups win on a clash, service-level points have no operation."""
    tags: dict[str, Column | str] = {S.TAG_SERVICE: service}
    if operation is not None:
        tags[S.TAG_OPERATION] = operation
    tags.update(own)
    tags.update({S.TAG_MTYPE: mtype, S.TAG_UNIT: unit, S.TAG_PRODUCT: opts.product})
    return tags


def tag_map(tags: Mapping[str, Column | str]) -> Column:
    pairs = []
    for name, value in tags.items():
        pairs += [F.lit(name), F.lit(value) if isinstance(value, str) else value]
    return F.create_map(*pairs)


def _pick(choices: Sequence[Column]) -> Column:
    picked = F
    for i, choice in enumerate(choices[:-1]):
        picked = picked.when(F.col("variant") == i, choice)
    return choices[-1] if picked is F else picked.otherwise(choices[-1])


def typed_points(spans: DataFrame, opts: TrendOptions | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Points with ``agg_type``, the rule of their metric, decided before the rows are multiplied."""
    opts = opts or TrendOptions()
    carried = list(keep) + [c for c in ("arrival",) if c in spans.columns and c not in keep]
    specs = [make() for make in opts.transformers]
    levels = (True, False) if opts.service_level else (True,)
    service = encode_name(F.coalesce(F.col("service_name"), F.lit("")), opts.encoder)
    operation = encode_name(F.coalesce(F.col("operation_name"), F.lit("")), opts.encoder)
    base = [
        service.alias("svc"),
        operation.alias("opn"),
        point_seconds().alias("ts_sec"),
        *[F.col(c) for c in carried],
    ]
    for i, spec in enumerate(specs):
        agg_type = agg_type_of(spec.metric, F.lit(spec.mtype), opts.rules)
        base += [
            spec.metric.alias(f"metric_{i}"),
            spec.value.cast("double").alias(f"value_{i}"),
            agg_type.alias(f"agg_type_{i}"),
        ]
        base += [tag.alias(f"tag_{i}_{j}") for j, tag in enumerate(spec.tags.values())]
        if spec.when is not None:
            base.append(F.coalesce(spec.when, F.lit(False)).alias(f"when_{i}"))

    metrics, values, types, keys, tags, wanted = [], [], [], [], [], []
    for i, spec in enumerate(specs):
        own = {name: F.col(f"tag_{i}_{j}") for j, name in enumerate(spec.tags)}
        for with_operation in levels:
            named = point_tags(opts, spec.unit, spec.mtype, F.col("svc"), F.col("opn") if with_operation else None, own)
            metrics.append(F.col(f"metric_{i}"))
            values.append(F.col(f"value_{i}"))
            types.append(F.col(f"agg_type_{i}"))
            keys.append(known_tags_key(F.col(f"metric_{i}"), named))
            tags.append(tag_map(named))
            wanted.append(F.lit(True) if spec.when is None else F.col(f"when_{i}"))

    rows = spans.select(*base).withColumn("variant", F.explode(F.array(*[F.lit(i) for i in range(len(keys))])))
    if any(spec.when is not None for spec in specs):
        rows = rows.where(_pick(wanted))
    return rows.select(
        _pick(metrics).alias("metric"),
        _pick(tags).alias("tags"),
        _pick(values).alias("value"),
        "ts_sec",
        _pick(keys).alias("trend_key"),
        *carried,
        _pick(types).alias("agg_type"),
    )


def to_points(spans: DataFrame, opts: TrendOptions | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """All points of the given (already valid) spans, in the columns of POINT_SCHEMA.

    Each transformer makes one point per span and, with ``service_level``, a second one without the
    operation tag. Columns named in ``keep``, and ``arrival`` when the spans have it, are passed through.
    What depends on the span alone is computed once, before the rows are multiplied.
    """
    return typed_points(spans, opts, keep).drop("agg_type")
