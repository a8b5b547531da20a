"""Row filters: which spans make points, and which points are aggregated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.functions.spans import has_names, is_denied


def valid_spans(spans: DataFrame, deny: Sequence[str] = ()) -> DataFrame:
    """Spans with both names whose service no deny pattern finds."""
    kept = spans.where(has_names())
    return kept.where(~is_denied(deny)) if deny else kept


def is_valid_point(key: str = "trend_key", value: str = "value") -> Column:
    """A key and a value above zero; not-a-number is not above zero."""
    v = F.col(value)
    return F.coalesce(F.col(key).isNotNull() & ~F.isnan(v) & (v > 0), F.lit(False))


def valid_points(points: DataFrame) -> DataFrame:
    return points.where(is_valid_point())
