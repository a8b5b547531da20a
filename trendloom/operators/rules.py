"""Rules that decide how a metric is aggregated."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom import schema as S
from trendloom.functions.keys import describing_key, trend_key


@dataclass(frozen=True)
class Rule:
    """Points of type ``mtype`` whose metric name contains ``contains``, both ignoring case."""

    contains: str
    agg_type: str
    mtype: str = S.MTYPE_GAUGE


# The rules in order of precedence, first match wins.
DEFAULT_RULES = (
    Rule("success-span", S.AGG_COUNT),
    Rule("failure-span", S.AGG_COUNT),
    Rule("duration", S.AGG_HISTOGRAM),
    Rule("latency", S.AGG_HISTOGRAM),
)


def has_tag(tags: Column, name: str, value: str) -> Column:
    """The tag is there and equals the value, ignoring case."""
    return F.coalesce(F.lower(F.try_element_at(tags, F.lit(name))) == value.lower(), F.lit(False))


def agg_type_of(metric: Column, mtype: Column, rules: Sequence[Rule] = DEFAULT_RULES) -> Column:
    """Aggregation of a metric, null when no rule matches."""
    none = F.lit(None).cast("string")
    types = {rule.mtype.lower() for rule in rules}
    if len(types) == 1:
        # One type for all rules is looked up once.
        named = _first_match([(F.lower(metric).contains(r.contains.lower()), r.agg_type) for r in rules])
        return F.when(F.lower(mtype) == types.pop(), named).otherwise(none)
    matches = [
        (F.lower(metric).contains(r.contains.lower()) & (F.lower(mtype) == r.mtype.lower()), r.agg_type) for r in rules
    ]
    return _first_match(matches) if matches else none


def _first_match(matches: Sequence[tuple[Column, str]]) -> Column:
    chosen = F
    for condition, agg_type in matches:
        chosen = chosen.when(condition, F.lit(agg_type))
    return chosen.otherwise(F.lit(None).cast("string"))


def classify(points: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Adds ``agg_type``; points without a rule keep a null and are left out by the aggregation."""
    return points.withColumn(
        "agg_type", agg_type_of(F.col("metric"), F.try_element_at(F.col("tags"), F.lit(S.TAG_MTYPE)), rules)
    )


def with_trend_key(points: DataFrame) -> DataFrame:
    """Adds ``trend_key`` to points that came without one, be it the column or its value."""
    derived = trend_key(F.col("metric"), F.col("tags"))
    return points.withColumn("trend_key", F.coalesce("trend_key", derived) if "trend_key" in points.columns else derived)


def with_describing_key(points: DataFrame) -> DataFrame:
    """The same, with keys of their own followed by what describes the trend; for streams."""
    keyed = with_trend_key(points)
    return keyed.withColumn("trend_key", describing_key(F.col("trend_key"), F.col("metric"), F.col("tags")))
