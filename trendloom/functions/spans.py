"""Predicates over span columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.schema import SPAN_ERROR_TAG


def has_names(service: str = "service_name", operation: str = "operation_name") -> Column:
    """Both names are present; a null counts as empty."""
    return (F.coalesce(F.col(service), F.lit("")) != "") & (F.coalesce(F.col(operation), F.lit("")) != "")


def is_denied(patterns: Sequence[str], service: str = "service_name") -> Column:
    """Any pattern occurs anywhere in the service name as it was sent, before encoding."""
    found = [F.col(service).rlike(p) for p in patterns]
    return F.coalesce(reduce(lambda a, b: a | b, found, F.lit(False)), F.lit(False))


def is_error(tags: str = "tags") -> Column:
    """The first ``error`` tag decides: a boolean by its value, a text unless it reads false, else true."""
    named = F.filter(F.col(tags), lambda t: F.lower(t["key"]) == SPAN_ERROR_TAG)
    return F.coalesce(F.get(F.transform(named, _says_error), F.lit(0)), F.lit(False))


def _says_error(tag: Column) -> Column:
    kind = F.upper(F.coalesce(tag["type"], F.lit("STRING")))
    return (
        F.when(kind == "BOOL", F.coalesce(tag["v_bool"], F.lit(False)))
        .when(kind == "STRING", F.lower(F.coalesce(tag["v_str"], F.lit(""))) != "false")
        .otherwise(F.lit(True))
    )


def point_seconds(start_us: str = "start_time_us") -> Column:
    """Microseconds to whole seconds; an unset time is 0."""
    start = F.coalesce(F.col(start_us), F.lit(0).cast("bigint"))
    return F.call_function("div", start, F.lit(1_000_000).cast("bigint"))
