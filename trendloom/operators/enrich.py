"""Constant tags on aggregated points."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.functions.keys import trend_key


def add_tags(rows: DataFrame, extra: Mapping[str, str]) -> DataFrame:
    """Adds constant tags, which win over tags of the same name, and renews ``out_key``.

    Without extra tags rows pass unchanged, so all statistics of a trend share the key of the trend;
    with them every row is keyed by its own metric and tags.
    """
    if not extra:
        return rows
    names = [F.lit(name) for name in extra]
    constant = F.create_map(*[F.lit(part) for pair in extra.items() for part in pair])
    merged = F.map_concat(F.map_filter(F.col("tags"), lambda k, _: ~k.isin(*names)), constant)
    tagged = rows.withColumn("tags", merged)
    return tagged.withColumn("out_key", trend_key(F.col("metric"), F.col("tags")))
