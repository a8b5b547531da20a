"""Distinct trends per window by bitmaps that merge over windows, exactly.

Trends get dense numbers, so that a bitmap of a stretch of numbers is small; a minute's bitmaps are kept, and those of any
longer window or set of windows are the union of theirs. Nothing is counted from the points again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendloom.operators.cells import SERIES, window_start

#: Stretches of hashed keys in which trends are numbered; what one task orders is their share of the trends.
STRETCHES = 4096


def numbered_trends(trends: DataFrame, stretches: int = STRETCHES) -> DataFrame:
    """Distinct ``trend_key, agg_type`` with ``number``, from 0 without gaps, the same for the same trends.

    Trends are numbered inside stretches of their hash; only the sizes of the stretches are summed in one task.
    """
    keyed = trends.select(*SERIES).distinct().withColumn("stretch", F.pmod(F.xxhash64(*SERIES), F.lit(stretches)).cast("int"))
    sizes = keyed.groupBy("stretch").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = F.row_number().over(Window.partitionBy("stretch").orderBy(*SERIES)) - 1
    return keyed.withColumn("own", own).join(starts, "stretch").select(*SERIES, (F.col("first") + F.col("own")).alias("number"))


def trend_bitmaps(cells: DataFrame, numbers: DataFrame) -> DataFrame:
    """``agg_type, seconds, win_start, part, bits``: the trends of each window as bitmaps of 32,768 numbers each.

    ``cells`` need the series, ``seconds`` and ``win_start``; several cells of a trend count once.
    """
    seen = cells.select(*SERIES, "seconds", "win_start").distinct().join(numbers, list(SERIES))
    at = F.col("number") + 1  # the functions number bits from 1
    return seen.groupBy("agg_type", "seconds", "win_start", F.bitmap_bucket_number(at).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )


def merged_bitmaps(bitmaps: DataFrame, seconds: Sequence[int]) -> DataFrame:
    """Bitmaps of longer windows as unions of those that nest in them."""
    fanned = bitmaps.withColumnRenamed("seconds", "own").withColumnRenamed("win_start", "at")
    fanned = fanned.withColumn("seconds", F.explode(F.array(*[F.lit(s).cast("bigint") for s in seconds])))
    nested = fanned.where(F.col("seconds") % F.col("own") == 0).withColumn("win_start", window_start(F.col("at"), F.col("seconds")))
    return nested.groupBy("agg_type", "seconds", "win_start", "part").agg(F.bitmap_or_agg("bits").alias("bits"))


def active_in_windows(bitmaps: DataFrame) -> DataFrame:
    """Number of trends per aggregate and window."""
    return bitmaps.groupBy("agg_type", "seconds", "win_start").agg(F.sum(F.bitmap_count("bits")).alias("trends"))
