"""Whole batch jobs: spans or points in, trends out."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from trendloom.operators.cells import Tally, grain_cells, point_cells, roll_up, tally_points, tally_spans
from trendloom.operators.dictionary import described_stats, dictionary_of_points, dictionary_of_spans, with_trend_id
from trendloom.operators.enrich import add_tags
from trendloom.operators.filters import valid_spans
from trendloom.operators.lateness import accepted_cells
from trendloom.operators.points import DEFAULT_TRANSFORMERS, typed_points
from trendloom.operators.rules import with_trend_key
from trendloom.operators.stats import stat_rows, window_stats
from trendloom.options import TrendOptions


def trends_from_cells(cells: DataFrame, opts: TrendOptions, trends: DataFrame | None = None) -> DataFrame:
    """Statistics rows with the constant tags added. ``trends`` describes the trends, see ``operators.dictionary``."""
    wide = window_stats(cells, opts)
    return add_tags(stat_rows(wide, opts) if trends is None else described_stats(wide, trends, opts), opts.extra_tags)


def point_trends(points: DataFrame, opts: TrendOptions | None = None) -> DataFrame:
    """Trends of every point, whatever its delay. A key of a point's own is kept apart from its metric and tags."""
    opts = opts or TrendOptions()
    keyed = with_trend_key(points)
    cells = roll_up(point_cells(with_trend_id(keyed), opts), opts.intervals)
    return trends_from_cells(cells, opts, dictionary_of_points(keyed))


def tally_of_spans(spans: DataFrame, opts: TrendOptions) -> Tally:
    """Valid spans, ready to count; other transformers than the standard ones go by way of their points."""
    kept = valid_spans(spans, opts.deny)
    if tuple(opts.transformers) == DEFAULT_TRANSFORMERS:
        return tally_spans(kept, opts)
    return tally_points(typed_points(kept, opts), opts)


def described_tally(spans: DataFrame, opts: TrendOptions) -> tuple[Tally, DataFrame]:
    """The same with ids of trends for keys, and the dictionary of the ids."""
    kept = valid_spans(spans, opts.deny)
    if tuple(opts.transformers) != DEFAULT_TRANSFORMERS:
        points = typed_points(kept, opts)
        return tally_points(with_trend_id(points), opts), dictionary_of_points(points)
    tally = tally_spans(kept, opts)
    return replace(tally, spread=lambda groups: with_trend_id(tally.spread(groups))), dictionary_of_spans(kept, opts)


def span_trends(spans: DataFrame, opts: TrendOptions | None = None) -> DataFrame:
    """Trends of every valid span, whatever its delay."""
    opts = opts or TrendOptions()
    tally, trends = described_tally(spans, opts)
    return trends_from_cells(roll_up(grain_cells(tally), opts.intervals), opts, trends)


def strict_point_trends(points: DataFrame, opts: TrendOptions | None = None) -> DataFrame:
    """Trends of the points the strict lateness rule accepts; ``points`` need ``arrival``."""
    opts = opts or TrendOptions(emit="closed")
    keyed = with_trend_key(points)
    return trends_from_cells(accepted_cells(tally_points(with_trend_id(keyed), opts), opts), opts, dictionary_of_points(keyed))


def strict_span_trends(spans: DataFrame, opts: TrendOptions | None = None) -> DataFrame:
    """Trends of the spans the strict lateness rule accepts; ``spans`` need ``arrival``."""
    opts = opts or TrendOptions(emit="closed")
    tally, trends = described_tally(spans, opts)
    return trends_from_cells(accepted_cells(tally, opts), opts, trends)
