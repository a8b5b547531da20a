"""The span app as one streaming job: spans in, deny list, points, keyed storage or any other sinks out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from trendloom.operators.filters import valid_spans
from trendloom.operators.points import to_points
from trendloom.operators.quality import observe_points
from trendloom.options import TrendOptions
from trendloom.sources.sinks import Sink, serve_batch, write_points


def points_of_spans(spans: DataFrame, opts: TrendOptions | None = None) -> DataFrame:
    """Points of the spans that have names and that no deny pattern finds; a stream or a table."""
    opts = opts or TrendOptions()
    return to_points(valid_spans(spans, opts.deny), opts)


def start_span_app(
    spans: DataFrame,
    path: str,
    checkpoint: str,
    opts: TrendOptions | None = None,
    buckets: int = 64,
    sinks: Sequence[Sink] = (),
    trigger: dict | None = None,
    report: str | None = None,
) -> StreamingQuery:
    """Points of a stream of spans, stored by trend under ``path`` as ``write_points`` does, and sent to further ``sinks``.

    Each batch has a folder of its own, which a repeated batch replaces, and further sinks get the rows that were stored there:
    a batch is computed once, and none of it is kept in memory. Counts of points by kind go to query listeners under
    the name ``points``, see ``streaming.measures``.
    """
    points = observe_points(points_of_spans(spans, opts), "points")

    def emit(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path.rstrip('/')}/batch={batch_id}"
        write_points(batch, folder, buckets, mode="overwrite")
        if sinks:
            stored = batch.sparkSession.read.schema(batch.schema).parquet(folder).select(*batch.columns)
            serve_batch(stored, sinks, batch_id, report=report, keep=False)

    return (
        points.writeStream.foreachBatch(emit)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
