"""Trends of a stream under the strict lateness rule.

Each batch is judged by the batch operators, starting from the cells of the windows that earlier batches
left open. Those cells are a small table beside the checkpoint: per trend and interval at most
``extra_windows + 1`` windows of bucket counts. Points of one trend are pre-aggregated wherever they
are read, so a trend with a large share of a batch does not end up in one task.

Two slots take turns: a batch reads the slot of the batch before and overwrites the other, so repeating a
batch after a failure starts from the same state and gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trendloom.operators.cells import tally_points
from trendloom.operators.lateness import judged_cells
from trendloom.operators.rules import with_describing_key
from trendloom.options import TrendOptions
from trendloom.plans.trends import trends_from_cells
from trendloom.schema import CELL_SCHEMA
from trendloom.sources.sinks import Sink, serve_batch

SLOT_SCHEMA = T.StructType(
    [*CELL_SCHEMA.fields, T.StructField("batch_id", T.LongType()), T.StructField("closed", T.BooleanType())]
)


def _slot(checkpoint: str, batch_id: int) -> str:
    return f"{checkpoint}/open_windows/slot={batch_id % 2}"


def _read_slot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SLOT_SCHEMA).parquet(path)


def judge_batch(batch: DataFrame, batch_id: int, checkpoint: str, opts: TrendOptions) -> DataFrame:
    """Judges one batch, stores the accepted cells in its slot and returns those of windows now closed."""
    spark = batch.sparkSession
    carried = None
    if batch_id > 0:
        carried = _read_slot(spark, _slot(checkpoint, batch_id - 1)).where(~F.col("closed"))
    accepted = judged_cells(tally_points(with_describing_key(batch), opts), opts, carried).where("accepted")
    slot = _slot(checkpoint, batch_id)
    stamped = accepted.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    stamped.select(*[f.name for f in SLOT_SCHEMA.fields]).write.mode("overwrite").partitionBy("closed").parquet(slot)
    return _read_slot(spark, slot).where("closed")


def run_strict_trends(
    points: DataFrame,
    checkpoint: str,
    sinks: Sequence[Sink],
    opts: TrendOptions | None = None,
    trigger: dict | None = None,
    report: str | None = None,
) -> StreamingQuery:
    """One query for all intervals. Later batches must hold later arrivals, as offsets of a bus do."""
    opts = opts or TrendOptions(emit="closed")

    def emit(batch: DataFrame, batch_id: int) -> None:
        closed = judge_batch(batch, batch_id, checkpoint, opts)
        rows = trends_from_cells(closed.drop("batch_id", "closed"), opts)
        serve_batch(rows, sinks, batch_id, report=report)

    return (
        points.writeStream.foreachBatch(emit)
        .option("checkpointLocation", f"{checkpoint}/query")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows a strict query has open, as of its last batch."""
    both = _read_slot(spark, f"{checkpoint}/open_windows").drop("slot")
    newest = both.agg(F.max("batch_id").alias("batch_id"))
    return both.join(F.broadcast(newest), "batch_id").where(~F.col("closed")).drop("batch_id", "closed")
