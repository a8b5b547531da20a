"""What running streams dropped and saw, as rows: one row per batch and measure."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

MEASURES = "query_id string, run_id string, query string, batch_id long, measure string, value long"
DROPPED = "dropped_by_watermark"


def measures_of(progress: dict) -> Iterator[tuple]:
    """Rows of MEASURES from one progress report: input rows, observed counts, and rows that operators dropped as late.

    An aggregation combines rows before it looks at their time, so what it dropped counts combined rows.
    """
    place = (progress["id"], progress["runId"], progress.get("name"), progress["batchId"])
    yield (*place, "input_rows", int(progress.get("numInputRows") or 0))
    dropped = sum(int(o.get("numRowsDroppedByWatermark") or 0) for o in progress.get("stateOperators") or [])
    yield (*place, DROPPED, dropped)
    for name, counts in (progress.get("observedMetrics") or {}).items():
        for measure, value in counts.items():
            if isinstance(value, int):
                yield (*place, f"{name}.{measure}", value)


def measures_of_query(query: StreamingQuery) -> DataFrame:
    """The measures of the reports a query still holds, the last hundred by default."""
    reports = [json.loads(p.json) for p in query.recentProgress]
    return SparkSession.active().createDataFrame([row for p in reports for row in measures_of(p)], MEASURES)


class MeasureLog(StreamingQueryListener):
    """Appends the measures of every batch of every query to a table. A batch run again has two rows, told apart by run.

    Add it by ``spark.streams.addListener``. A report is a few rows, so the table wants compacting at times.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        rows = list(measures_of(json.loads(event.progress.json)))
        self.spark.createDataFrame(rows, MEASURES).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_measures(spark: SparkSession, path: str) -> DataFrame:
    """Measures summed over batches, each batch by its last run that got so far."""
    rows = spark.read.schema(MEASURES).parquet(path)
    once = rows.groupBy("query_id", "query", "batch_id", "measure").agg(F.max("value").alias("value"))
    return once.groupBy("query_id", "query", "measure").agg(F.sum("value").alias("value"), F.max("batch_id").alias("last_batch"))


def balance(arrived: DataFrame, closed: DataFrame, still_open: DataFrame, by: str = "agg_type") -> DataFrame:
    """Points that arrived, are in closed windows, in open ones, and are in neither because they came too late.

    ``arrived`` has one row per valid point or a count ``n``, the others cells with ``n``. This is exact where a stream's own
    count of dropped rows counts rows that were combined before.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        n = F.sum("n") if "n" in df.columns else F.count(F.lit(1))
        return df.groupBy(by).agg(n.alias(name))

    joined = counted(arrived, "points").join(counted(closed, "closed"), by, "left").join(counted(still_open, "open"), by, "left")
    filled = joined.fillna(0, ["closed", "open"])
    return filled.withColumn("late", F.col("points") - F.col("closed") - F.col("open"))
