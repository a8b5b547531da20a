"""Writing points: keyed storage, message form, and fan-out to several sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def to_messages(rows: DataFrame, key: str = "trend_key") -> DataFrame:
    """Rows as a message bus takes them: ``key`` and a JSON ``value``. The bus keeps a key in one partition."""
    body = F.struct(*[F.col(c) for c in rows.columns if c != key])
    return rows.select(F.col(key).alias("key"), F.to_json(body).alias("value"))


def write_points(points: DataFrame, path: str, buckets: int = 64, format: str = "parquet", mode: str = "append") -> None:
    """Points stored so that all points of a trend lie in one ``key_bucket`` folder; added to what is there.

    The rebalance hint brings a bucket together and lets Spark cut a bucket that a hot trend has made
    too large into several tasks and files of the same folder.
    """
    bucket = F.pmod(F.xxhash64("trend_key"), F.lit(buckets)).cast("int")
    keyed = points.withColumn("key_bucket", bucket)
    keyed.hint("rebalance", "key_bucket").write.mode(mode).format(format).partitionBy("key_bucket").save(path)


def start_point_stream(points: DataFrame, path: str, checkpoint: str, buckets: int = 64, format: str = "parquet") -> StreamingQuery:
    """The same for a stream. Each batch has a folder of its own, which a repeated batch overwrites."""

    def emit(batch: DataFrame, batch_id: int) -> None:
        write_points(batch, f"{path.rstrip('/')}/batch={batch_id}", buckets, format, mode="overwrite")

    return points.writeStream.foreachBatch(emit).option("checkpointLocation", checkpoint).start()


@dataclass(frozen=True)
class Sink:
    """One destination. ``as_messages`` writes key and JSON value instead of columns."""

    name: str
    format: str = "parquet"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    enabled: bool = True
    mode: str = "append"
    as_messages: bool = False
    partition_by: tuple[str, ...] = ()
    #: A batch goes on when an optional sink fails; the failure is in the results.
    optional: bool = False


def _flat(rows: DataFrame, sink: Sink) -> DataFrame:
    if sink.as_messages:
        return to_messages(rows, "out_key" if "out_key" in rows.columns else "trend_key")
    return rows


def write_one(rows: DataFrame, sink: Sink) -> int:
    """Writes to one sink and returns the number of rows, counted while they are written."""
    seen = Observation(f"sink_{sink.name}")
    counted = _flat(rows, sink).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.format(sink.format).mode(sink.mode).options(**sink.options)
    if sink.partition_by:
        writer = writer.partitionBy(*sink.partition_by)
    if sink.path is None:
        writer.save()
    else:
        writer.save(sink.path)
    return int(seen.get["rows"])


def write_fanout(rows: DataFrame, sinks: Sequence[Sink], keep: bool = True) -> list[dict]:
    """Writes the rows to every enabled sink; a sink that fails is reported and does not stop the others.

    The rows are computed once and kept on the executors while there is more than one sink to serve;
    a lost executor only means that its part is computed again. Without ``keep`` each sink computes them: for rows of a table.
    """
    wanted = [s for s in sinks if s.enabled]
    kept = keep and len(wanted) > 1
    shared = rows.persist() if kept else rows
    results = []
    try:
        for sink in wanted:
            try:
                results.append({"sink": sink.name, "rows": write_one(shared, sink), "ok": True, "error": None, "optional": sink.optional})
            except Exception as failure:  # noqa: BLE001 - reported to the caller per sink
                results.append({"sink": sink.name, "rows": None, "ok": False, "error": str(failure), "optional": sink.optional})
    finally:
        if kept:
            shared.unpersist()
    return results


REPORT = "batch_id long, label string, sink string, rows long, ok boolean, optional boolean, error string"


def batch_sinks(sinks: Sequence[Sink], batch_id: int, label: str = "") -> list[Sink]:
    """File sinks pointed at a folder of this batch, so that writing a batch again replaces it."""
    return [s if s.path is None else replace(s, path=f"{s.path}/{label}batch_id={batch_id}", mode="overwrite") for s in sinks]


def serve_batch(rows: DataFrame, sinks: Sequence[Sink], batch_id: int, label: str = "", report: str | None = None, keep: bool = True) -> None:
    """Writes one batch of a stream to its sinks, and what became of each sink to the table ``report``.

    The report of a batch replaces that of an earlier try, and is written before a sink that is not optional stops the query.
    """
    results = write_fanout(rows, batch_sinks(sinks, batch_id, label), keep)
    if report is not None:
        said = [(batch_id, label, r["sink"], r["rows"], r["ok"], r["optional"], (r["error"] or "")[:2000] or None) for r in results]
        written = rows.sparkSession.createDataFrame(said, REPORT).coalesce(1)
        written.write.mode("overwrite").parquet(f"{report}/{label}report_of={batch_id}")
    require_all(results)


def read_report(spark: SparkSession, report: str) -> DataFrame:
    """What became of every sink in every batch, as rows of REPORT."""
    return spark.read.schema(REPORT).option("recursiveFileLookup", "true").parquet(report)


class FanoutError(RuntimeError):
    """At least one sink that is not optional failed; raised where a batch must be tried again."""


def require_all(results: Sequence[dict]) -> None:
    failed = [r for r in results if not r["ok"] and not r.get("optional")]
    if failed:
        raise FanoutError("; ".join(f"{r['sink']}: {r['error']}" for r in failed))
