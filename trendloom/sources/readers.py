"""Reading spans and points, from files or a message bus, as tables or streams."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.functions.keys import trend_key
from trendloom.schema import POINT_SCHEMA, SPAN_SCHEMA

START_POSITIONS = ("latest", "earliest")
FILE_FORMATS = ("parquet", "orc", "json")
BROKEN = "_broken"
#: Offsets that are told apart within a millisecond.
OFFSETS = 1 << 20


def start_position(start: str | datetime) -> str | datetime:
    """``latest``, ``earliest``, or a moment; a moment without a zone is in UTC."""
    if isinstance(start, datetime):
        return start if start.tzinfo else start.replace(tzinfo=timezone.utc)
    lowered = start.lower()
    if lowered in START_POSITIONS:
        return lowered
    try:
        return start_position(datetime.fromisoformat(start))
    except ValueError:
        raise ValueError(f"start must be one of {START_POSITIONS} or a moment in ISO form, got {start!r}") from None


def _since(reader: DataFrameReader, path: str, moment: datetime, schema: T.StructType) -> DataFrame:
    """Rows of files that were written at or after the moment."""
    since = F.timestamp_micros(F.lit(round(moment.timestamp() * 1_000_000)))
    rows = reader.load(path)
    return rows.where(F.col("_metadata.file_modification_time") >= since).select(*schema.names)


def _read(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format: str,
    streaming: bool,
    start: str | datetime | None,
    options: Mapping[str, str] | None,
) -> DataFrame:
    start = start_position(start or ("latest" if format == "kafka" else "earliest"))
    reader = spark.readStream if streaming else spark.read
    if format == "kafka":
        # A table has no latest point to start from, so a batch read always covers the whole topic.
        offsets = start if streaming else "earliest"
        raw = reader.format("kafka").option("subscribe", path)
        if isinstance(start, datetime):
            raw = raw.option("startingTimestamp", str(int(start.timestamp() * 1000)))
        else:
            raw = raw.option("startingOffsets", offsets)
        raw = raw.options(**(options or {})).load()
        return decode_messages(raw, schema)
    if format not in FILE_FORMATS:
        raise ValueError(f"unknown source format {format!r}, use kafka or one of {FILE_FORMATS}")
    if streaming and start == "latest":
        raise ValueError("files have no latest position: a stream reads all of them, the oldest first")
    reader = reader.format(format).schema(schema).options(**(options or {}))
    return _since(reader, path, start, schema) if isinstance(start, datetime) else reader.load(path)


def _parsed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds ``body``, and ``broken``: the text of a body that is missing or does not fit the schema."""
    text = F.col("value").cast("string")
    kept = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    rows = raw.withColumn("body", F.from_json(text, kept, options))
    broken = F.when(F.col("body").isNull(), F.coalesce(text, F.lit(""))).otherwise(F.col(f"body.{BROKEN}"))
    return rows.withColumn("broken", broken)


def decode_messages(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of a message bus (``value`` as JSON) to columns; a body that does not parse is left out.

    ``arrival``, where the body has none, orders messages. Points lie in the partition of their trend, so their
    offset does. Spans of a service lie in many partitions, so they go by the time of the message, then the offset.
    :func:`broken_messages` has what is left out.
    """
    rows = _parsed(raw, schema).where(F.col("broken").isNull())
    columns = [F.col(f"body.{f.name}") for f in schema.fields if f.name != "arrival"]
    arrival = F.col("body.arrival")
    if "offset" in raw.columns:
        order = F.col("offset").cast("bigint")
        if "trend_key" not in schema.names and "timestamp" in raw.columns:
            order = F.unix_millis("timestamp") * OFFSETS + F.pmod(order, F.lit(OFFSETS))
        arrival = F.coalesce(arrival, order)
    return rows.select(*columns, arrival.alias("arrival"))


def broken_messages(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The messages that :func:`decode_messages` leaves out, with their text in ``broken``; count them to watch a source."""
    return _parsed(raw, schema).where(F.col("broken").isNotNull()).drop("body")


def read_spans(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    streaming: bool = False,
    start: str | datetime | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Spans from a folder of files, or from the topic ``path`` when ``format`` is kafka.

    ``start`` says where a stream of a bus begins, by default at the latest offset. A stream of files reads all of them, the
    oldest first, so that no file's event time makes another file's points late. A moment, as a datetime or in ISO form,
    leaves out what was written before it; a restarted stream must be given the same moment, so there is no ``latest`` for files.
    """
    return _read(spark, path, SPAN_SCHEMA, format, streaming, start, options)


def read_points(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    streaming: bool = False,
    start: str | datetime | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Metric points, such as :func:`trendloom.sources.sinks.write_points` wrote; a missing key is derived."""
    points = _read(spark, path, POINT_SCHEMA, format, streaming, start, options)
    key = F.coalesce(F.col("trend_key"), trend_key(F.col("metric"), F.col("tags")))
    return points.withColumn("trend_key", key)


def with_event_time(df: DataFrame, clock: str = "event") -> DataFrame:
    """Adds ``event_ts``: the span start or point timestamp, or the wall clock when asked for."""
    if clock == "wallclock":
        return df.withColumn("event_ts", F.current_timestamp())
    if clock != "event":
        raise ValueError(f"clock must be 'event' or 'wallclock', got {clock!r}")
    if "start_time_us" in df.columns:
        return df.withColumn("event_ts", F.timestamp_micros("start_time_us"))
    return df.withColumn("event_ts", F.timestamp_seconds("ts_sec"))
