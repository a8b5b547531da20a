"""Session settings, and the shared folder a job may write to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM leaves methods beyond this size to its interpreter; Spark then splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session in this process, for tests and measurements."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("trendloom")
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


#: Bytes of shuffled cells that one task gets at most. They take up to 56 times as much as rows in memory, as measured.
TASK_MB = 16


def with_small_tasks(spark: SparkSession) -> None:
    """Lowers the size that adaptive execution joins shuffled partitions up to, where it is Spark's default of 64 MB."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark.conf.get(name).lower().rstrip("b") in ("64m", "67108864"):
        spark.conf.set(name, f"{TASK_MB}m")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for this use under ``spark.checkpoint.dir``, which all executors must share.

    Where it is not set, a session in one process gets a temporary folder; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="trendloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read again, so that several uses don't compute them again."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
