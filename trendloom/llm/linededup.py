"""Repeated lines, dropped by levelled sorted runs of line hashes. DataFrame operations only.

One plain group-by over all lines decides which of them are in enough documents; only places of those enter the runs, which
name their owners.

Runs hold the hashes of lines that have an owner, sorted by hash. Each new batch of lines is merge-anti-joined with the runs;
what is left is new, gets its owner, and becomes a run of its own. When a level holds enough runs they are merged into one
run of the next level, so a batch meets few runs, however many batches came before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom.llm.frames import carried, column, released, settled
from trendloom.session import shared_folder

#: Runs of a level that are merged into one of the next, and batches that the documents are dealt to.
FANOUT, BATCHES = 4, 8
#: Shortest key in code points, and fewest documents, for a line to count as repeated.
LEAST_LENGTH, LEAST_DOCUMENTS = 20, 3

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashed(key: Column) -> list[Column]:
    """128 bits: two hashes with different seeds."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(20), key).alias("h2")]


class LineRuns:
    """The levelled runs: tables of ``h1, h2, owner`` in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout, self.levels = spark, fanout, []

    def _write(self, rows: DataFrame) -> str:
        path = shared_folder(self.spark, "line-run")
        rows.select(*HASH, "owner").sortWithinPartitions(*HASH).write.parquet(path)
        return path

    def _read(self, paths: Sequence[str]) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, owner long").parquet(*paths)

    def rows(self) -> DataFrame:
        """All hashes with their owners; each hash is in one run only."""
        paths = [p for level in self.levels for p in level]
        return self._read(paths) if paths else self.spark.createDataFrame([], "h1 long, h2 long, owner long")

    def add(self, batch: DataFrame) -> None:
        """Gives owners to the lines of ``batch`` (``h1, h2, doc_id``) that no earlier batch had: the largest document."""
        new = batch.groupBy(*HASH).agg(F.max("doc_id").alias("owner"))
        if self.levels:
            new = new.join(self.rows().select(*HASH).hint("merge"), HASH, "left_anti")
        run = self._write(new)
        level = 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            run = self._write(self._read(self.levels[level]).repartition(*HASH))
            self.levels[level] = []
            level += 1


def _batches(lines: DataFrame, batches: int) -> list[int]:
    """Ids that cut the documents into batches of about equal size, largest first."""
    cuts = lines.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 1000)).first()[0]
    return sorted(set(cuts or []), reverse=True)


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES) -> DataFrame:
    """``row`` (all columns of ``docs``), ``kept_text``, ``n_lines`` and ``n_dropped``.

    A line whose key has 20 code points or more and is in three documents or more stays only in the document with the largest
    id that has it. Documents enter in batches from the largest ids down, so that the first owner of a line is the right one.
    Null and empty texts are one empty line. Rows without an id take no part and stay whole. Each row that repeats an id
    counts as a document. An empty table gives an empty table. ``docs`` should be a table, as it is read three times.
    """
    doc_id, lines = column(key).cast("long"), lines_of(column(text).cast("string"))
    rows = docs.select(doc_id.alias("doc_id"), F.xxhash64(F.coalesce(column(text).cast("string"), F.lit(""))).alias("content"), lines.alias("lines")).where("doc_id IS NOT NULL")
    keyed = rows.select("doc_id", "content", F.transform("lines", line_key).alias("keys"))
    once = keyed.select(F.explode(F.array_distinct("keys")).alias("k")).where(F.length("k") >= LEAST_LENGTH).select(*_hashed(F.col("k")))
    repeated = settled(once.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_DOCUMENTS).select(*HASH), "repeated-lines")
    every = keyed.select("doc_id", "content", F.posexplode("keys").alias("pos", "k")).where(F.length("k") >= LEAST_LENGTH).select("doc_id", "content", "pos", *_hashed(F.col("k")))
    found = settled(every.join(repeated, HASH, "left_semi").select("doc_id", "content", "pos", *HASH), "line-places")

    runs = LineRuns(docs.sparkSession)
    above = None
    for low in [*_batches(found, batches), None]:
        batch = found if low is None else found.where(F.col("doc_id") > low)
        runs.add(batch if above is None else batch.where(F.col("doc_id") <= above))
        above = low

    lost = found.join(runs.rows(), HASH).where("doc_id < owner").groupBy("doc_id", "content").agg(F.collect_set("pos").alias("lost"))
    lost = settled(lost, "lost-lines").select(F.col("doc_id").alias("d"), F.col("content").alias("c"), "lost")
    whole = carried(docs, d=doc_id, c=F.xxhash64(F.coalesce(column(text).cast("string"), F.lit(""))), lines=lines)
    whole = whole.join(lost, ["d", "c"], "left")
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    # The places that stay, by a hash set over the lost ones: linear in the lines of a document.
    kept = F.when(F.col("lost").isNull(), F.col("lines")).otherwise(
        F.transform(F.array_except(places, F.col("lost")), lambda i: F.get("lines", i))
    )
    return whole.select(
        "row", F.array_join(kept, "\n").alias("kept_text"), F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped")
    )


def without_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars", batches: int = BATCHES) -> DataFrame:
    """``docs`` with the lines that stay, and their number of characters in ``length`` where there is such a column.

    Texts that lose no line stay as they are, null included. A document that loses all its lines stays, with an empty text.
    """
    found = deduplicated(docs, key, text, batches)
    changed = F.col("n_dropped") > 0
    new = {text: F.when(changed, F.col("kept_text")).otherwise(F.col("row").getField(text))}
    if length in docs.columns:
        new[length] = F.when(changed, F.length("kept_text").cast(docs.schema[length].dataType)).otherwise(F.col("row").getField(length))
    return released(found, docs.columns, **new)
