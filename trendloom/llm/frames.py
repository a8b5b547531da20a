"""Helpers of this package: settled tables, rows carried whole, Arrow batches of bounded size, files in a shared store."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.session import shared_folder

#: Bytes after which a batch is handed on, and bytes of a batch that are made Python objects at once.
BATCH_BYTES, ROWS_BYTES = 16 << 20, 2 << 20


def settled(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The same rows, written to the shared folder and read again: its plan ends here, and a lost executor costs a read."""
    path = shared_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def carried(df: DataFrame, **more: Column) -> DataFrame:
    """All columns of ``df`` inside one struct ``row``, beside columns of our own: their names can't clash."""
    return df.select(F.struct(*[column(c) for c in df.columns]).alias("row"), *[v.alias(k) for k, v in more.items()])


def released(df: DataFrame, columns: Sequence[str], **replaced: Column) -> DataFrame:
    """The carried columns again, in their order; ``replaced`` gives new values to some of them."""
    return df.select(*[replaced[c].alias(c) if c in replaced else F.col("row").getField(c).alias(c) for c in columns])


def arrow_map(df: DataFrame, function: Callable[..., Iterable[tuple]], schema: str | T.StructType, *args: object) -> DataFrame:
    """``mapInArrow`` of a generator over rows: ``function(rows, *args)`` gets an iterator of tuples and yields tuples."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    types = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for row in function(_rows(batches), *args):
            held.append(row)
            size += 64 + sum(len(x) for x in row if isinstance(x, (bytes, str)))
            if size > BATCH_BYTES or len(held) >= 10_000:
                yield _batch(held, types)
                held, size = [], 0
        if held:
            yield _batch(held, types)

    return df.mapInArrow(run, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        step = max(1, len(batch) * ROWS_BYTES // max(ROWS_BYTES, batch.nbytes))
        for i in range(0, len(batch), step):
            yield from zip(*[c.to_pylist() for c in batch.slice(i, step).columns])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def portions(rows: Iterable[tuple], characters: int = 12 << 20) -> Iterator[list[tuple]]:
    """Lists of rows with about so many characters or bytes in their texts, one row at least."""
    some: list[tuple] = []
    size = 0
    for row in rows:
        some.append(row)
        size += 64 + sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if size >= characters:
            yield some
            some, size = [], 0
    if some:
        yield some


def _place(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else uri
    return pyarrow.fs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, data: bytes) -> str:
    """Writes one file under a name that no other attempt of the task uses, and returns its address.

    Only addresses that a committed table holds count. What a failed attempt leaves behind is never read.
    """
    stem, dot, end = name.partition(".")
    uri = f"{folder.rstrip('/')}/{stem}-{uuid.uuid4().hex}{dot}{end}"
    store, path = _place(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    with store.open_output_stream(path, compression=None) as out:
        out.write(data)
    return uri


def read_file(uri: str) -> bytes:
    store, path = _place(uri)
    with store.open_input_stream(path, compression=None) as file:
        return file.read()
