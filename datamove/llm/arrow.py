"""Feeding texts to tasks as Arrow batches, and staging what two branches of a plan share."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from datamove.session import drop_path, scratch_path

# Bytes of text that a task holds as arrays at a time; one longer text is taken alone.
SLICE_BYTES = 1 << 20

# Bytes that Spark sends a task at a time.
BATCH_BYTES = 4 << 20

# Name under which the text travels, so that no column of the caller's can clash with it.
TEXT = "__text__"


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Let executors import this package: Spark sends them a zip of it, once a session.

    Texts reach tasks in batches by their bytes, not their number, as some are long.
    """
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder, name = os.path.split(package)
        context.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), f"{name}-code"), "zip", folder, name))
        _shipped.add(context.applicationId)


def tidied(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` that gives memory back at its end: Spark keeps a task's process for later tasks."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows ``[i, j)`` with their bytes and the n + 1 offsets into these; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def map_texts(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    fields: Sequence[tuple[str, str]],
    work: Callable[[Iterator[pa.Array]], Iterator[list[pa.Array]]],
) -> DataFrame:
    """The ``keep`` columns with ``fields`` (name, DDL type) after them, made from each text.

    ``work`` turns a stream of text columns into a stream of lists of columns as long as those.
    """
    ship_code(df.sparkSession)
    # A text that is kept is not sent twice.
    sent_with = text in keep and df.schema[text].dataType == T.StringType()
    source = df.select(*[quoted(c) for c in keep], *[quoted(text).cast("string").alias(TEXT)] * (not sent_with))
    schema = T.StructType(source.schema.fields[: len(keep)] + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    width = len(keep)
    at = list(keep).index(text) if sent_with else width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[pa.Array]] = []

        def texts() -> Iterator[pa.Array]:
            for batch in batches:
                kept.append([batch.column(i) for i in range(width)])
                yield batch.column(at)

        for made in work(texts()):
            yield pa.RecordBatch.from_arrays(kept.pop(0) + made, names=schema.names)

    return source.mapInArrow(tidied(run), schema)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """A written copy in the shared folder, for what several branches read."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    copy.staged_at = path
    return copy


def drop_staged(*copies: DataFrame) -> None:
    """Delete written copies that nothing reads any more."""
    for copy in copies:
        drop_path(copy.sparkSession, copy.staged_at)


def fold(key: str) -> Column:
    """crc32 of the key as text, modulo 3; 1 is the fold that nothing is learnt from."""
    return F.crc32(quoted(key).cast("string").cast("binary")) % 3
