"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from publicspend.session import shared_folder

#: Text that is worked on at once in a Python worker.
SLICE_BYTES = 4 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder on storage that the driver and all executors share."""
    run = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/publicspend-llm/{run}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to shared storage and read back: lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def take(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns only, renamed to the keywords; other columns may clash with anything."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(
        *[F.col(f"c{df.columns.index(old)}").alias(new) for new, old in columns.items()]
    )


def texts_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array as one buffer, and where each text starts and the last ends."""
    values = values.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[
        values.offset : values.offset + len(values) + 1
    ]
    if not len(values) or values.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    data = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        sizes = batch.column(column).cast(pa.large_binary())
        ends = np.cumsum(
            np.array([0 if n is None else n for n in pa.compute.binary_length(sizes).to_pylist()])
        )
        start, done = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start, done = stop, ends[stop - 1]


def release() -> None:
    """Give memory that a worker no longer uses, perhaps since an earlier stage, back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def mapped(
    df: DataFrame,
    column: str,
    schema: str | StructType,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """``function`` over pieces of the rows that hold about ``limit`` bytes of ``column``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, column, limit):
            yield function(piece)

    return df.mapInArrow(run, schema)


def running_start(
    df: DataFrame, group: str, order: list[Column], bucket: Column, size: str, name: str
) -> DataFrame:
    """``df`` with the sum of ``size`` over the earlier rows of the group, as column ``name``.

    ``bucket`` must rise with ``order``. Sums of buckets are added up first, then rows inside
    each bucket, so that no task orders a whole group.
    """
    df = df.withColumn("_bucket", bucket)
    sums = df.groupBy(group, "_bucket").agg(F.sum(size).alias("_sum"))
    before = Window.partitionBy(group).orderBy("_bucket")
    bases = sums.select(
        F.col(group).alias("_group"),
        F.col("_bucket").alias("_place"),
        (F.sum("_sum").over(before) - F.col("_sum")).alias("_base"),
    )
    inside = Window.partitionBy(group, "_bucket").orderBy(*order)
    local = df.withColumn("_local", F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        local.join(
            bases,
            F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_place")),
        )
        .withColumn(name, F.col("_base") + F.col("_local") - F.col(size))
        .drop("_bucket", "_group", "_place", "_base", "_local")
    )
