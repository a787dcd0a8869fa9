"""Session settings the jobs are written for."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

PARTITION_BYTES = 128 * 1024 * 1024
MOST_PARTITIONS = 30_000
MOST_READS = 100_000
SHUFFLE_SETTING = "spark.sql.shuffle.partitions"
SETTINGS = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
}


def session(app: str, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(
    spark: SparkSession,
    tables: list[list[str]],
    growth: float = 4.0,
    partition_bytes: int = PARTITION_BYTES,
    most_partitions: int = MOST_PARTITIONS,
    most_reads: int = MOST_READS,
) -> int:
    """Set the width of scans and shuffles from the size of the largest table's files.

    Adaptive execution merges small partitions but does not cut even ones, so the number has
    to suit the largest input: one partition for each ``partition_bytes``, where ``growth`` is how
    much files swell when unpacked.

    Each pair of a map and a reduce task makes a block to keep track of, so both stop at a
    width. The defaults suit a driver of 16 GB. Beyond ``most_partitions`` (4 TB unpacked, 1 TB of
    files) partitions grow, and a sort writes and reads each row once more for every factor of
    about 100 by which its partition passes the executor's sort memory: once up to 100 TB, where
    a partition holds 13 GB. Beyond ``most_reads`` (13 TB of files) reads grow. Raise both on a
    larger driver; results do not depend on them.
    """
    size = largest_bytes(spark, tables)
    wanted = shuffle_width(size, growth, partition_bytes, most_partitions)
    partitions = max(int(spark.conf.get(SHUFFLE_SETTING)), wanted)
    spark.conf.set(SHUFFLE_SETTING, str(partitions))
    if size > partition_bytes * most_reads:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(math.ceil(size / most_reads)))
    return partitions


def largest_bytes(spark: SparkSession, tables: list[list[str]]) -> int:
    """Bytes in the files of the largest of the tables."""
    return max(sum(_file_bytes(spark, path) for path in paths) for paths in tables)


def shuffle_width(
    size: int,
    growth: float = 4.0,
    partition_bytes: int = PARTITION_BYTES,
    most_partitions: int = MOST_PARTITIONS,
) -> int:
    """Partitions for a table of ``size`` bytes in files: it grows with them, up to a limit."""
    return min(math.ceil(size * growth / partition_bytes), most_partitions)


@contextmanager
def shuffles_of(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Shuffles of this many partitions for what is run within; then as before.

    With as many partitions as tables have buckets, what was grouped by the buckets' column is
    written to them without another shuffle.
    """
    before = spark.conf.get(SHUFFLE_SETTING)
    spark.conf.set(SHUFFLE_SETTING, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_SETTING, before)


def _file_bytes(spark: SparkSession, path: str) -> int:
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(pattern) or []
    return sum(files.getContentSummary(status.getPath()).getLength() for status in found)


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach, as the cluster names it.

    Where none is named, local runs share a temporary one, which goes when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if "folder" not in _LOCAL:
        _LOCAL["folder"] = tempfile.mkdtemp(prefix="publicspend-")
        atexit.register(shutil.rmtree, _LOCAL["folder"], ignore_errors=True)
    return _LOCAL["folder"]


_LOCAL: dict[str, str] = {}
