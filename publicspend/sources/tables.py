"""Tables in versions, on any store that Spark can write to.

    <path>/_versions/<number>-<id>/    the Parquet files of a version, never changed once written
    <path>/_versions/<...>/_facts.json  how they are laid out, and what was counted while writing
    <path>/_published/<number>-<id>    an empty file for each version that may be read

A version counts from the moment its empty file is there, and creating an empty file is one step on
HDFS, local disks and object stores alike: nothing is renamed, replaced or copied. Readers take the
highest number, so they see the old table or the new one, whenever a job is killed. Files of a
version that is still read stay: ``expire`` removes only those beyond the newest few.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

VERSIONS, PUBLISHED, FACTS = "_versions", "_published", "_facts.json"
KEPT = 2


class PublishError(RuntimeError):
    """Raised when another job has published a version meanwhile."""


@dataclass(frozen=True)
class Buckets:
    """Rows are dealt to ``count`` buckets by a hash of ``column`` and sorted by it in each.

    Tables with equal buckets join and group on the column without a shuffle, and a single value is
    looked up in one bucket.
    """

    column: str
    count: int


@dataclass(frozen=True)
class Facts:
    """What is known of a version without reading it. ``keys`` is the fingerprint of its keys."""

    schema: str
    rows: int | None = None
    keys: int | None = None
    buckets: Buckets | None = None


def schema_text(schema: StructType) -> str:
    """The schema as it will be read: Parquet files do not hold that a value is never missing."""
    text = schema.json()
    for name in ("nullable", "containsNull", "valueContainsNull"):
        text = text.replace(f'"{name}":false', f'"{name}":true')
    return text


def version_path(path: str, version: str) -> str:
    return f"{path}/{VERSIONS}/{version}"


def versions(spark: SparkSession, path: str) -> list[str]:
    """The published versions, oldest first.

    Should two jobs have published the same number, the lower name counts; the other job fails.
    """
    names: dict[int, str] = {}
    for name in sorted(_children(spark, f"{path}/{PUBLISHED}")):
        names.setdefault(_number(name), name)
    return [names[number] for number in sorted(names)]


def current(spark: SparkSession, path: str) -> str | None:
    """The version that readers see; None where nothing is published."""
    found = versions(spark, path)
    return found[-1] if found else None


def stage(df: DataFrame, path: str, buckets: Buckets | None = None, lookup: str | None = None) -> str:
    """Write a new version that nobody sees yet, and return its name."""
    spark = df.sparkSession
    number = max(map(_number, versions(spark, path)), default=0) + 1
    version = f"{number:08d}-{uuid.uuid4().hex[:12]}"
    place = _whole_path(spark, version_path(path, version))
    writer = df.write.format("parquet").option("compression", "zstd")
    if lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{lookup}", "true")
    if buckets is None:
        writer.save(place)
    else:  # Spark lays out buckets only through its catalog; the name goes, the files stay
        name = f"publicspend_{uuid.uuid4().hex}"
        writer = writer.bucketBy(buckets.count, buckets.column).sortBy(buckets.column)
        writer.option("path", place).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")
    return version


def note(spark: SparkSession, path: str, version: str, facts: Facts) -> None:
    """Keep the facts beside the files of a version that is not published yet."""
    place = _path(spark, f"{version_path(path, version)}/{FACTS}")
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray(json.dumps(asdict(facts)).encode()))
    out.close()


def publish(spark: SparkSession, path: str, version: str) -> None:
    """Let readers see a staged version, unless another job was faster."""
    _refuse(spark, path, version)
    place = _path(spark, f"{path}/{PUBLISHED}/{version}")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.create(place, False).close()
    try:
        _refuse(spark, path, version)
    except PublishError:
        files.delete(place, False)
        raise


def _refuse(spark: SparkSession, path: str, version: str) -> None:
    newest = current(spark, path)
    if newest and newest != version and _number(newest) >= _number(version):
        raise PublishError(f"{path}: {newest} was published while {version} was written")


def facts(spark: SparkSession, path: str, version: str | None = None) -> Facts | None:
    """What was noted of a version, the current one if none is named."""
    version = version or current(spark, path)
    if version is None:
        return None
    place = _path(spark, f"{version_path(path, version)}/{FACTS}")
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    buckets = found.pop("buckets")
    return Facts(**found, buckets=Buckets(**buckets) if buckets else None)


def read_version(spark: SparkSession, path: str, version: str) -> DataFrame:
    place = _whole_path(spark, version_path(path, version))
    known = facts(spark, path, version)
    schema = StructType.fromJson(json.loads(known.schema))
    if known.buckets is None:
        return spark.read.schema(schema).parquet(place)
    name = f"publicspend_{uuid.uuid4().hex}"
    column = f"`{known.buckets.column}`"
    location = place.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet CLUSTERED BY ({column}) "
        f"SORTED BY ({column}) INTO {known.buckets.count} BUCKETS LOCATION '{location}'"
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version; a path without versions is read as plain Parquet files."""
    version = current(spark, path)
    return spark.read.parquet(path) if version is None else read_version(spark, path, version)


def expire(spark: SparkSession, path: str, keep: int = KEPT) -> list[str]:
    """Remove all but the ``keep`` newest versions, and what killed jobs left; return their names.

    First a version stops being published, then its files go, so nothing half removed is ever read
    as whole. A version still being written has a higher number than all published ones and stays.
    Jobs that began to read a version more than ``keep`` publications ago lose their files.
    """
    published = versions(spark, path)
    if not published:
        return []
    kept, newest = set(published[-keep:]), _number(published[-1])
    gone = [v for v in _children(spark, f"{path}/{PUBLISHED}") if v not in kept]
    left = [
        v for v in _children(spark, f"{path}/{VERSIONS}") if v not in kept and _number(v) <= newest
    ]
    for version in gone:
        _delete(spark, f"{path}/{PUBLISHED}/{version}")
    for version in left:
        _delete(spark, version_path(path, version))
    if len(published) >= keep:  # files from before the table had versions
        for name in _children(spark, path):
            if not name.startswith("_"):
                _delete(spark, f"{path}/{name}")
    return sorted({*gone, *left})


def _number(version: str) -> int:
    return int(version.split("-")[0])


def _children(spark: SparkSession, path: str) -> list[str]:
    place = _path(spark, path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return [name for name in names if not name.startswith(".")]


def _delete(spark: SparkSession, path: str) -> None:
    place = _path(spark, path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _whole_path(spark: SparkSession, path: str) -> str:
    """With its store and from the root, as a catalog would take another place as the start."""
    place = _path(spark, path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)
