"""Layer tables on shared storage: paths, reads, writes, snapshots, SQL access."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StructType,
)

from publicspend.operators import quality
from publicspend.operators.quality import Watch
from publicspend.sources import tables
from publicspend.sources.tables import Buckets, Facts

WIDENED_FROM: dict[type, tuple[type, ...]] = {
    ShortType: (ByteType,),
    IntegerType: (ByteType, ShortType),
    LongType: (ByteType, ShortType, IntegerType),
    FloatType: (ByteType, ShortType),
    DoubleType: (ByteType, ShortType, IntegerType, FloatType),
}
WHOLE_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


class SchemaClash(ValueError):
    """Raised when no type holds a column's values of all years exactly."""


def clean_path(root: str, name: str, year: int) -> str:
    return f"{root}/data/clean/{name}/{year}/{name}_{year}_clean.parquet"


def mart_path(root: str, name: str, year: int, table: str) -> str:
    return f"{root}/data/mart/{name}/{year}/{table}.parquet"


def support_path(root: str, name: str, year: int) -> str:
    return f"{root}/data/support/{name}/{year}/{name}.parquet"


def raw_path(root: str, name: str, year: int) -> str:
    return f"{root}/data/raw/{name}/{year}/{name}.parquet"


def write_table(
    df: DataFrame,
    path: str,
    lookup: str | None = None,
    check: Callable[[DataFrame], None] | None = None,
    watch: Watch | None = None,
    more: Callable[[], list[Row]] = list,
    buckets: Buckets | None = None,
    keep: int = tables.KEPT,
) -> DataFrame:
    """Publish a new version of the table at ``path`` and return it as read back.

    What follows reads the files, so a lost executor never recomputes past this point. ``watch``
    measures rules while the rows are written, so that no second scan is needed for them; ``more``
    gives further ones that need its figures. If a rule fails, or ``check``, given the written
    table, raises, the table stays as it was. ``buckets`` deal the rows by a key that tables are
    joined on and single rows are fetched by; without them, ``lookup`` names a key for a bloom
    filter. ``keep`` versions stay, for jobs that still read them.
    """
    spark = df.sparkSession
    if buckets:  # falls away where the rows already lie so
        df = df.repartition(buckets.count, buckets.column)
    counted = watch or quality.Watch()
    version = tables.stage(counted.over(df), path, buckets, lookup)
    found = Facts(tables.schema_text(df.schema), counted.rows, counted.keys, buckets)
    tables.note(spark, path, version, found)
    quality.enforce_rows([*counted.checks(), *more()])
    if check:
        check(tables.read_version(spark, path, version))
    tables.publish(spark, path, version)
    tables.expire(spark, path, keep)
    return tables.read_version(spark, path, version)


def row_count(spark: SparkSession, path: str) -> int:
    """Rows in a written table: as counted in the write, or from the Parquet footers."""
    known = tables.facts(spark, path)
    return spark.read.parquet(path).count() if known is None else known.rows


def read_years(spark: SparkSession, template: str, years: list[int]) -> DataFrame:
    """External table whose location carries ``{year}``.

    Years may differ in columns; a column whose type differs is read in the narrowest type that
    holds all values of both exactly, and where there is none the read is refused.
    """
    found = {year: tables.read_table(spark, template.format(year=year)) for year in years}
    types = reconciled({year: df.schema for year, df in found.items()})
    casts = [
        df.select(*[F.col(_quoted(c)).cast(types[c.lower()][1]).alias(types[c.lower()][0]) for c in df.columns])
        for df in found.values()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), casts)


def reconciled(schemas: dict[int, StructType]) -> dict[str, tuple[str, DataType]]:
    """Name and type of every column, by its name in lower case, over the years in order."""
    types: dict[str, tuple[str, DataType]] = {}
    for year, schema in schemas.items():
        for field in schema:
            known = types.get(field.name.lower())
            wider = field.dataType if known is None else wider_type(known[1], field.dataType)
            if wider is None:
                raise SchemaClash(
                    f"{field.name} is {field.dataType.simpleString()} in {year} and "
                    f"{known[1].simpleString()} in earlier years"
                )
            types[field.name.lower()] = (known[0] if known else field.name, wider)
    return types


def wider_type(one: DataType, other: DataType) -> DataType | None:
    """The narrowest type that holds the values of both exactly; None if there is none.

    Whole numbers widen to longer ones, to doubles as far as these are exact (32 bits), and to
    decimals with enough digits; floats to doubles; decimals to more digits. Text, dates, times,
    truth values and nested types only match themselves. A column without a type takes the other's.
    """
    if one == other or isinstance(other, NullType):
        return one
    if isinstance(one, NullType):
        return other
    for narrow, wide in ((one, other), (other, one)):
        if type(wide) in WIDENED_FROM and isinstance(narrow, WIDENED_FROM[type(wide)]):
            return wide
    digits = [_digits(kind) for kind in (one, other)]
    if None in digits or not any(isinstance(kind, DecimalType) for kind in (one, other)):
        return None
    whole, scale = (max(pair) for pair in zip(*digits, strict=True))
    return DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def _digits(kind: DataType) -> tuple[int, int] | None:
    if isinstance(kind, DecimalType):
        return kind.precision - kind.scale, kind.scale
    return (WHOLE_DIGITS[type(kind)], 0) if type(kind) in WHOLE_DIGITS else None


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def load_clean(spark: SparkSession, root: str, name: str, years: list[int]) -> DataFrame:
    return read_years(spark, clean_path(root, name, "{year}"), years)


def load_mart(spark: SparkSession, root: str, name: str, table: str, year: int) -> DataFrame:
    return tables.read_table(spark, mart_path(root, name, year, table))


def query_clean(
    spark: SparkSession, root: str, name: str, sql: str, years: list[int]
) -> DataFrame:
    """Run SQL over the clean layer of some years, seen as ``clean_input``."""
    return query_tables(spark, sql, clean_input=load_clean(spark, root, name, years))


def query_tables(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run SQL over named DataFrames, whose names are free again afterwards."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(sql)
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)


def snapshots(spark: SparkSession, base: str) -> list[str]:
    """The names of the child directories of ``base`` that are dates, in order."""
    path = _hadoop_path(spark, base)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
    return sorted(name for name in names if _is_date(name))


def latest_snapshot(spark: SparkSession, base: str) -> str:
    """The child directory of ``base`` with the latest date; others are passed over."""
    names = snapshots(spark, base)
    if not names:
        raise FileNotFoundError(f"no dated snapshot below {base}")
    return f"{base.rstrip('/')}/{names[-1]}"


def partition_values(spark: SparkSession, base: str, column: str) -> list[str]:
    """The values that a table is partitioned by, from its folders."""
    path = _hadoop_path(spark, base)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
    start = f"{column}="
    return sorted(name.removeprefix(start) for name in names if name.startswith(start))


def _is_date(name: str) -> bool:
    try:
        return dt.date.fromisoformat(name).isoformat() == name
    except ValueError:
        return False


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)
