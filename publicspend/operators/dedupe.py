"""One deterministic row per key.

A row is picked by comparing whole structs with ``min``/``max``. That is a plain
aggregation: each map task sends at most one row per key, so a key holding a large
part of the table costs no more than any other, and Catalyst knows the result is
unique on the key and drops the join when no column of it is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lowest_row(df: DataFrame, key: str, first: list[Column], columns: list[str]) -> DataFrame:
    """The row that sorts first by ``first`` and then by ``columns``, NULLs last."""
    parts = [c.alias(f"_first{i}") for i, c in enumerate(first)]
    for i, name in enumerate(columns):
        parts += [F.col(name).isNull().alias(f"_null{i}"), F.col(name)]
    return _expand(df.groupBy(key).agg(F.min(F.struct(*parts)).alias("_row")), key, columns)


def highest_row(df: DataFrame, key: str, measure: str, columns: list[str]) -> DataFrame:
    """The row with the highest ``measure``, NULLs last; ties fall to the highest ``columns``."""
    ordered = [measure] + [c for c in columns if c != measure]
    return _expand(df.groupBy(key).agg(F.max(F.struct(*ordered)).alias("_row")), key, columns)


def _expand(picked: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return picked.select(key, *[F.col("_row")[c].alias(c) for c in columns])
