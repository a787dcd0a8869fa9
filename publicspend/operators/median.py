"""Exact median per group that never gathers a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS_PER_E_FOLD = 64


def _bucket(value: Column) -> Column:
    """A coarse step number that never falls as the value rises."""
    size = F.floor(F.log1p(F.abs(value)) * STEPS_PER_E_FOLD)
    # never NULL: a NULL check on it would be pushed into one of the two uses of the
    # counts below, and Spark would compute them twice
    return F.coalesce(F.when(value < 0, -size).otherwise(size), F.lit(0))


def group_medians(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys`` and ``median`` for every group with a value; ``keys`` must not be NULL.

    Equal values are counted first. The counts are then added up in coarse buckets, of
    which a group has few whatever its size, and running totals over those tell which
    bucket holds the middle. Only the values in that bucket are put in order.
    """
    known = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count("*").alias("_n"))
        .withColumn("_bucket", _bucket(F.col(value)))
    )
    sizes = known.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_size"))
    along = Window.partitionBy(*keys).orderBy("_bucket")
    whole = Window.partitionBy(*keys)
    # 0-based ranks of the two middle rows, the same one where the count is odd
    low = F.shiftright(F.col("_total") - 1, 1)
    high = F.shiftright("_total", 1)
    middle = (
        sizes.withColumn("_upto", F.sum("_size").over(along))
        .withColumn("_total", F.sum("_size").over(whole))
        .withColumn("_before", F.col("_upto") - F.col("_size"))
        .where((F.col("_before") <= high) & (F.col("_upto") > low))
        .select(*keys, "_bucket", "_before", "_total")
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy(value)
    ranked = (
        known.join(middle, [*keys, "_bucket"])
        .withColumn("_end", F.col("_before") + F.sum("_n").over(within))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def holds(rank: Column) -> Column:
        return (F.col("_start") <= rank) & (F.col("_end") > rank)

    first = F.max(F.when(holds(low), F.col(value)))
    second = F.max(F.when(holds(high), F.col(value)))
    return ranked.groupBy(*keys).agg((first + (second - first) / 2).alias("median"))
