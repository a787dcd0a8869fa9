"""The place of each row in an ordered table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_PART, _ROW = "_place_part", "_place_row"


def in_place(df: DataFrame, path: str, name: str = "place") -> DataFrame:
    """``df`` with the place of each row in its order, from 1, as column ``name``.

    Spark sorts a table into ranges, one partition after the other. The rows are written at ``path``
    with the number of their partition and their place in it, so that both are taken from one
    and the same sort; then rows per partition are counted and added up, one number for each. No
    task sees more than its range.
    """
    columns = df.columns
    numbered = df.withColumns({_PART: F.spark_partition_id(), _ROW: F.monotonically_increasing_id()})
    numbered.write.parquet(path)
    stored = df.sparkSession.read.schema(numbered.schema).parquet(path)
    inside = F.col(_ROW) - F.shiftleft(F.col(_PART).cast("bigint"), 33)
    parts = stored.groupBy(_PART).agg(F.count("*").alias("_place_n"))
    before = F.sum("_place_n").over(Window.orderBy(_PART)) - F.col("_place_n")
    bases = parts.select(F.col(_PART), before.alias("_place_base"))
    places = stored.join(bases, _PART).withColumn(name, F.col("_place_base") + inside + 1)
    return places.select(*[f"`{c}`" for c in columns], name)
