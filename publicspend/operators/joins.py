"""Left joins from a register to tables that are unique on the join key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.001


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys (NULL included) that hold more than ``share`` of the rows.

    At most ``1 / share`` keys can do so, which bounds what reaches the driver. Rows are counted
    by key, within each task first, and no task sees more than its part of the keys. This is a
    job of its own: where a contract holds the key unique, do without.
    """
    floor = max(df.count() * share, 1)
    return [row[0] for row in df.groupBy(key).count().where(F.col("count") > floor).collect()]


def left_join_all(
    base: DataFrame, sides: list[DataFrame], key: str, hot: list | None = None
) -> DataFrame:
    """Left join ``base`` to every side; each side has at most one row per key.

    The sides come out of aggregations on ``key``, so they are already partitioned as
    the join needs and each input is shuffled once. Rows of ``base`` whose key is in
    ``hot`` would all meet in one task there. They stay where they are instead, and the
    sides' rows for those keys, at most one per key, are broadcast to them.
    """

    def chain(left: DataFrame, rights: list[DataFrame]) -> DataFrame:
        return reduce(lambda df, right: df.join(right, key, "left"), rights, left)

    if not hot:
        return chain(base, sides)
    hot_row = is_hot(F.col(key), hot)
    # a plain list test, which reaches the scans of the sides
    listed = F.col(key).isin([k for k in hot if k is not None])
    hot_sides = [side.where(listed) for side in sides]
    if len(hot) <= 1 / HOT_SHARE:  # else leave the choice to Spark
        hot_sides = [F.broadcast(side) for side in hot_sides]
    return chain(base.where(~hot_row), sides).unionByName(chain(base.where(hot_row), hot_sides))


def is_hot(key: Column, hot: list) -> Column:
    """Whether the key is in the list; never NULL, so that it splits a table in two."""
    known = [k for k in hot if k is not None]
    listed = F.coalesce(key.isin(known), F.lit(False)) if known else F.lit(False)
    return listed | key.isNull() if None in hot else listed
