"""Joins with one row per key, of keys that a large part of the rows may share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys that more than one row in so many has are joined by broadcast: there are fewer of them than this.
SHARE = 1000


def looked_up(rows: DataFrame, table: DataFrame, on: list[str], size: str) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per key; inner join.

    ``size`` is a column of ``table``: how many of the rows have the key. Each key of more than one in
    ``SHARE`` of the rows is broadcast, fewer than ``SHARE`` keys at any size of the table, so
    that no task gets all rows of such a key; the others meet by a shuffle.
    """
    total = table.agg(F.sum(size)).first()[0] or 0
    hot = table.where(F.col(size) * SHARE > total)
    rest = table.where(F.col(size) * SHARE <= total)
    others = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(others.join(rest, on))
