"""The rows with the smallest keys, without every partition sending its own to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a histogram that reach the driver in one step.
BUCKETS = 4096


def smallest(rows: DataFrame, key: Column, order: list[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``, which never falls where the whole number ``key`` rises.

    A histogram of the keys, refined in the bucket that holds the n-th, gives a bound below which
    lie ``n`` rows and at most ``n`` more (or all that have the bounding key). Only these are sorted.
    Rows without a key come first.
    """
    return below(rows, key, n).orderBy(*order).limit(n)


def below(rows: DataFrame, key: Column, n: int) -> DataFrame:
    """Rows up to a bound of ``key`` that at least ``n`` rows reach, or all if there are fewer."""
    keyed = rows.select(key.cast("decimal(20,0)").alias("key"))
    low, high = keyed.agg(F.min("key"), F.max("key")).first()
    if low is None:
        return rows
    low, high, before = int(low), int(high), 0
    while True:
        step = -(-(high - low + 1) // BUCKETS)
        start = F.col("key") - (F.col("key") - F.lit(low)) % F.lit(step)
        counts = (
            keyed.where(F.col("key").between(low, high))
            .groupBy(start.cast("decimal(20,0)").alias("start"))
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy("start")
            .collect()
        )
        for bucket in counts:
            if before + bucket["n"] >= n:
                break
            before += bucket["n"]
        else:
            return rows
        low = int(bucket["start"])
        high = low + step - 1
        if step == 1 or before + bucket["n"] <= 2 * n:
            return rows.where(key.isNull() | (key <= F.lit(high).cast("decimal(20,0)")))
