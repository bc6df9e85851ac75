"""The smallest rows by a threshold against a plain sort."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lodespark.operators import sampling
from lodespark.operators.select import below, smallest


def keys(kind):
    rng = random.Random(kind)
    if kind == "spread":
        return [rng.randrange(-(2**63), 2**63) for _ in range(3000)]
    if kind == "crowded":  # nearly all in one bucket of the first histogram
        return [rng.randrange(10**6, 10**6 + 5000) for _ in range(3000)] + [-(2**62), 2**62]
    return [7] * 1500 + [rng.randrange(20) for _ in range(1500)]


@pytest.mark.parametrize("kind", ["spread", "crowded", "ties"])
def test_smallest_matches_a_sort(spark, kind):
    rows = list(enumerate(keys(kind)))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "id long, key long").repartition(6)
    for n in (1, 50, 1700, 5000):
        found = [tuple(r) for r in smallest(df, F.col("key"), ["key", "id"], n).collect()]
        assert found == sorted(rows, key=lambda r: (r[1], r[0]))[:n]
        if kind != "ties":
            assert min(n, len(rows)) <= below(df, F.col("key"), n).count() <= max(2 * n, 1)


def test_no_rows_and_no_keys(spark):
    empty = spark.createDataFrame([], "key long")
    assert smallest(empty, F.col("key"), ["key"], 3).count() == 0
    some = spark.createDataFrame([(None,), (5,), (None,), (4,)], "key long")
    assert [r[0] for r in smallest(some, F.col("key"), ["key"], 3).collect()] == [None, None, 4]
    assert smallest(some.where("key is null"), F.col("key"), ["key"], 1).count() == 1


def test_positives_do_not_depend_on_partitions(spark):
    rows = [(u, i, u * 100 + i) for u in range(60) for i in range(50)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, ts long")
    label = (3, "positive", "user_id", "item_id")
    plain = df.orderBy(sampling._key(*label)).limit(40)
    wanted = {tuple(r) for r in plain.collect()}
    for parts in (1, 16):
        found = sampling.positives(df.repartition(parts), 40, 20, seed=3).collect()
        assert {tuple(r) for r in found} == wanted


def test_positives_are_found_in_few_passes(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(4000).selectExpr("id % 50 AS user_id", "id AS item_id", "id AS ts")
    df = rows.mapInArrow(counted, "user_id long, item_id long, ts long")
    found = sampling.positives(df, 40, 20, seed=3).collect()
    label = (3, "positive", "user_id", "item_id")
    plain = rows.orderBy(sampling._key(*label)).limit(40).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, plain))
    assert read.value <= 3 * 4000


def test_positives_beyond_an_unlucky_bound(spark, monkeypatch):
    df = spark.range(2000).selectExpr("id % 50 AS user_id", "id AS item_id", "id AS ts")
    plain = sampling.positives(df, 40, 20, seed=3).collect()
    monkeypatch.setattr(sampling, "_key", lambda *a, key=sampling._key: sampling.F.concat(sampling.F.lit("f"), key(*a)))
    monkeypatch.setattr(sampling, "_number", lambda *a: sampling.F.conv(sampling.F.substring(sampling._key(*a), 1, 15), 16, 10).cast("decimal(20,0)"))
    beyond = sampling.positives(df, 40, 20, seed=3).collect()
    assert sorted(map(tuple, beyond)) == sorted(map(tuple, plain))
