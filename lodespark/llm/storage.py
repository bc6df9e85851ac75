"""Binary files in a folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodespark.staging import shared_folder, stage


def new_folder(spark: SparkSession, kind: str) -> str:
    """A folder of its own for one run, inside the shared folder; made by the first writer.

    Hadoop says in which file system it lies, as for tables: a path without a scheme is not one of
    each machine's own disk on a cluster.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString()


def _locate(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        fs.LocalFileSystem(),
        path,
    )


@contextmanager
def replacing(path: str) -> Iterator:
    """Stream to a file that gets its name once it is whole, so that a repeated or lost task
    never leaves half of one behind."""
    system, name = _locate(path)
    folder, _, last = name.rpartition("/")
    system.create_dir(folder, recursive=True)
    unfinished = f"{folder}/.{last}-{uuid.uuid4().hex}"
    with system.open_output_stream(unfinished) as out:
        yield out
    system.move(unfinished, name)


@contextmanager
def opened(path: str) -> Iterator:
    """A file as a stream of its bytes, also if its name says that they are packed."""
    system, name = _locate(path)
    with system.open_input_stream(name, compression=None) as source:
        yield source


def mapped(path: str, dtype: str) -> np.ndarray:
    """The numbers in a file: memory-mapped if the folder is mounted, else read."""
    system, name = _locate(path)
    if system.get_file_info(name).size == 0:
        return np.empty(0, dtype)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(name, dtype, "r")
    with system.open_input_file(name) as source:
        return np.frombuffer(source.read(), dtype)


def partitions(df: DataFrame) -> int:
    """Number of partitions that follows the size of the input; at least one per core."""
    return max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions())


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number the rows from 0 in the given order without one task seeing them all.

    Rows are dealt by range, numbered within a partition, and moved up by the rows of the
    partitions before; only the counts, one per partition, are summed in one task. Equal rows
    get different numbers.
    """
    parts = stage(
        df.repartitionByRange(partitions(df), *order).withColumn("_part", F.spark_partition_id())
    )
    counts = parts.groupBy("_part").agg(F.count("*").alias("_rows"))
    columns = ", ".join(f"`{c}`" for c in df.columns)
    parts.createOrReplaceTempView(view := f"ranked_{uuid.uuid4().hex}")
    counts.createOrReplaceTempView(sizes := f"sizes_{uuid.uuid4().hex}")
    by = ", ".join(f"`{c}`" for c in order)
    return df.sparkSession.sql(
        f"""WITH base AS (
              SELECT _part, sum(_rows) OVER (ORDER BY _part) - _rows AS _base FROM {sizes})
            SELECT {columns},
              row_number() OVER (PARTITION BY p._part ORDER BY {by}) - 1 + _base AS `{name}`
            FROM {view} p JOIN base ON p._part = base._part"""
    )
