"""Helpers for tables that several steps of one job read again."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder for staged tables, which every executor reaches.

    That of ``spark.checkpoint.dir``. A session without one gets a folder of the application in its
    warehouse, unless that lies on a local path, which other machines than this do not see.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    here = re.match(r"local(\[|$)", spark.sparkContext.master)
    if not here and re.match(r"file:|(?!\w+:)", warehouse):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{warehouse}/staged-{spark.sparkContext.applicationId}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps then read a columnar table whose size is known to the planner,
    and a lost executor costs a reread instead of a replay of the whole lineage.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Even out rows before costly per-row work if the scan has fewer splits than cores.

    A large table has more splits than cores and passes through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def remove_staged(spark: SparkSession, folder: str) -> None:
    """Delete a folder of staged tables once the results that read them are written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
