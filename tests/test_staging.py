"""Staged tables and where they go."""

from __future__ import annotations

import pytest

from lodespark import staging


class FakeConf:
    def __init__(self, folder, warehouse):
        self.folder, self.warehouse = folder, warehouse

    def get(self, key, default=None):
        return {"spark.checkpoint.dir": self.folder, "spark.sql.warehouse.dir": self.warehouse}[key]


class FakeContext:
    def __init__(self, master):
        self.master = master
        self.applicationId = f"app-{master}"


class FakeSession:
    def __init__(self, folder, master, warehouse="file:/house/"):
        self.conf = FakeConf(folder, warehouse)
        self.sparkContext = FakeContext(master)


def test_folder_of_the_session_comes_first():
    assert staging.shared_folder(FakeSession("hdfs:///tables", "yarn")) == "hdfs:///tables"
    assert staging.shared_folder(FakeSession(None, "local[8]")) == "file:/house/staged-app-local[8]"
    assert staging.shared_folder(FakeSession(None, "yarn", "hdfs:///house")) == "hdfs:///house/staged-app-yarn"


@pytest.mark.parametrize("warehouse", ["file:/house", "/house", "house"])
def test_no_folder_of_one_machine_on_a_cluster(warehouse):
    with pytest.raises(ValueError):
        staging.shared_folder(FakeSession(None, "yarn", warehouse))


def test_staged_table_holds_the_same_rows(spark):
    df = spark.range(10).withColumnRenamed("id", "n")
    staged = staging.stage(df)
    assert staged.dtypes == df.dtypes
    assert sorted(r["n"] for r in staged.collect()) == list(range(10))
    assert staging.stage(df.limit(0)).count() == 0


def test_removed_folder_is_gone(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/kept/table")
    staging.remove_staged(spark, f"{tmp_path}/kept")
    assert not (tmp_path / "kept").exists()
