"""Every query against its SQL on the same tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_point
from lodespark.operators import graph
from lodespark.plans import bindings
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_matches_sql(spark, con, name):
    result = entry_point.queries()[name](spark, SF_DIR)
    assert differences(result, con, entry_point.oracle_sql()[name]) == ""


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["a", "b", "mutual"]
    assert result.count() == 10


def test_neighbours_are_left_out_of_the_recommendations(spark):
    edges = bindings.parts_graph(spark, SF_DIR)
    near = graph.mutual_counts(edges).join(edges, ["a", "b"], "left_semi")
    assert not near.isEmpty()
    totals = graph.candidate_totals(edges).agg({"mutual": "sum"}).first()[0]
    assert totals == 2 * graph.mutual_counts(edges).join(edges, ["a", "b"], "left_anti").agg(
        {"mutual": "sum"}
    ).first()[0]
