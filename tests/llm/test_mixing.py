from __future__ import annotations

import random
import re
from collections import defaultdict

import duckdb
import pytest

from lodespark.llm import mixing, queries
from lodespark.staging import stage
from tests.compare import differences
from tests.llm.conftest import ODD_TEXTS

SCHEMA = "doc_id long, source string, text string, target string"


def wanted(sizes):
    """Targets by resharing the excess round after round."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: 1 + n % 3 for n, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        share = {s: target[s] + left * weight[s] / total for s in open_}
        left = 0.0
        for s, value in share.items():
            target[s] = min(value, 3.0 * sizes[s])
            left += value - target[s]
            if target[s] == 3.0 * sizes[s]:
                open_.discard(s)
    return target


def mix(docs):
    rows = stage(mixing.measured(docs.select("doc_id", "source", "text")))
    return mixing.taken(rows, mixing.plan(rows)).collect()


@pytest.fixture
def rows():
    rng = random.Random(8)
    rows = []
    for name, count in (("b", 300), ("a", 20), ("ü", 40), ("z", 500), (None, 5), ("empty", 2)):
        for _ in range(count):
            text = "" if name == "empty" else "w " * rng.choice([1, 3, 10, 40])
            rows.append((len(rows), name, text, None))
    rows += [(len(rows) + n, "b", text, "x") for n, text in enumerate(ODD_TEXTS)]
    return rows


def test_targets_and_takes(frame, rows):
    found = mix(frame(rows, SCHEMA))
    assert len(found) == len(rows)
    text = {r[0]: r[2] or "" for r in rows}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    source = {r[0]: r[1] for r in rows}
    for row in found:
        assert row["size"] == len(re.findall(mixing.WORD, text[row["doc_id"]]))
        assert row["taken"] == row["copies"] * row["size"] <= 3 * row["size"]
        name = source[row["doc_id"]]
        sizes[name] += row["size"]
        taken[name] += row["taken"]
        target[name] = row["target"]
    assert target == pytest.approx(wanted(sizes))
    for name in sizes:
        longest = max(r["size"] for r in found if source[r["doc_id"]] == name)
        assert abs(taken[name] - target[name]) <= longest / 2 + 1e-9, name


def test_reruns_and_order_agree(frame, rows):
    first = {tuple(r) for r in mix(frame(rows, SCHEMA))}
    assert {tuple(r) for r in mix(frame(rows[::-1], SCHEMA).repartition(7))} == first


def test_repeated_rows_go_together(frame):
    rows = [(1, "a", "x y", None)] * 6 + [(2, "b", "x " * 100, None)]
    copies = {r["copies"] for r in mix(frame(rows, SCHEMA)) if r["doc_id"] == 1}
    assert len(copies) == 1


def test_empty_tables(frame):
    assert mix(frame([], SCHEMA)) == []
    (row,) = mix(frame([(None, None, None, None)], SCHEMA))
    assert (row["size"], row["target"], row["taken"]) == (0, 0.0, 0)


def test_sql(frame, rows, spark, tmp_path):
    docs = frame(rows, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert differences(queries.op8_source_mix(spark, str(tmp_path)), con, mixing.SQL) == ""


def test_columns_that_clash(frame):
    docs = frame([(1, "a", "x y", "t", 5)], "doc_id long, source string, text string, target string, size int")
    rows = stage(mixing.measured(docs))
    (row,) = mixing.taken(rows, mixing.plan(rows)).collect()
    assert row["target"] == 2.0 and row["size"] == 2 and len(row.asDict()) == len(row)
