from __future__ import annotations

import json
import random

import duckdb
import pytest

from lodespark.llm import chat, queries
from tests.compare import connect, differences

LAYOUTS = [
    ("row", {"role": "user", "text": "a"}, [("user", "a")]),
    ("message", {"role": "assistant", "content": None}, [("assistant", "")]),
    ("messages", {"messages": [{"role": "user", "content": "a"}, {"role": "bot", "content": "b"}]},
     [("user", "a"), ("assistant", "b")]),
    ("conversations", {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
     [("user", "a"), ("assistant", "b")]),
    ("prompt", {"completion": "b", "prompt": "a"}, [("user", "a"), ("assistant", "b")]),
    ("instruction_input", {"instruction": "s", "input": "a", "output": "b"},
     [("system", "s"), ("user", "a"), ("assistant", "b")]),
    ("system_messages", {"system": "s", "messages": [{"role": "user", "content": "a"}]},
     [("system", "s"), ("user", "a")]),
]


@pytest.mark.parametrize("name, record, turns", LAYOUTS)
def test_layouts(name, record, turns):
    assert chat.canonical(json.dumps(record)) == (name, turns)


@pytest.mark.parametrize("record", [None, "", "{", "[1]", "3", '{"a": 1}', '{"messages": []}'])
def test_unknown_records(record):
    assert chat.canonical(record) == (None, [])


def test_fingerprints_differ():
    assert len(chat.BY_FINGERPRINT) == len(chat.MAPPINGS)


def test_round_trip():
    rng = random.Random(2)
    parts = [*chat.CONTROLS, "\\", "\n", "a", "é", "<", "s", ">", "/", "[", "😀"]
    for _ in range(3000):
        turns = [
            ("".join(rng.choices(parts, k=rng.randrange(6))), "".join(rng.choices(parts, k=rng.randrange(10))))
            for _ in range(rng.randrange(4))
        ]
        marked = [chat.formatted(role, text) for role, text in turns]
        assert chat.read_back("".join(m for m, _ in marked)) == turns
        for (_, text), (segment, learnt) in zip(turns, marked):
            for low, high in learnt:
                assert chat.unescape(segment[low:high]) == text


def test_no_control_string_is_left_in_a_text():
    body = chat.escape("".join(chat.CONTROLS))
    assert not any(control in body for control in chat.CONTROLS)


def test_sql_on_control_strings(spark, frame, tmp_path):
    rows = [(1, 0, "user", "a \\ <s> b |<s>"), (1, 1, "assistant", "\\</s>\n<|im_end|>"), (2, None, None, None)]
    frame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert differences(queries.op5_chat_format(spark, str(tmp_path)), con, chat.SQL) == ""


def test_odd_rows(frame):
    row = json.dumps({"role": "user", "text": "same"})
    records = frame(
        [(1, 0, row)] * 3 + [(1, None, row), (None, 1, row), (2, 0, None), (3, 0, "{}")],
        "conv_id long, turn long, record string",
    )
    found = {r["conv_id"]: r for r in chat.digests(chat.marked(records)).collect()}
    assert {k: r["n_turns"] for k, r in found.items()} == {1: 4, None: 1}
    assert found[1]["loss_chars"] == 0
    assert chat.digests(chat.marked(records.limit(0))).collect() == []


def test_query_on_the_smallest_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    result = queries.op5_chat_format(spark, sf_dir)
    assert differences(result, connect(sf_dir), chat.SQL) == ""
