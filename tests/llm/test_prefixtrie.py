from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from lodespark.llm import lookup, prefixtrie, queries
from tests.compare import connect, differences
from tests.llm.conftest import ODD_TEXTS

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (conv % 20 if conv >= 0 else -(-conv % 20))
        out[conv] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, inside in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(inside) - 1) * words
            leaves[node[:d]] += not children[node]
    return sorted(
        (
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), children[node],
            leaves[node], saved[node], hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, inside in members.items()
    )


def nodes(df):
    found = prefixtrie.trie(df).collect()
    return found, sorted(tuple(r)[:8] for r in found)


def forest(seed=1, convs=120):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-60, 300), convs):
        for turn in range(rng.randrange(1, 7)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "a b", "", "c d e"])))
    return rows


def test_against_brute_force(frame):
    rows = forest()
    found, told = nodes(frame(rows, SCHEMA).repartition(5))
    assert told == brute(rows)
    stored = defaultdict(list)
    for conv, turn, role, text in sorted(rows):
        stored[conv].append((role, text))
    convs = rebuilt(rows)
    for r in found:
        if r["depth"]:
            turn = stored[r["turn_conv_id"]][r["turn_position"] - 1]
            assert turn == convs[r["conv_id"]][r["depth"] - 1]


def test_odd_rows(frame):
    rows = [(n % 7 * 20 + n, n, None if n % 3 else "user", t) for n, t in enumerate(ODD_TEXTS)]
    rows += [(40, None, "b", "y"), (40, None, "a", "x"), (40, None, "b", "y"), (40, 3, None, None)]
    rows += [(41, 2, "ro", "le"), (42, 2, "r", "ole"), (43, 2, "ro", "le"), (None, 1, "user", "lost"), (2**62, 1, "a", "b")]
    rows += [(-3, 1, "a", "b"), (59, 1, "a", None), (59, 2, "a", "")]
    df = frame(rows, SCHEMA).withColumns({"a": F.lit(1), "words": F.lit("x"), "_part": F.lit(0), "e": F.lit(1)})
    assert nodes(df)[1] == brute(rows)


def test_empty_table(frame):
    assert nodes(frame([], SCHEMA))[1] == []
    assert nodes(frame([(None, 1, "a", "b")], SCHEMA))[1] == []


def test_turnless(frame):
    rows = [(40 * n + n % 20, 1, "a", "b") for n in range(30)]
    assert not all(rebuilt(rows).values())
    assert nodes(frame(rows, SCHEMA))[1] == brute(rows)
    rows = [row for row in rows if not rebuilt(rows)[row[0]]]
    assert nodes(frame(rows, SCHEMA))[1] == brute(rows)


def test_a_long_conversation_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "SPLIT", 16)
    monkeypatch.setattr(prefixtrie, "CHUNK", 50)
    monkeypatch.setattr(lookup, "SHARE", 5)
    rows = [(5, n, "a", f"t{n % 3}") for n in range(400)] + [(7, n, "a", f"t{n % 3}") for n in range(350)]
    rows += [(100 + n, 0, "user", "same words here") for n in range(300)]
    rows += [(100 + n, 1, "user", f"{n % 4}") for n in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(9)
    assert nodes(df)[1] == brute(rows)


def test_another_seed_after_a_collision(frame, monkeypatch):
    tried = []
    real = prefixtrie.stored_turns

    def colliding(conversations, seed):
        tried.append(seed)
        turns = real(conversations, seed)
        return turns.withColumns({"e": F.lit(1).cast("long"), "f": F.lit(2).cast("long")}) if seed == 0 else turns

    monkeypatch.setattr(prefixtrie, "stored_turns", colliding)
    rows = forest(2, 30)
    assert nodes(frame(rows, SCHEMA))[1] == brute(rows)
    assert tried == [0, 1]


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert differences(queries.op11_prefix_trie(spark, sf_dir), connect(sf_dir), prefixtrie.SQL) == ""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    found = queries.op11_prefix_trie(spark, sf_dir)
    assert sorted(map(tuple, found.collect())) == brute(rows)
