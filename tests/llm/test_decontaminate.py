from __future__ import annotations

import random
import re

import pytest

from lodespark.llm import decontaminate
from tests.llm.conftest import ODD_TEXTS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({n: n + 32 for n in range(65, 91)}))


def brute_force(text, items, window):
    own = words(text)
    hit, names = set(), set()
    for name, item in items:
        parts = words(item)
        span = min(window, len(parts))
        runs = {tuple(parts[n : n + span]) for n in range(len(parts) - span + 1)} if parts else set()
        for n in range(len(own) - span + 1):
            if tuple(own[n : n + span]) in runs:
                hit |= set(range(n, n + span))
                names |= {str(name)} if name is not None else set()
    return len(own), hit, sorted(names)


@pytest.fixture
def corpus():
    rng = random.Random(6)
    letters = "abcdé1"
    some = lambda n: " ".join(rng.choice(letters) for _ in range(n))
    items = [(n, some(rng.randrange(1, 9))) for n in range(12)]
    items += [(3, "a b, a-b A B a b"), (50, None), (51, ""), (None, "z z z z z"), (52, "x " * 60)]
    docs = [some(rng.randrange(0, 40)) for _ in range(80)] + ODD_TEXTS
    docs += [f"pre {items[n][1]} post" for n in range(12)] + ["z z z z z z", "x " * 200]
    return list(enumerate(docs)), items


@pytest.mark.parametrize("window, bound", [(4, 100_000), (4, 10), (13, 100_000)])
def test_hits(frame, corpus, monkeypatch, window, bound):
    monkeypatch.setattr(decontaminate, "AUTOMATON_WORDS", bound)
    docs, items = corpus
    found = decontaminate.judged(
        decontaminate.hits(
            frame([(*d, 1) for d in docs], "doc_id long, text string, n_words int"),
            frame(items, "item_id long, text string"),
            window,
        )
    ).collect()
    assert len(found) == len(docs)
    text = dict(docs)
    for row in found:
        n_words, hit, names = brute_force(text[row["doc_id"]], items, window)
        spans = [n for s in row["spans"] for n in range(s["start"], s["end"])]
        assert (row["n_words"], spans, row["items"]) == (n_words, sorted(hit), names)
        assert row["n_hit"] == len(hit)
        assert row["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= n_words)


def test_removed(frame):
    item = " ".join(f"w{n}" for n in range(20))
    docs = frame(
        [(1, f"Before, {item.upper()}! After."), (2, "clean"), (3, None), (1, "clean")],
        "doc_id long, text string",
    )
    bench = frame([(1, item)], "item_id long, text string")
    found = sorted(map(tuple, decontaminate.removed(docs, bench).collect()))
    assert found == [(1, "Before,  ! After.", True), (1, "clean", False), (2, "clean", False), (3, "", False)]
    untouched = decontaminate.removed(docs, bench, longest=20).where("doc_id = 2 or text like '%w%'")
    assert untouched.count() == 1


def test_empty_tables(frame):
    docs = frame([(1, "a b"), (2, None)], "doc_id long, text string")
    bench = frame([(1, "a b")], "item_id long, text string")
    assert decontaminate.hits(docs.limit(0), bench).collect() == []
    assert {r["doc_id"]: r["spans"] for r in decontaminate.hits(docs, bench.limit(0)).collect()} == {1: [], 2: []}
