from __future__ import annotations

import random
from itertools import combinations

import pytest

from lodespark.llm import minhash
from lodespark.llm.components import connected_components
from tests.llm.conftest import ODD_TEXTS


def united(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, width):
    words = tuple((text or "").encode().lower().split())
    if not words:
        return set()
    return {words[n : n + width] for n in range(max(1, len(words) - width + 1))}


def brute_force(rows, width, percent):
    sets = {doc_id: shingles(text, width) for doc_id, text in rows}
    links = [
        (a, b)
        for a, b in combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    component = united(sets, links)
    return {(d, len(sets[d]), component[d], component[d] == d) for d in sets}


def family(rng, words, edits, copies):
    """Copies of a text with a few words changed, at similarities around the limit."""
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randrange(edits)):
            text[rng.randrange(words)] = f"v{rng.randrange(10_000)}"
        yield " ".join(text)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    texts = [t for size in (12, 40, 90) for t in family(rng, size, max(3, size // 7), 25)]
    texts += ["Exact  copy of\ta text"] * 6 + ["exact copy OF a text", "exact copy of a longer text"]
    texts += [f"only number {n} here" for n in range(5)] + ODD_TEXTS
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


@pytest.mark.parametrize("width", [2, 5])
@pytest.mark.parametrize("rounds", [0, 3])
def test_links_every_pair(frame, corpus, monkeypatch, width, rounds):
    monkeypatch.setattr(minhash, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(minhash, "CHUNK", 4)
    monkeypatch.setattr(minhash, "LARGE_BAND", 8 if width == 2 else 1000)
    monkeypatch.setattr(minhash, "SALT", 3)
    monkeypatch.setattr(minhash, "SENT_IDS", 0 if rounds else 1000)
    docs = frame([(*r, 1) for r in corpus], "doc_id long, text string, kept int")
    found = minhash.link(docs, width, 80).collect()
    assert {tuple(r) for r in found} == brute_force(corpus, width, 80)
    assert len(found) == len(corpus)


def test_repeated_and_missing_ids(frame):
    rows = [(4, "a b c d"), (4, "a b c d"), (9, "a b c d"), (None, "a b c d"), (4, "x y"), (2, None)]
    found = minhash.link(frame(rows, "doc_id long, text string"), 2, 80).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(
        map(str, [(4, 3, 4, True)] * 2 + [(9, 3, 4, False), (None, 3, None, True), (4, 1, 4, True), (2, 0, 2, True)])
    )


@pytest.mark.parametrize("seed", range(3))
def test_texts_of_one_id_are_linked(frame, seed):
    rng = random.Random(seed)
    a, b = (" ".join(f"{rng.randrange(10**9)}" for _ in range(40)) for _ in range(2))
    rows = [(4, a), (4, b), (9, b), (7, b + " more"), (12, a + " more"), (12, "z"), (2, "z"), (3, "apart")] + [(4, a)] * 3
    rng.shuffle(rows)
    found = {(r["doc_id"], r["component_id"]) for r in minhash.link(frame(rows, "doc_id long, text string"), 5, 80).collect()}
    assert found == {(4, 2), (9, 2), (7, 2), (12, 2), (2, 2), (3, 3)}


def test_empty_table(frame):
    assert minhash.link(frame([], "doc_id long, text string")).collect() == []


def test_components(frame):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    links += [(500 + n, 501 + n) for n in range(40)] + [(900, 900 + n) for n in range(60)]
    nodes = {n for link in links for n in link if link[0] != link[1]}
    found = connected_components(frame(links, "u long, v long")).collect()
    assert dict(map(tuple, found)) == united(nodes, [x for x in links if x[0] != x[1]])
    assert connected_components(frame([], "u long, v long")).collect() == []
