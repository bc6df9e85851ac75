from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodespark.llm import eliasfano, ngramlm, queries
from tests.llm.conftest import ODD_TEXTS


class BruteForce:
    def __init__(self, texts):
        self.words, self.pairs, self.followers = Counter(), Counter(), defaultdict(set)
        for text in texts:
            tokens = self.tokens(text)
            self.words.update(tokens)
            for pair in zip([b"", *tokens], tokens):
                self.pairs[pair] += 1
                self.followers[pair[0]].add(pair[1])
        self.total, self.size = sum(self.words.values()), len(self.words)

    @staticmethod
    def tokens(text):
        return [*(text or "").encode().lower().split(), b""]

    def single(self, word):
        return (self.words[word] + 1) / (self.total + self.size + 1)

    def scores(self, text):
        tokens = self.tokens(text)
        base = sum(math.log10(self.single(w)) for w in tokens)
        score = 0.0
        for before, word in zip([b"", *tokens], tokens):
            types = len(self.followers[before])
            chance = self.single(word)
            if types:
                chance = (self.pairs[before, word] + types * chance) / (self.words[before] + types)
            score += math.log10(chance)
        return len(tokens), sum(w in self.words for w in tokens), base, score


def check(rows, model, brute):
    for doc_id, text, n_tokens, n_known, base, score in rows:
        tokens, known, base_, score_ = brute.scores(text)
        assert (n_tokens, n_known) == (tokens, known)
        assert base == pytest.approx(base_, rel=1e-9, abs=1e-9)
        assert abs(score - score_) <= tokens * 1.1 * ngramlm.QUANTUM + 1e-9, text


@pytest.mark.parametrize("gathered", [ngramlm.GATHERED, 5])
def test_like_brute_force(frame, monkeypatch, gathered):
    monkeypatch.setattr(ngramlm, "GATHERED", gathered)
    rng = random.Random(3)
    texts = [" ".join(rng.choice("aabcdEfgh") + rng.choice("xyyY") for _ in range(rng.randrange(30))) for _ in range(200)]
    texts += ODD_TEXTS + ["the the the the " * 50]
    train, test = texts[:-60], texts
    model = ngramlm.fit(frame([(t, 1) for t in train], "text string, n int"))
    brute = BruteForce(train)
    assert (model.tokens, model.vocabulary) == (brute.total, brute.size)
    docs = frame([(n, t, 0.5) for n, t in enumerate(test)], "doc_id long, text string, score double")
    rows = [
        (r["doc_id"], test[r["doc_id"]], r["n_tokens"], r["n_known"], r["base_score"], r["score"])
        for r in ngramlm.score(docs, model).collect()
    ]
    assert len(rows) == len(test)
    check(rows, model, brute)


@pytest.mark.parametrize("scored", [1, 1 << 22])
def test_texts_are_scored_together(frame, monkeypatch, scored):
    """A text scores the same whatever is scored with it."""
    monkeypatch.setattr(ngramlm, "SCORED", scored)
    train = ["a b a c", "b a", "", "c c b"]
    model, brute = ngramlm.fit(frame([(t,) for t in train], "text string")), BruteForce(train)
    test = ["b a c", "", "a unseen b", "c", "unseen unseen"]
    docs = frame(list(enumerate(test)), "doc_id long, text string").coalesce(1)
    rows = [(r[0], test[r[0]], *r[1:]) for r in ngramlm.score(docs, model).collect()]
    assert len(rows) == len(test)
    check(rows, model, brute)


class BruteForceOfThree(BruteForce):
    def __init__(self, texts):
        super().__init__(texts)
        self.triples, self.behind = Counter(), defaultdict(Counter)
        for text in texts:
            tokens = [b"", *self.tokens(text)]
            for a, b, c in zip(tokens, tokens[1:], tokens[2:]):
                self.triples[a, b, c] += 1
                self.behind[a, b][c] += 1

    def chance(self, before, word):
        types, chance = len(self.followers[before]), self.single(word)
        if types:
            chance = (self.pairs[before, word] + types * chance) / (self.words[before] + types)
        return chance

    def scores(self, text):
        tokens = [b"", *self.tokens(text)]
        score = 0.0
        for n, word in enumerate(tokens[1:], 1):
            chance = self.chance(tokens[n - 1], word)
            behind = self.behind.get((tokens[n - 2], tokens[n - 1])) if n > 1 else None
            if behind:
                chance = (behind[word] + len(behind) * chance) / (behind.total() + len(behind))
            score += math.log10(chance)
        return *super().scores(text)[:3], score


@pytest.mark.parametrize("gathered, scored", [(ngramlm.GATHERED, ngramlm.SCORED), (5, 1)])
def test_third_level_like_brute_force(frame, monkeypatch, gathered, scored):
    monkeypatch.setattr(ngramlm, "GATHERED", gathered)
    monkeypatch.setattr(ngramlm, "SCORED", scored)
    rng = random.Random(5)
    texts = [" ".join(rng.choice("aabcdE") + rng.choice("xyyY") for _ in range(rng.randrange(30))) for _ in range(200)]
    texts += ODD_TEXTS + ["the the the the " * 100, "ax", "", "unseen ax bx"]
    train, test = texts[:-60], texts
    model, brute = ngramlm.fit(frame([(t,) for t in train], "text string"), order=3), BruteForceOfThree(train)
    docs = frame(list(enumerate(test)), "doc_id long, text string").coalesce(2)
    rows = [(r[0], test[r[0]], *r[1:]) for r in ngramlm.score(docs, model).collect()]
    assert len(rows) == len(test)
    check(rows, model, brute)


def test_third_level_without_training_rows(frame):
    model = ngramlm.fit(frame([], "text string"), order=3)
    docs = frame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = {tuple(r) for r in ngramlm.score(docs, model).collect()}
    assert found == {(1, 3, 0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0)}


def test_the_query_has_three_levels(spark, monkeypatch):
    orders = []
    fit = ngramlm.fit
    monkeypatch.setattr(ngramlm, "fit", lambda docs, order=2: orders.append(order) or fit(docs, order))
    queries.op10_lm_scores(spark, "/root/testdata/sf0.001")
    assert orders == [3]


def test_probabilities_sum_to_one(frame):
    model = ngramlm.fit(frame([("a b a c",), ("b a",)], "text string"))
    words = ["a", "b", "c", "unseen"]
    docs = frame([(n, w) for n, w in enumerate([f"a {w}" for w in words] + ["a"])], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in ngramlm.score(docs, model).collect()}
    # P(w | a) = P(a w end) / P(a) / P(end | w), so compare with the brute force instead.
    brute = BruteForce(["a b a c", "b a"])
    assert sum(brute.scores(f"a {w}")[3] for w in words) == pytest.approx(
        sum(scores[n] for n in range(4)), abs=0.01
    )


def test_without_training_rows(frame):
    model = ngramlm.fit(frame([], "text string"))
    docs = frame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = {tuple(r) for r in ngramlm.score(docs, model).collect()}
    assert found == {(1, 3, 0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0)}
    assert ngramlm.score(docs.limit(0), model).collect() == []


def test_better_than_single_words_on_held_out_texts(spark):
    rows = queries.op10_lm_scores(spark, "/root/testdata/sf0.001").where("held_out").collect()
    assert rows and sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


@pytest.mark.parametrize("size, span", [(0, 9), (1, 2**62), (5, 6), (3000, 2**62), (3000, 2**20), (3000, 3500)])
def test_sequences(tmp_path, size, span):
    rng = np.random.default_rng(size)
    values = np.unique(rng.integers(0, span, size, dtype=np.uint64))
    eliasfano.write(f"{tmp_path}/s", values)
    sequence = eliasfano.Sequence(f"{tmp_path}/s")
    assert (sequence.values() == values).all()
    keys = np.concatenate([values, values + np.uint64(1), rng.integers(0, 2**63, 500, dtype=np.uint64)])
    place = {int(v): n for n, v in enumerate(values)}
    assert sequence.find(keys).tolist() == [place.get(int(k), -1) for k in keys]


@pytest.mark.parametrize("count, most, span", [(1, 0, 9), (4, 3, 5), (50, 40, 2**31), (3000, 3, 2**31), (3000, 2, 3)])
def test_runs(tmp_path, count, most, span):
    """Pointers lead to each run, empty ones among them."""
    rng = np.random.default_rng(count)
    held = [np.unique(rng.integers(0, span, rng.integers(0, most + 1))) for _ in range(count)]
    runs, values = np.repeat(np.arange(count), [len(h) for h in held]), np.concatenate(held).astype(np.int64)
    eliasfano.write_runs(f"{tmp_path}/r", runs, values, count)
    read = eliasfano.Runs(f"{tmp_path}/r")
    assert [a.tolist() for a in read.all()] == [runs.tolist(), values.tolist()]
    place = {(int(r), int(v)): n for n, (r, v) in enumerate(zip(runs, values))}
    asked = np.concatenate([runs, runs, rng.integers(0, count, 500)])
    wanted = np.concatenate([values, values + 1, rng.integers(0, span, 500)])
    at, sizes = read.find(asked, wanted)
    assert at.tolist() == [place.get((int(r), int(v)), -1) for r, v in zip(asked, wanted)]
    assert sizes.tolist() == [len(held[r]) for r in asked]
