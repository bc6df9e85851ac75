from __future__ import annotations

import random
from functools import lru_cache

from lodespark.llm import queries, tokencount
from tests.llm.conftest import ODD_TEXTS


def brute_force(scores):
    byte = min(scores.values()) - tokencount.BYTE_PENALTY

    @lru_cache(None)
    def best(word):
        """Largest (score, minus tokens) over all segmentations."""
        if not word:
            return 0.0, 0
        found = []
        for end in range(1, len(word) + 1):
            if word[:end] in scores:
                found.append((scores[word[:end]], 1, word[end:]))
        if word[0] not in scores:
            size = len(word[0].encode())
            found.append((size * byte, size, word[1:]))
        results = [(round(s + best(rest)[0], 9), best(rest)[1] - n) for s, n, rest in found]
        return max(results)

    return lambda word: -best(word)[1]


def test_counts_like_all_segmentations():
    rng = random.Random(5)
    pieces = ["▁", "a", "b", "ab", "ba", "aab", "▁a", "▁ab", "bb", "abab"]
    scores = {p: -float(rng.randrange(1, 60)) for p in pieces}
    count = brute_force(scores)
    counter = tokencount.Counter(scores)
    words = ["▁" + "".join(rng.choices("abcé", k=rng.randrange(1, 9))) for _ in range(500)]
    for word in [*words, *sorted(words)]:
        assert counter.count(word) == count(word), word


def test_rows(frame, monkeypatch):
    scores = queries.unigram_scores()
    texts = [*ODD_TEXTS, "the cat the catalogue"]
    docs = frame([(n, t, "x") for n, t in enumerate(texts)], "doc_id long, text string, n_words string")
    counter = tokencount.Counter(scores)
    for memo in (tokencount.MEMO, 1):
        monkeypatch.setattr(tokencount, "MEMO", memo)
        found = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in tokencount.counts(docs, scores).collect()}
        for n, text in enumerate(texts):
            words = (text or "").encode().split()
            tokens = sum(counter.count(tokencount.SPACE + w.decode()) for w in words)
            assert found[n] == (len(words), tokens)
    assert tokencount.counts(docs.limit(0), scores).collect() == []
