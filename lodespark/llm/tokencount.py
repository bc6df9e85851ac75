"""Token counts of a unigram vocabulary by dynamic programming shared along a trie.

A word is segmented into the pieces with the largest sum of scores. The best score of a prefix does
not depend on what follows, so the distinct words of a task are put into a trie and each
prefix is scored once, from the prefixes above it; the counts at the ends of words are kept, and a
document adds up those of its words.

Words are ``[^\\x20\\x09-\\x0D]+``, each behind a mark for the space before it. A character that is
in no piece counts a token for each of its bytes, at a score below that of every piece.
Of equal sums the segmentation with fewer tokens is taken.

Defined cases: a null text has no words and 0 tokens; very long words are segmented but not
remembered. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from lodespark.llm.words import groups
from lodespark.staging import spread

SPACE = "▁"
# Bound on the remembered words of a task; beyond it they are forgotten and counted anew.
MEMO = 500_000
LONG_WORD = 64
# How far the score of a byte lies below the lowest score of a piece.
BYTE_PENALTY = 10.0


def ranked_scores(pieces: list[str]) -> dict[str, float]:
    """Logarithms of probabilities that fall with the rank, from pieces in order of frequency."""
    total = math.log(sum(1 / (rank + 1) for rank in range(len(pieces))))
    return {piece: -math.log(rank + 1) - total for rank, piece in enumerate(pieces)}


class Counter:
    """Numbers of tokens of words, by a walk through the trie of the words.

    The words are visited in order, so that the path from the root to the word before is all of the
    trie that is needed: ``path``, and at each depth the best score and its number of tokens.
    """

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=0)
        self.byte = min(scores.values(), default=0.0) - BYTE_PENALTY
        self.path = ""
        self.best: list[tuple[float, int]] = [(0.0, 0)]  # score, minus the number of tokens

    def count(self, word: str) -> int:
        """Tokens of a word; quickest if it shares a long prefix with the word before."""
        shared = 0
        for a, b in zip(self.path, word):
            if a != b:
                break
            shared += 1
        best = self.best
        del best[shared + 1 :]
        get = self.scores.get
        for end in range(shared + 1, len(word) + 1):
            top = None
            for start in range(max(0, end - self.longest), end):
                score = get(word[start:end])
                if score is not None:
                    above = best[start]
                    found = (above[0] + score, above[1] - 1)
                    if top is None or found > top:
                        top = found
            if word[end - 1] not in self.scores:
                size = len(word[end - 1].encode())
                found = (best[end - 1][0] + size * self.byte, best[end - 1][1] - size)
                if top is None or found > top:
                    top = found
            best.append(top)
        self.path = word
        return -best[len(word)][1]


def counts(docs: DataFrame, scores: dict[str, float]) -> DataFrame:
    """``doc_id, n_words, n_tokens``; ``scores`` is sent with the job, a row for each piece."""
    sent = docs.sparkSession.sparkContext.broadcast(scores)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sent.value)
        known: dict[bytes, int] = {}
        for batch in batches:
            for first, texts in groups(batch):
                words = [text.split() for text in texts]
                new = {w for some in words for w in some if w not in known}
                long = {w: counter.count(SPACE + w.decode()) for w in new if len(w) > LONG_WORD}
                if len(known) > MEMO:
                    known.clear()
                    new = {w for some in words for w in some}
                for word in sorted(new):
                    if len(word) <= LONG_WORD:
                        known[word] = counter.count(SPACE + word.decode())
                tokens = [
                    sum(long[w] if w in long else known[w] for w in some)
                    if long
                    else sum(map(known.__getitem__, some))
                    for some in words
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, len(texts)),
                        pa.array([len(some) for some in words], pa.int64()),
                        pa.array(tokens, pa.int64()),
                    ],
                    names=["doc_id", "n_words", "n_tokens"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return spread(docs.select("doc_id", "text")).mapInArrow(
        counted, f"doc_id {kind}, n_words long, n_tokens long"
    )
