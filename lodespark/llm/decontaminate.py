"""Benchmark passages in documents, found with a suffix automaton of the test items.

Items and documents are normalised alike: A-Z in lower case, words of ``[0-9a-z]`` and all
characters beyond ASCII. The automaton holds every run of words of every item in a number of
states that follows the words of the items. A document is streamed through it, word by word;
the state and the length of the longest match tell at each word whether one of the windows ends
there, and which items hold it.

Defined cases: a null text has no words; an item without words has no window; items that repeat an
id count as one; an item with a null id hits words but is not listed. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodespark.llm.words import groups, tidied
from lodespark.staging import spread, stage

WINDOW = 13
# Words of items in one automaton, which every Python worker holds; more items make several
# automata, through which the documents go one after the other.
AUTOMATON_WORDS = 100_000

# The same words in a text as it is: letters of both cases.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def plain(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.lower().translate(_LETTERS).split()


class Automaton:
    """Generalised suffix automaton over words, with the items of each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, self.words.setdefault(word, len(self.words)))
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, int] = {}
        self.least = window
        for name, words in items:
            if words:
                self._mark(name, [self.words[w] for w in words])

    @classmethod
    def restored(cls, parts: dict) -> Automaton:
        automaton = cls.__new__(cls)
        automaton.__dict__.update(parts)
        return automaton

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, target: int, word: int) -> int:
        """The state for the run through ``state``, which is shorter than those of ``target``."""
        clone = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, known, word)
        new, state = self._state(self.length[last] + 1, 0, {}), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            if self.length[target] != self.length[state] + 1:
                target = self._split(state, target, word)
            self.link[new] = target
        return new

    def _mark(self, name: str | None, words: list[int]) -> None:
        """Note the item at the states of its windows."""
        span = min(self.window, len(words))
        self.least = min(self.least, span)
        state = matched = 0
        for word in words:
            state, matched = self.step(state, matched, word)
            if matched >= span:
                at = self.state_of(state, span)
                found = self.items.setdefault(at, set())
                if name is not None:
                    found.add(name)
                if span < self.window:
                    self.short[at] = span

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """Longest match after one more word."""
        while state and word not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        following = self.next[state].get(word)
        return (0, 0) if following is None else (following, matched + 1)

    def state_of(self, state: int, span: int) -> int:
        """State of the last ``span`` words of a match."""
        while self.length[self.link[state]] >= span:
            state = self.link[state]
        return state

    def windows(self, state: int, matched: int) -> list[tuple[int, int]]:
        """Length and state of the windows that end where a match ends."""
        found = []
        if matched >= self.window:
            found.append((self.window, self.state_of(state, self.window)))
        while state > 0 and self.short:
            span = self.short.get(state)
            if span is not None and matched >= span:
                found.append((span, state))
            state = self.link[state]
            matched = self.length[state]
        return [f for f in found if f[1] in self.items]

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Disjoint spans of hit words in order, and the items of the windows found."""
        known = list(map(self.words.get, words))
        unknown = np.fromiter((k is None for k in known), bool, len(known))
        breaks = np.concatenate([[-1], np.flatnonzero(unknown), [len(known)]])
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for n in np.flatnonzero(np.diff(breaks) > self.least).tolist():
            state = matched = 0
            for at in range(breaks[n] + 1, breaks[n + 1]):
                state, matched = self.step(state, matched, known[at])
                if matched < self.least:
                    continue
                for span, window in self.windows(state, matched):
                    items |= self.items[window]
                    low = at + 1 - span
                    while spans and spans[-1][1] >= low:
                        low = min(low, spans.pop()[0])
                    spans.append((low, at + 1))
        return spans, items


def _automata(benchmark: DataFrame, window: int) -> Iterator[Automaton]:
    """Automata of bounded size that together hold all items."""
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    gathered: list[tuple[str | None, list[bytes]]] = []
    size = 0
    for row in items.toLocalIterator():
        words = plain(row["text"].encode())
        if gathered and size + len(words) > AUTOMATON_WORDS:
            yield Automaton(gathered, window)
            gathered, size = [], 0
        gathered.append((row["item_id"], words))
        size += len(words)
    if gathered:
        yield Automaton(gathered, window)


SPANS = "array<struct<start: int, end: int>>"
SPANS_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _scan(docs: DataFrame, automaton: Automaton, with_text: bool = False) -> DataFrame:
    """``docs`` with n_words, spans (word positions) and items found by one automaton."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(automaton))  # plain data, no class

    @tidied
    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Automaton.restored(sent.value)
        for batch in batches:
            counts, spans, items = [], [], []
            for _, texts in groups(batch):
                for text in texts:
                    words = plain(text)
                    found, names = own.spans(words)
                    counts.append(len(words))
                    spans.append([{"start": a, "end": b} for a, b in found])
                    items.append(sorted(names))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in keep),
                    pa.array(counts, pa.int64()),
                    pa.array(spans, SPANS_TYPE),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=[*keep, "n_words", "spans", "items"],
            )

    keep = [c for c in docs.columns if with_text or c != "text"]
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name in keep)
    return docs.mapInArrow(scanned, f"{kept}n_words long, spans {SPANS}, items array<string>")


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, spans of hit words, sorted items; the text if asked for.

    One pass over the documents for each automaton. Several passes are put together by
    a row number that is written with the documents first.
    """
    docs = spread(docs.select("doc_id", "text"))
    automata = _automata(benchmark, window)
    first = next(automata, Automaton([], window))
    second = next(automata, None)
    if second is None:
        return _scan(docs, first, with_text)
    numbered = stage(docs.withColumn("row", F.monotonically_increasing_id()))
    parts = [stage(_scan(numbered, first, with_text)), stage(_scan(numbered, second))]
    parts += [stage(_scan(numbered, more)) for more in automata]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    merged = every.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        *([F.first("text", ignorenulls=True).alias("text")] if with_text else []),
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("all"),  # a row for each automaton
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    text = ["text"] if with_text else []
    return merged.select("doc_id", *text, "n_words", _united(F.col("all")).alias("spans"), "items")


def _united(spans):
    """Sorted spans without overlaps."""

    def add(done, span):
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end")
        )
        return F.when(
            last["end"] >= span["start"],
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer)),
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, F.array().cast(SPANS), add)


def judged(found: DataFrame, share: int = 20) -> DataFrame:
    """Add n_hit and ``contaminated``: a hit, and at least one word in ``share`` is hit."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))
    )


def cut_spans(text: str | None, spans: list[tuple[int, int]], longest: int) -> str:
    """The text without the hit spans of more than ``longest`` words, which become a space."""
    kept, at = [], 0
    matches = list(WORD.finditer(text or ""))
    for low, high in spans:
        if high - low > longest:
            kept.append((text or "")[at : matches[low].start()])
            at = matches[high - 1].end()
    return " ".join([*kept, (text or "")[at:]])


def removed(docs: DataFrame, benchmark: DataFrame, longest: int = 0, share: int = 20) -> DataFrame:
    """``doc_id, text, contaminated``: the text without hit spans of over ``longest`` words.

    A document of which one word in ``share`` is hit is marked, to be left out as a whole.
    """
    found = judged(hits(docs, benchmark, with_text=True), share)

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            texts = [
                cut_spans(r["text"], [(s["start"], s["end"]) for s in r["spans"]], longest)
                for r in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(texts, pa.string()), batch["contaminated"]],
                names=["doc_id", "text", "contaminated"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "text", "spans", "contaminated").mapInArrow(
        cleaned, f"doc_id {kind}, text string, contaminated boolean"
    )
