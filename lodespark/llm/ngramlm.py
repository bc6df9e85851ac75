"""An n-gram language model in an Elias-Fano trie, trained and applied on Spark.

Words are known by a 63-bit hash, their number is the rank of the hash. The first level of the trie
holds the hashes with their counts. The second level holds, for every word, the words seen after
it, the third, for every pair, the words seen after that. The successors of a node are a run of
one monotone sequence, and pointers lead from each node to its run, where a successor is
searched. Next to each pair stands its smoothed probability, and for each word the weight of its
unseen successors, both as 16-bit steps of the logarithm. Pairs and triples have their counts;
how many successors a pair has is told by its pointers.

The levels are cut into shards, files in the shared folder which tasks map into memory. The
second level is cut so that each shard gets about the same number of training tokens, in the
middle of a frequent word's successors if need be; the cuts follow from the counts alone. The runs
of the third level lie in the shard of their pair.

Smoothing is that of Witten and Bell: P(w|h) = (c(hw) + T(h) P(w)) / (c(h) + T(h)), where T(h)
counts the distinct successors of h, and P(w) = (c(w) + 1) / (N + V + 1); with order 3, P(w|uh) follows
likewise from c(uhw), c(uh), T(uh) and P(w|h). A text is its words and an end, and starts as if after
an end; what comes before that end tells nothing, so the first token has one word before it.

Defined cases: a null text is empty and has the end only; without training rows every token has
probability 1 / (0 + 0 + 1); rows are trained on as often as they come. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodespark.llm import eliasfano
from lodespark.llm.storage import mapped, new_folder, partitions, replacing
from lodespark.llm.words import WordIds, groups, spaced
from lodespark.staging import spread, stage

# Steps of log10 in which probabilities and weights are kept, from 0 to -32.
QUANTUM = 1 / 2048
# Tokens whose counts a task gathers before it passes them on; half as many with order 3.
GATHERED = 4_000_000
# Bytes of text that are scored together: each shard of the pairs is asked once for all of them.
SCORED = 1 << 22
END = b""  # no word is empty


def quantised(logs: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-logs / QUANTUM), 65535).astype("<u2")


def hashes(ids: WordIds, words: list[bytes]) -> np.ndarray:
    return ids.codes(words) >> np.uint64(1)


@dataclass(frozen=True)
class Level:
    """Shards of a level; ``cuts`` has the first number that a shard can hold, but for the first."""

    folder: str
    cuts: np.ndarray
    base: np.ndarray  # first level: numbers in the shards before; second: whether a shard has pairs
    size: int = 0
    kinds: dict[int, tuple[str, str]] = field(default_factory=dict)  # of counts, by shard

    def shard_of(self, numbers: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, numbers.astype(self.cuts.dtype), side="right")


class Reader:
    """Looks numbers up in the mapped shards of a level."""

    def __init__(self, level: Level):
        self.level, self.open = level, {}

    def shard(self, n: int, keys: str, form: type, *arrays: tuple[str, str]) -> tuple:
        if (keys, n) not in self.open:
            self.open[keys, n] = (
                form(f"{self.level.folder}/{keys}-{n}"),
                *(mapped(f"{self.level.folder}/{name}-{n}", kind) for name, kind in arrays),
            )
        return self.open[keys, n]

    def by_shard(self, numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Number of each shard and the places in ``numbers`` that fall to it."""
        shards = self.level.shard_of(numbers)
        order = np.argsort(shards, kind="stable")
        starts = np.flatnonzero(np.diff(shards[order], prepend=-1))
        for low, high in zip(starts, [*starts[1:], len(order)]):
            yield int(shards[order[low]]), order[low:high]


class Words(Reader):
    """First level: number and count of a word by its hash."""

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        numbers = np.full(len(wanted), -1, np.int64)
        counts = np.zeros(len(wanted), np.int64)
        if not len(self.level.base):
            return numbers, counts
        for n, places in self.by_shard(wanted):
            keys, own = self.shard(n, "keys", eliasfano.Sequence, ("counts", "<i8"))
            at = keys.find(wanted[places])
            there = at >= 0
            numbers[places[there]] = at[there] + self.level.base[n]
            counts[places[there]] = own[at[there]]
        return numbers, counts


class WordCounts:
    """Counts by the numbers of words."""

    def __init__(self, words: Level):
        self.words = words
        self.open: dict[int, np.ndarray] = {}

    def find(self, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(numbers), np.int64)
        shards = np.searchsorted(self.words.base, numbers, side="right") - 1
        for n in np.unique(shards).tolist():
            if n not in self.open:
                self.open[n] = mapped(f"{self.words.folder}/counts-{n}", "<i8")
            places = np.flatnonzero(shards == n)
            out[places] = self.open[n][numbers[places] - self.words.base[n]]
        return out


class Vocabulary:
    """Numbers and counts for the words of a task, each looked up once."""

    def __init__(self, level: Level):
        self.ids, self.words = WordIds(), Words(level)
        self.numbers = self.counts = np.empty(0, np.int64)

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """Places of the words in ``numbers`` and ``counts``."""
        places = self.ids.number(words)
        if len(self.numbers) < len(self.ids):
            new = self.ids.hashes[len(self.numbers) : len(self.ids)] >> np.uint64(1)
            numbers, counts = self.words.find(new)
            self.numbers = np.concatenate([self.numbers, numbers])
            self.counts = np.concatenate([self.counts, counts])
        return places

    def numbers_of(self, words: list[bytes]) -> np.ndarray:
        places = self.look_up(words)
        return self.numbers[places]

    def trim(self) -> None:
        self.ids.trim()
        if not self.ids:
            self.numbers = self.counts = np.empty(0, np.int64)


@dataclass(frozen=True)
class Model:
    words: Level
    pairs: Level
    tokens: int
    vocabulary: int
    order: int = 2


def _columns(batches: Iterator[pa.RecordBatch], n: int) -> list[np.ndarray]:
    """The first ``n`` columns of all batches, which together are one shard."""
    parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns[:n]] for b in batches]
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.int64)] * n


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their summed counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts[order], first, dtype=np.int64)


def _gathered(
    batches: Iterator[pa.RecordBatch], number, most: int
) -> Iterator[np.ndarray]:
    """Numbers of about ``most`` tokens at a time; ``number`` makes them from texts."""
    keys: list[np.ndarray] = []
    size = 0
    for batch in batches:
        for _, texts in groups(batch):
            keys.append(number(texts))
            size += keys[-1].shape[-1]
            if size >= most:
                yield np.concatenate(keys, axis=-1)
                keys, size = [], 0
    if keys:
        yield np.concatenate(keys, axis=-1)


def _planes(values: np.ndarray) -> bytes:
    """Numbers as all their first bytes, then all their second ones and so on, which pack well."""
    return values.view("u1").reshape(len(values), -1).T.tobytes()


def _from_planes(data: bytes, kind: str, size: int, start: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    bytes_ = np.frombuffer(data, "u1", size * width, start).reshape(width, size)
    return np.ascontiguousarray(bytes_.T).view(kind).ravel()


def _packed(keys: np.ndarray, thirds: np.ndarray, counts: np.ndarray) -> bytes:
    steps = np.diff(keys, prepend=0)
    return b"".join(map(_planes, (steps.astype("<i8"), thirds.astype("<i4"), counts.astype("<i4"))))


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = len(data) // 16
    steps, thirds, counts = (
        _from_planes(data, kind, size, size * start)
        for kind, start in (("<i8", 0), ("<i4", 8), ("<i4", 12))
    )
    return np.cumsum(steps), thirds, counts


def _write_counts(path: str, counts: np.ndarray) -> str:
    """Write counts as the smallest numbers that hold them, and tell which."""
    kind = np.min_scalar_type(int(counts.max(initial=0))).newbyteorder("<")
    with replacing(path) as out:
        out.write(counts.astype(kind).tobytes())
    return kind.str


def _sequence(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words with an end behind each text, and the places of the ends."""
    words: list[bytes] = []
    ends = []
    for text in texts:
        words += spaced(text)
        ends.append(len(words))
        words.append(END)
    return words, np.array(ends, np.int64)


def _count_words(docs: DataFrame) -> DataFrame:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()

        def number(texts: list[bytes]) -> np.ndarray:
            ids.trim()
            return hashes(ids, _sequence(texts)[0]).astype(np.int64)

        for tokens in _gathered(batches, number, GATHERED):
            keys, counts = np.unique(tokens, return_counts=True)
            yield pa.RecordBatch.from_pydict({"key": keys, "n": counts})

    return docs.mapInArrow(counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _build_words(docs: DataFrame, folder: str) -> tuple[Level, int]:
    """Write the first level; the level, and the number of training tokens."""

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, shards = _columns(batches, 3)
        if len(keys):
            shard = int(shards[0])
            eliasfano.write(f"{folder}/keys-{shard}", keys.astype(np.uint64))
            with replacing(f"{folder}/counts-{shard}") as out:
                out.write(counts.astype("<i8").tobytes())
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "low": keys[:1], "n": [len(keys)], "tokens": [counts.sum()]}
            )

    counted = stage(_count_words(docs))
    dealt = counted.repartitionByRange(partitions(counted), "key").sortWithinPartitions("key")
    index = stage(
        dealt.withColumn("shard", F.spark_partition_id().cast("long")).mapInArrow(
            built, "shard long, low long, n long, tokens long"
        )
    )
    # A row for each shard.
    rows = sorted(index.collect(), key=lambda r: r["shard"])
    sizes = np.zeros(rows[-1]["shard"] + 1 if rows else 0, np.int64)
    lows = np.zeros(len(sizes), np.int64)
    for row in rows:
        sizes[row["shard"]], lows[row["shard"]] = row["n"], row["low"]
    for n in range(len(lows) - 2, -1, -1):  # a shard without words starts where the next does
        lows[n] = lows[n] if sizes[n] else lows[n + 1]
    level = Level(folder, lows[1:].astype(np.uint64), np.cumsum(sizes) - sizes, int(sizes.sum()))
    return level, sum(r["tokens"] for r in rows)


def _pair_cuts(words: Level, shards: int, vocabulary: int, tokens: int, docs: DataFrame) -> np.ndarray:
    """First pair number of each shard but the first, so that each has as many tokens before it.

    Each token of training is one pair, in the run of the word before; within a run the
    second words are taken to be spread evenly.
    """
    spark = docs.sparkSession
    n_words = len(words.base)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n in (row for batch in batches for row in batch["id"].to_pylist()):
            if len(counts := _counts(words, n)):
                yield pa.RecordBatch.from_pydict({"id": [n], "tokens": [int(counts.sum())]})

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, before in (
            row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))
        ):
            ends = before + np.cumsum(_counts(words, n))
            low = -(-before * shards // tokens)
            high = -(-int(ends[-1]) * shards // tokens)
            wanted = np.arange(max(1, low), min(shards, high))
            goal = wanted * tokens // shards
            at = np.searchsorted(ends, goal, side="right")
            at = np.minimum(at, len(ends) - 1)
            start = np.concatenate([[before], ends])[at]
            count = ends[at] - start
            second = ((goal - start) / count * vocabulary).astype(np.int64)
            first = words.base[n] + at
            yield pa.RecordBatch.from_pydict({"cut": first * vocabulary + second})

    each = spark.range(0, n_words, 1, max(1, n_words))
    before = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    sums = each.mapInArrow(totals, "id long, tokens long")  # a row for each shard
    placed = sums.select("id", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))
    rows = placed.repartitionByRange(max(1, n_words), "id").mapInArrow(cuts, "cut long").collect()
    return np.sort(np.array([r["cut"] for r in rows], np.int64))


def _counts(words: Level, n: int) -> np.ndarray:
    try:
        return np.array(mapped(f"{words.folder}/counts-{n}", "<i8"))
    except FileNotFoundError:  # a shard without words has no files
        return np.empty(0, np.int64)


def _build_pairs(
    docs: DataFrame, words: Level, tokens: int, vocabulary: int, folder: str, order: int
) -> Level:
    """Write the second level and, with order 3, the third."""
    shards = 2 * partitions(docs)
    if vocabulary**2 >= 2**63 or vocabulary >= 2**31:
        raise ValueError(f"pairs of {vocabulary} words do not fit in 64 bits")
    cuts = _pair_cuts(words, shards, vocabulary, tokens, docs)
    level = Level(folder, cuts, np.empty(0))
    bounds = np.concatenate([[0], cuts, [vocabulary * vocabulary]])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(words)

        def number(texts: list[bytes]) -> np.ndarray:
            """Pairs, and the word behind each; -1 behind the end of a text, or if it is not asked for."""
            known.trim()
            all_words, ends = _sequence(texts)
            numbers = known.numbers_of(all_words)
            before = np.empty_like(numbers)
            before[1:] = numbers[:-1]
            before[0] = numbers[ends[0]]
            thirds = np.full_like(numbers, -1)
            if order > 2:
                thirds[:-1] = numbers[1:]
                thirds[ends] = -1
            return np.stack([before * vocabulary + numbers, thirds])

        for pairs, thirds in _gathered(batches, number, -(-GATHERED // (order - 1))):
            keys, which = np.unique(pairs, return_inverse=True)
            grams, counts = np.unique(which * (vocabulary + 1) + thirds + 1, return_counts=True)
            which, thirds = np.divmod(grams, vocabulary + 1)
            keys = keys[which]
            ends = [0, *np.searchsorted(keys, cuts), len(keys)]
            held = [n for n in range(shards) if ends[n] < ends[n + 1]]
            parts = [slice(ends[n], ends[n + 1]) for n in held]
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array(held, pa.int32()),
                    "grams": [_packed(keys[p], thirds[p] - 1, counts[p]) for p in parts],
                }
            )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts = -1, []
        for batch in batches:
            for n, grams in zip(batch["shard"].to_pylist(), batch["grams"]):
                shard = n
                parts.append(_unpacked(grams.as_py()))
        if not parts:
            return
        keys, thirds, counts = (np.concatenate(c) for c in zip(*parts))
        parts.clear()
        keys, which = np.unique(keys, return_inverse=True)
        grams, seen = _summed(which * (vocabulary + 1) + thirds + 1, counts)
        which, thirds = np.divmod(grams, vocabulary + 1)
        counts = np.add.reduceat(seen, np.flatnonzero(np.diff(which, prepend=-1)))
        low, high = int(bounds[shard]) // vocabulary, (int(bounds[shard + 1]) - 1) // vocabulary
        first = keys // vocabulary
        eliasfano.write_runs(
            f"{folder}/keys-{shard}", first - low, keys % vocabulary, high - low + 1
        )
        kinds = [_write_counts(f"{folder}/raw-{shard}", counts), ""]
        if order > 2:
            deeper = thirds > 0
            eliasfano.write_runs(
                f"{folder}/thirds-{shard}", which[deeper], thirds[deeper] - 1, len(keys)
            )
            kinds[1] = _write_counts(f"{folder}/seen-{shard}", seen[deeper])
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([shard], pa.int32()),
                "kinds": [kinds],
                "first": first[:1],
                "n_first": [int((first == first[0]).sum())],
                "last": first[-1:],
                "n_last": [int((first == first[-1]).sum())],
            }
        )

    dealt = docs.mapInArrow(counted, "shard int, grams binary").repartitionById(
        shards, F.col("shard")
    )
    index = stage(
        dealt.mapInArrow(
            written,
            "shard int, kinds array<string>, first long, n_first long, last long, n_last long",
        )
    )
    # A row for each shard: successors of the words whose runs are cut.
    rows = sorted(index.collect(), key=lambda r: r["shard"])
    cut_runs: dict[int, int] = {}
    for row in rows:
        cut_runs[row["first"]] = cut_runs.get(row["first"], 0) + row["n_first"]
        if row["last"] != row["first"]:
            cut_runs[row["last"]] = cut_runs.get(row["last"], 0) + row["n_last"]
    kinds = {r["shard"]: tuple(r["kinds"]) for r in rows}

    def smoothed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts_of = WordCounts(words)
        for shard in (n for batch in batches for n in batch["id"].to_pylist()):
            # The words whose run starts in this shard, and the weights of their unseen successors.
            low, high = (int(-(-b // vocabulary)) for b in (bounds[shard], bounds[shard + 1]))
            followers = np.zeros(high - low, np.int64)
            if shard in kinds:
                first, second = eliasfano.Runs(f"{folder}/keys-{shard}").all()
                first += int(bounds[shard]) // vocabulary
                pairs = mapped(f"{folder}/raw-{shard}", kinds[shard][0]).astype(np.int64)
                runs, which, sizes = np.unique(first, return_inverse=True, return_counts=True)
                for n in (0, -1):
                    sizes[n] = cut_runs.get(int(runs[n]), sizes[n])
                total = counts_of.find(runs) + sizes
                single = (counts_of.find(second) + 1) / (tokens + vocabulary + 1)
                chance = (pairs + sizes[which] * single) / total[which]
                with replacing(f"{folder}/logs-{shard}") as out:
                    out.write(quantised(np.log10(chance)).tobytes())
                own = (runs >= low) & (runs < high)
                followers[runs[own] - low] = sizes[own]
            for run in cut_runs:  # a run that starts here may have its pairs in later shards
                if low <= run < high:
                    followers[run - low] = cut_runs[run]
            seen = counts_of.find(np.arange(low, high))
            weight = np.where(followers > 0, followers / np.maximum(1, followers + seen), 1.0)
            with replacing(f"{folder}/weights-{shard}") as out:
                out.write(quantised(np.log10(weight)).tobytes())
            yield pa.RecordBatch.from_pydict({"id": [shard]})

    docs.sparkSession.range(0, shards, 1, shards).mapInArrow(smoothed, "id long").write.format(
        "noop"
    ).mode("overwrite").save()
    return Level(folder, cuts, np.array([n in kinds for n in range(shards)]), kinds=kinds)


def fit(docs: DataFrame, order: int = 2) -> Model:
    """Train on every row of ``docs`` (text) and write ``order`` levels, 2 or 3, to the shared folder."""
    if order not in (2, 3):
        raise ValueError(f"a model has 2 or 3 levels, not {order}")
    folder = new_folder(docs.sparkSession, "ngrams")
    docs = spread(docs.select("text"))
    words, tokens = _build_words(docs, f"{folder}/words")
    vocabulary = words.size
    if not vocabulary:
        return Model(words, Level(f"{folder}/pairs", np.empty(0, np.int64), np.empty(0)), 0, 0, order)
    pairs = _build_pairs(docs, words, tokens, vocabulary, f"{folder}/pairs", order)
    return Model(words, pairs, tokens, vocabulary, order)


class Pairs(Reader):
    """Second level: logarithm of the probability of a pair, or of the weight of unseen ones; and the
    third level, which is reached from a pair."""

    def find(self, pairs: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
        """Steps of the logarithm, -1 for a pair that was not seen, and its place in its shard."""
        out = np.full(len(pairs), -1, np.int64)
        found = np.full(len(pairs), -1, np.int64)
        for n, places in self.by_shard(pairs):
            if self.level.base[n]:
                keys, logs = self.shard(n, "keys", eliasfano.Runs, ("logs", "<u2"))
                low = int(self.level.cuts[n - 1]) // vocabulary if n else 0
                first, second = np.divmod(pairs[places], vocabulary)
                at, _ = keys.find(first - low, second)
                there = at >= 0
                out[places[there]] = logs[at[there]]
                found[places] = at
        return out, found

    def follow(
        self, pairs: np.ndarray, found: np.ndarray, thirds: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of the triples, of their pairs, and of the distinct successors of these.

        ``found`` are the places of the pairs, all of them seen; a third word of -1 is unknown.
        """
        seen, total, types = (np.zeros(len(pairs), np.int64) for _ in range(3))
        for n, places in self.by_shard(pairs):
            own, behind = self.level.kinds[n]
            runs, counts, raw = self.shard(
                n, "thirds", eliasfano.Runs, ("seen", behind), ("raw", own)
            )
            wanted = thirds[places]
            at, types[places] = runs.find(found[places], np.maximum(wanted, 0))
            there = (at >= 0) & (wanted >= 0)
            seen[places[there]] = counts[at[there]]
            total[places] = raw[found[places]]
        return seen, total, types

    def weights(self, words: np.ndarray, vocabulary: int) -> np.ndarray:
        """Steps of the logarithm for the words in front."""
        out = np.zeros(len(words), np.int64)
        for n, places in self.by_shard(words * vocabulary):
            start = -(-int(self.level.cuts[n - 1]) // vocabulary) if n else 0
            name = ("weights", n)
            if name not in self.open:
                self.open[name] = mapped(f"{self.level.folder}/weights-{n}", "<u2")
            out[places] = self.open[name][words[places] - start]
        return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` for each row of ``docs`` (doc_id, text).

    ``base_score`` is the sum of log10 of the smoothed shares of the tokens, ``score`` log10 of the
    probability of the text under the model.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pairs = Vocabulary(model.words), Pairs(model.pairs)
        size = model.vocabulary
        for batch in batches:
            for first, texts in groups(batch, most=SCORED):
                known.trim()
                words, ends = _sequence(texts)
                places = known.look_up(words)
                numbers, counts = known.numbers[places], known.counts[places]
                base = np.log10((counts + 1) / (model.tokens + size + 1))
                logs = base.copy()
                if size:
                    before = np.concatenate([numbers[ends[:1]], numbers[:-1]])
                    both = np.flatnonzero((before >= 0) & (numbers >= 0))
                    keys, which = np.unique(
                        before[both] * size + numbers[both], return_inverse=True
                    )
                    steps = np.full(len(numbers), -1, np.int64)
                    found, at = pairs.find(keys, size)
                    steps[both] = found[which]
                    pair = np.full(len(numbers) + 1, -1, np.int64)  # behind which a token stands
                    pair[both + 1] = np.where(at[which] >= 0, which, -1)
                    unseen = np.flatnonzero((steps < 0) & (before >= 0))
                    heads, which = np.unique(before[unseen], return_inverse=True)
                    logs[unseen] -= pairs.weights(heads, size)[which] * QUANTUM
                    logs[steps >= 0] = -steps[steps >= 0] * QUANTUM
                starts = np.concatenate([[0], ends[:-1] + 1])
                if size and model.order > 2:
                    pair[starts] = -1
                    third = np.flatnonzero(pair[:-1] >= 0)
                    third = third[np.argsort(pair[third])]
                    pair = pair[third]
                    seen, total, types = pairs.follow(keys[pair], at[pair], numbers[third])
                    shorter = 10.0 ** logs[third]
                    logs[third] = np.log10((seen + types * shorter) / (total + types))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, len(texts)),
                        pa.array(ends - starts + 1),
                        *(
                            pa.array(np.add.reduceat(column, starts))
                            for column in ((counts > 0).astype(np.int64), base, logs)
                        ),
                    ],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return spread(docs.select("doc_id", "text")).mapInArrow(
        scored,
        f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double",
    )


def fold(folds: int = 7) -> Column:
    """Fold of a document by its id; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds
