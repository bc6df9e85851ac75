"""Quality rules: counts of a text, and a calibrated logistic regression on hashed n-grams.

The model has two heads, trained on a bounded sample of the labelled rows and calibrated on rows left
out of training, with the weights that then judge. The one for good quality weighs the whole text; the one
for toxic language weighs the stretch from each word on, as a few words may be all there is, and
goes by the worst and by the sum of the text over the root of its words, as one doubtful word is not much
but several are. Texts are in Arrow batches against fixed thresholds.

Defined cases: a null text has no words and fails the base rule; labels of unknown documents, and null
labels, are left out; a head whose sample has one class only passes every text; a row of the labels that
repeats a document counts as often as it comes; of texts with one id the first by order is the
labelled one. Other columns are carried along, but not those called like one of ``COLUMNS``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodespark.llm.words import WordIds, groups, tidied
from lodespark.staging import spread, stage

# Labelled rows that the model is fitted on: those of the smallest hashes. The bound holds at every
# size of the labels; one row in four of them is kept for calibration. Rows beyond so many bytes of
# text, in the same order, are left out, too.
SAMPLE, SAMPLE_BYTES = 4000, 1 << 26
CALIBRATION = 4
BITS = 18
SIZE = 1 << BITS
# Weight of the character block: its values are shares of many n-grams and so rather small.
CHARACTERS = 8.0
# Bytes of a character n-gram of the whole text and of a stretch, and words of a stretch.
WHOLE_WIDTH, STRETCH_WIDTH, STRETCH = 4, 6, 8
BATCH = 128
WHOLE_EPOCHS, WHOLE_RATE = 12, 0.3
WORST_EPOCHS, WORST_RATE = 12, 0.1
# Buckets are weighed for stretches if their log-odds are so many deviations from none: the few
# marked texts would else be learnt by heart. Counts are smoothed, and the log-odds are
# scaled down as the start of training.
DEVIATIONS, SMOOTHING, START = 3.0, 2.0, 0.3
# Thresholds: a text is kept if it is at least so likely good and at most so likely toxic.
GOOD, TOXIC = 0.5, 0.5
# Of the slopes of the calibration, per row.
PENALTY = 1e-4
# Base rule.
LEAST_WORDS, REPEATED_PERCENT = 50, 50

_SYMBOLS = b"#*$%&|<>"
_BLANK = b" \t\n\x0b\x0c\r"
_TRAILING = bytes(range(0x80, 0xC0))
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _characters(text: bytes, width: int) -> np.ndarray:
    """Bucket of the run of ``width`` bytes from each byte on, of the text after a space."""
    own = np.frombuffer(b" " + text.lower() + b" " * width, np.uint8).astype(np.uint64)
    size = len(text) + 1
    runs = own[:size].copy()
    for n in range(1, width):
        runs <<= np.uint64(8)
        runs |= own[n : n + size]
    return ((runs * _PAIR) >> np.uint64(64 - BITS)).astype(np.int32)


def _ngrams(codes: np.ndarray) -> np.ndarray:
    """Distinct buckets of the words and word pairs, given the hashes of the words."""
    mixed = codes * _PAIR
    both = np.concatenate([mixed, (mixed[:-1] ^ codes[1:]) * _PAIR])
    return np.unique(both >> np.uint64(64 - BITS)).astype(np.int64)


def features(codes: np.ndarray, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a whole text."""
    grams = _ngrams(codes) if len(codes) else np.empty(0, np.int64)
    marks, repeats = np.unique(_characters(text, WHOLE_WIDTH), return_counts=True)
    values = [
        np.full(len(grams), 1 / np.sqrt(max(1, len(grams)))),
        CHARACTERS * repeats / repeats.sum(),
    ]
    return (
        np.concatenate([grams, marks.astype(np.int64) + SIZE]).astype(np.int32),
        np.concatenate(values).astype(np.float32),
    )


def _running(values: np.ndarray) -> np.ndarray:
    """Sums of the values before each place, and of all."""
    return np.concatenate([np.zeros(1), np.cumsum(values, dtype=np.float64)])


@dataclass
class Stretches:
    """Buckets of the words and characters of a text, and where its words start in the latter.

    A stretch starts at every word that has enough words after it, so that what it weighs does not
    depend on where in the text a phrase begins; a shorter text is one stretch.
    """

    words: np.ndarray
    characters: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, codes: np.ndarray, words: list[bytes]) -> Stretches:
        sizes = np.fromiter(map(len, words), np.int32, len(words))
        return cls(
            ((codes * _PAIR) >> np.uint64(64 - BITS)).astype(np.int32),
            _characters(b" ".join(words), STRETCH_WIDTH),
            np.concatenate([np.zeros(1, np.int32), np.cumsum(sizes + 1, dtype=np.int32)]),
        )

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """Weight of each stretch; none for a text without words."""
        if not len(self.words):
            return np.zeros(0)
        by_word = _running(weights[:SIZE][self.words])
        by_word += _running(weights[SIZE:][self.characters])[self.places]
        length = min(STRETCH, len(self.words))
        return by_word[length:] - by_word[:-length]

    def evidence(self, weights: np.ndarray) -> tuple[float, float]:
        """Weight of the worst stretch, and of the text over the root of its words."""
        sums = self.sums(weights)
        if not len(sums):
            return 0.0, 0.0
        whole = weights[:SIZE][self.words].sum() + weights[SIZE:][self.characters].sum()
        return float(sums.max()), float(whole) / len(self.words) ** 0.5

    def slopes(self, worst: int, out: np.ndarray, by: float) -> None:
        """Add to ``out`` how the weight of one stretch depends on the weights."""
        stop = min(worst + STRETCH, len(self.words))
        np.add.at(out, self.words[worst:stop], by)
        np.add.at(out, SIZE + self.characters[self.places[worst] : self.places[stop]], by)

    def present(self) -> np.ndarray:
        return np.unique(np.concatenate([self.words, self.characters + SIZE]))


@dataclass
class Model:
    """Weights of the word buckets, then of the character buckets, of both heads."""

    good: np.ndarray
    toxic: np.ndarray
    # Slopes and shift of what ``evidence`` gives; without two classes every text passes.
    for_good: tuple[float, ...] = (0.0, 50.0)
    for_toxic: tuple[float, ...] = (0.0, 0.0, -50.0)

    def evidence(self, codes: np.ndarray, words: list[bytes], text: bytes) -> tuple[float, float, float]:
        """For good quality, then twice for toxic language."""
        grams = _ngrams(codes) if len(codes) else np.empty(0, np.int64)
        good = CHARACTERS * self.good[SIZE:][_characters(text, WHOLE_WIDTH)].mean()
        if len(grams):
            good += self.good[grams].sum() / np.sqrt(len(grams))
        return good, *Stretches.of(codes, words).evidence(self.toxic)

    def chances(self, evidence: np.ndarray) -> np.ndarray:
        """Of good quality and of toxic language, from rows of evidence."""
        x = evidence.reshape(-1, 3)
        exponents = [
            x[:, :1] @ self.for_good[:-1] + self.for_good[-1],
            x[:, 1:] @ self.for_toxic[:-1] + self.for_toxic[-1],
        ]
        return 1 / (1 + np.exp(-np.clip(np.stack(exponents, axis=1), -50, 50)))


class Steps:
    """Adaptive gradient steps for the weights and the bias of a head."""

    def __init__(self, rate: float, weights: np.ndarray, bias: float = 0.0):
        self.rate, self.weights, self.bias = rate, weights, bias
        self.seen, self.bias_seen = np.full(len(weights), 1e-8), 1e-8

    def take(self, slopes: np.ndarray, wrong: float) -> None:
        self.seen += slopes**2
        self.weights -= self.rate * slopes / np.sqrt(self.seen)
        self.bias_seen += wrong**2
        self.bias -= self.rate * wrong / np.sqrt(self.bias_seen)


def _batches(wanted: np.ndarray, epochs: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of each step and the weights that give both classes the same sum."""
    rng = np.random.default_rng(5)
    balance = np.where(wanted > 0, 0.5 / wanted.mean(), 0.5 / (1 - wanted.mean()))
    for _ in range(epochs):
        order = rng.permutation(len(wanted))
        for low in range(0, len(order), BATCH):
            batch = order[low : low + BATCH]
            yield batch, balance[batch] / len(batch)


def _wrong(logits: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -50, 50))) - wanted


def _fit_whole(rows: list[tuple[np.ndarray, np.ndarray]], wanted: np.ndarray) -> Steps:
    steps = Steps(WHOLE_RATE, np.zeros(2 * SIZE))
    for batch, balance in _batches(wanted, WHOLE_EPOCHS):
        lengths = [len(rows[n][0]) for n in batch]
        buckets = np.concatenate([rows[n][0] for n in batch])
        values = np.concatenate([rows[n][1] for n in batch])
        starts = np.cumsum([0, *lengths[:-1]])
        logits = np.add.reduceat(steps.weights[buckets] * values, starts) + steps.bias
        wrong = _wrong(logits, wanted[batch]) * balance
        slopes = np.bincount(buckets, np.repeat(wrong, lengths) * values, 2 * SIZE)
        steps.take(slopes, wrong.sum())
    return steps


def _fit_worst(rows: list[Stretches], wanted: np.ndarray) -> Steps:
    start = _log_odds(rows, wanted)
    chosen = start != 0
    steps = Steps(WORST_RATE, START * start, -3.0)
    for batch, balance in _batches(wanted, WORST_EPOCHS):
        sums = [rows[n].sums(steps.weights) for n in batch]
        logits = np.array([s.max() if len(s) else 0.0 for s in sums]) + steps.bias
        wrong = _wrong(logits, wanted[batch]) * balance
        slopes = np.zeros(2 * SIZE)
        for n, s, by in zip(batch, sums, wrong):
            if len(s):
                rows[n].slopes(int(s.argmax()), slopes, by)
        steps.take(slopes * chosen, wrong.sum())
    return steps


def _log_odds(rows: list[Stretches], wanted: np.ndarray) -> np.ndarray:
    """Log-odds of the classes for texts that have a bucket; 0 where they may be chance."""
    share = wanted.mean()
    odds, variance = np.zeros(2 * SIZE), np.zeros(2 * SIZE)
    for sign, part, prior in ((1, wanted > 0, share), (-1, wanted == 0, 1 - share)):
        texts = np.zeros(2 * SIZE)
        for row, inside in zip(rows, part):
            if inside:
                texts[row.present()] += 1
        texts += SMOOTHING * prior
        odds += sign * np.log(texts / part.sum())
        variance += 1 / texts
    return np.where(np.abs(odds) > DEVIATIONS * np.sqrt(variance), odds, 0.0)


def _calibrated(evidence: np.ndarray, wanted: np.ndarray) -> tuple[float, ...]:
    """Slopes and shift that make the evidence a probability, by Newton steps."""
    scale = evidence.std(axis=0) + 1e-9
    x = np.concatenate([evidence / scale, np.ones((len(evidence), 1))], axis=1)
    # Smoothed targets and a light penalty keep the slopes finite where the classes part cleanly.
    n_good, n_bad = wanted.sum(), len(wanted) - wanted.sum()
    target = np.where(wanted > 0, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    penalty = PENALTY * len(x) * np.append(np.ones(len(scale)), 0.0)
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-6)
        beta -= np.clip(np.linalg.solve(curve, x.T @ (p - target) + penalty * beta), -2, 2)
    return *(beta[:-1] / scale).tolist(), float(beta[-1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, size: int = SAMPLE_BYTES) -> Model:
    """Fit both heads on at most ``sample`` rows of ``labels`` (doc_id, quality, toxic), and on at
    most ``size`` bytes of their texts, which the driver collects."""
    order = ["code", "quality", "toxic"]
    chosen = (
        labels.where("doc_id is not null and quality is not null and toxic is not null")
        .select(
            "doc_id",
            F.col("quality").cast("int").alias("quality"),
            F.col("toxic").cast("int").alias("toxic"),
            F.xxhash64(F.col("doc_id"), F.lit(3)).alias("code"),
        )
        .orderBy(*order)
        .limit(sample)
    )
    # At most ``sample`` rows of four numbers are broadcast.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    single = texts.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    joined = stage(single.join(F.broadcast(chosen), "doc_id").select(*order, "text"))
    sizes = sorted(tuple(r) for r in joined.select(*order, F.octet_length("text")).collect())
    kept = int((np.cumsum([r[-1] for r in sizes]) <= size).sum())
    if kept < len(sizes):
        joined = joined.where(F.struct(*order) < F.struct(*(F.lit(v) for v in sizes[kept][:3])))
    return fitted(sorted(tuple(r)[:3] + (r["text"].encode(),) for r in joined.collect()))


def fitted(rows: list[tuple[int, int, int, bytes]]) -> Model:
    """Both heads of rows (code, quality, toxic, text); a share by the code is for calibration."""
    held = np.array([code % CALIBRATION == 0 for code, *_ in rows], bool)
    ids = WordIds()

    def described(describe) -> list:
        """Features of every text; those of one head at a time are held."""
        words = (text.split() for *_, text in rows)
        return [describe(ids.codes(w), w, text) for w, (*_, text) in zip(words, rows)]

    model = Model(np.zeros(2 * SIZE, np.float32), np.zeros(2 * SIZE, np.float32))
    for head in (0, 1):  # quality, toxic
        wanted = np.array([float(r[1 + head] > 0) for r in rows])
        if any(len(set(wanted[fold])) < 2 for fold in (held, ~held)):
            continue
        if head:
            texts = described(lambda codes, words, _: Stretches.of(codes, words))
            steps = _fit_worst([t for t, h in zip(texts, held) if not h], wanted[~held])
            model.toxic = steps.weights.astype(np.float32)
            found = np.array([t.evidence(model.toxic) for t, h in zip(texts, held) if h])
            model.for_toxic = _calibrated(found, wanted[held])
        else:
            whole = described(lambda codes, _, text: features(codes, text))
            steps = _fit_whole([w for w, h in zip(whole, held) if not h], wanted[~held])
            model.good = steps.weights.astype(np.float32)
            found = np.array([[model.good[b] @ v] for (b, v), h in zip(whole, held) if h])
            model.for_good = _calibrated(found, wanted[held])
            del whole
    return model


def counts(text: bytes, ids: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, given numbers of its words."""
    packed = text.translate(None, _BLANK)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(ids),
        len(packed.translate(None, _TRAILING)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(ids),
    )


def _repeated(ids: np.ndarray) -> int:
    """Words in runs of three that come twice or more."""
    if len(ids) < 4:
        return 0
    if ids.max() < 1 << 21:
        runs = ids[:-2] << 42 | ids[1:-1] << 21 | ids[2:]
    else:  # numbers of the pairs, so that two fit in 64 bits
        pairs = np.unique(ids[:-1] << 32 | ids[1:], return_inverse=True)[1]
        runs = pairs[:-1] << 32 | ids[2:]
    order = np.argsort(runs, kind="stable")
    ranked = runs[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(runs), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    hit = np.zeros(len(ids), bool)
    for n in range(3):
        hit[n : n + len(runs)] |= again
    return int(hit.sum())


COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, p_good double, p_toxic double, kept boolean"
)


def assess(docs: DataFrame, model: Model, with_text: bool = False) -> DataFrame:
    """The columns of ``docs``, ``text`` only if asked for, and those of ``COLUMNS``."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # a few megabytes of weights
    names = [part.split()[0] for part in COLUMNS.split(",")]
    left = {*names} if with_text else {*names, "text"}
    keep = [f for f in docs.schema if f.name.lower() not in left]
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in keep)

    @tidied
    def assessed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, own = WordIds(), Model(**sent.value)
        for batch in batches:
            for first, texts in groups(batch):
                ids.trim()
                base, evidence = [], []
                for text in texts:
                    words = text.split()
                    numbers = ids.number(words)
                    base.append(counts(text, numbers))
                    evidence.append(own.evidence(ids.hashes[numbers], words, text))
                base = np.array(base, np.int64)
                chances = own.chances(np.array(evidence))
                failed = (base[:, 0] < LEAST_WORDS) | (
                    100 * base[:, 4] > REPEATED_PERCENT * base[:, 0]
                )
                passed = ~failed & (chances[:, 0] >= GOOD) & (chances[:, 1] <= TOXIC)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch[f.name].slice(first, len(texts)) for f in keep),
                        *(pa.array(column) for column in base.T),
                        *map(pa.array, (failed, chances[:, 0], chances[:, 1], passed)),
                    ],
                    names=[*(f.name for f in keep), *names],
                )

    read = [f.name for f in keep if f.name != "text"]
    return spread(docs.select(*(F.col(f"`{c}`") for c in read), "text")).mapInArrow(assessed, kept + COLUMNS)
