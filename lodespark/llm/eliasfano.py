"""Sorted distinct numbers in Elias-Fano form, memory-mapped, with successor search in batches.

The low bits of the numbers lie packed side by side. The high bits are written in unary: a one
for each number, after as many zeros as its high part. A count of the zeros before each
64-bit word finds the zero that closes a high part.

Runs of numbers, such as the successors of each node of a trie, are one such sequence: the numbers
of a run are raised by one more than the last before it. A second sequence points to where each
run starts.
"""

from __future__ import annotations

import numpy as np

from lodespark.llm.storage import mapped, replacing

# With at most so many low bits a number lies within eight bytes from its first byte on.
MOST_LOW = 56
U = np.uint64
# A one at the lowest and the highest bit of each byte.
BYTES, HIGHEST = U(0x0101010101010101), U(0x8080808080808080)
# Place of the n-th one of a byte, at eight times the byte plus n.
IN_BYTE = np.array(
    [([p for p in range(8) if byte >> p & 1] + [0] * 8)[n] for byte in range(256) for n in range(8)]
)


def write(path: str, values: np.ndarray) -> None:
    """Write sorted distinct unsigned 64-bit ``values`` below 2 ** 63."""
    base = values[0] if len(values) else np.uint64(0)
    rest = values - base
    span = int(rest[-1]) + 1 if len(rest) else 1
    low_bits = min(MOST_LOW, max(0, (span // max(1, len(rest))).bit_length() - 1))
    shift = np.uint64(low_bits)
    ones = (rest >> shift).astype(np.int64) + np.arange(len(rest))
    words = -(-(len(rest) + (span - 1 >> low_bits) + 2) // 64)
    bits = np.zeros(words * 64, np.uint8)
    bits[ones] = 1
    upper = np.packbits(bits, bitorder="little").view("<u8")
    counts = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(upper).astype(np.int64))])
    with replacing(path) as out:
        head = np.array([base, len(values), low_bits, len(upper)], "<u8")
        for part in (head, upper, counts.astype("<i8")):
            out.write(part.tobytes())
        # Whole bytes of low bits at a time, eight numbers of low_bits bits filling low_bits bytes.
        for start in range(0, len(rest) if low_bits else 0, 1 << 16):
            low = rest[start : start + (1 << 16)]
            each = (low[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
            out.write(np.packbits(each.astype(np.uint8).ravel(), bitorder="little").tobytes())
        out.write(bytes(8))


def write_runs(path: str, runs: np.ndarray, values: np.ndarray, count: int) -> None:
    """Write ``values``, sorted and distinct within each of ``count`` runs, and pointers to the runs."""
    sizes = np.bincount(runs, minlength=count)
    pointers = np.concatenate([[0], np.cumsum(sizes)]) + np.arange(count + 1)  # distinct
    write(f"{path}-starts", pointers.astype(np.uint64))
    lasts = np.flatnonzero(np.diff(runs, append=-1))
    raised = np.concatenate([[0], np.cumsum(values[lasts] + 1)])[:-1]
    write(path, (values + np.repeat(raised, sizes[sizes > 0])).astype(np.uint64))


def _selected(bits: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Place of a one in each 64-bit word, ``left`` ones being before it."""
    left = left.astype(np.uint64)
    pairs = bits - ((bits >> U(1)) & (U(0x55) * BYTES))
    fours = (pairs & (U(0x33) * BYTES)) + ((pairs >> U(2)) & (U(0x33) * BYTES))
    # Ones up to the end of each byte, in that byte.
    upto = ((fours + (fours >> U(4))) & (U(0x0F) * BYTES)) * BYTES
    at = np.bitwise_count((((left * BYTES) | HIGHEST) - upto) & HIGHEST).astype(np.uint64) << U(3)
    left -= ((upto << U(8)) >> at) & U(255)
    return at.astype(np.int64) + IN_BYTE[((bits >> at) & U(255)) << U(3) | left]


class Sequence:
    """A written sequence."""

    def __init__(self, path: str):
        raw = np.asarray(mapped(path, "u1"))
        self.base, size, low_bits, words = (int(x) for x in raw[:32].view("<u8"))
        self.size, self.low_bits = size, low_bits
        self.upper = raw[32 : 32 + 8 * words].view("<u8")
        at = 32 + 8 * words
        self.zeros = raw[at : at + 8 * (words + 1)].view("<i8")
        self.ones = None  # ones before each word, once they are asked for
        packed = raw[at + 8 * (words + 1) :]
        # Eight bytes from every byte on: unaligned, but never beyond the padding.
        self.low = np.ndarray((len(packed) - 7,), "<u8", packed, strides=(1,))

    def _low(self, index: np.ndarray) -> np.ndarray:
        bit = index * self.low_bits
        mask = np.uint64((1 << self.low_bits) - 1)
        return (self.low[bit >> 3] >> (bit & 7).astype(np.uint64)) & mask

    def _before_zero(self, number: np.ndarray) -> np.ndarray:
        """Ones before the zero of a number, counted from 0."""
        word = np.searchsorted(self.zeros, number, side="right") - 1
        at = _selected(~self.upper[word], number - self.zeros[word])
        return word * 64 + at - number

    def get(self, index: np.ndarray) -> np.ndarray:
        """Numbers at the places."""
        if self.ones is None:
            self.ones = 64 * np.arange(len(self.zeros)) - self.zeros
        word = np.searchsorted(self.ones, index, side="right") - 1
        high = word * 64 + _selected(self.upper[word], index - self.ones[word]) - index
        return (high << self.low_bits | self._low(index).astype(np.int64)) + self.base

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 if it is not there."""
        out = np.full(len(keys), -1, np.int64)
        if not self.size:
            return out
        rest = keys - np.uint64(self.base)
        high = (rest >> np.uint64(self.low_bits)).astype(np.int64)
        inside = np.flatnonzero((keys >= self.base) & (high < int(self.zeros[-1])))
        high, rest = high[inside], rest[inside]
        wanted = rest & np.uint64((1 << self.low_bits) - 1)
        stop = self._before_zero(high)
        first = np.where(high > 0, self._before_zero(np.maximum(high - 1, 0)), 0)
        # The first with at least these low bits; most high parts have few numbers.
        open_ = np.flatnonzero(first < stop)
        low, end, wanted = first[open_], stop[open_], wanted[open_]
        held = self._low(low)
        out[inside[open_[held == wanted]]] = low[held == wanted]
        more = (held < wanted) & (low + 1 < end)
        open_, low, end, wanted = open_[more], low[more] + 1, end[more], wanted[more]
        while len(open_):
            middle = (low + end) >> 1
            held = self._low(middle)
            out[inside[open_[held == wanted]]] = middle[held == wanted]
            less = held < wanted
            low, end = np.where(less, middle + 1, low), np.where(less, end, middle)
            more = (held != wanted) & (low < end)
            open_, low, end, wanted = open_[more], low[more], end[more], wanted[more]
        return out

    def values(self) -> np.ndarray:
        """All numbers."""
        bits = np.unpackbits(np.array(self.upper).view(np.uint8), bitorder="little")
        index = np.arange(self.size)
        high = (np.flatnonzero(bits) - index).astype(np.uint64)
        return (high << np.uint64(self.low_bits) | self._low(index)) + np.uint64(self.base)


class Runs:
    """Written runs."""

    def __init__(self, path: str):
        self.numbers, self.starts = Sequence(path), Sequence(f"{path}-starts")

    def find(self, runs: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each value of a run, -1 if it is not there, and the size of the run.

        Equal runs side by side are followed once.
        """
        new = np.diff(runs, prepend=-1) != 0
        heads, which = runs[new], np.cumsum(new) - 1
        start, end = self.starts.get(heads) - heads, self.starts.get(heads + 1) - heads - 1
        at = np.full(len(runs), -1, np.int64)
        if self.numbers.size:
            raised = np.where(start > 0, self.numbers.get(np.maximum(start - 1, 0)) + 1, 0)
            at = self.numbers.find((raised[which] + values).astype(np.uint64))
            at[at >= end[which]] = -1
        return at, (end - start)[which]

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """Run and value of every number."""
        sizes = np.diff(self.starts.values().astype(np.int64)) - 1
        held, numbers = sizes[sizes > 0], self.numbers.values().astype(np.int64)
        raised = np.concatenate([[0], numbers[np.cumsum(held) - 1] + 1])[:-1]
        return np.repeat(np.arange(len(sizes)), sizes), numbers - np.repeat(raised, held)
