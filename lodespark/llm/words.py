"""Words of a text as numbers, for operators that work on Arrow batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash

# Bound on the bytes that the words remembered by a task take; beyond it they are forgotten and
# hashed anew. A word takes about so many besides its own, with its number and place in the table.
MEMO, EACH = 1 << 26, 180
# Bytes of text that are turned into arrays together.
GROUP = 1 << 20


class WordIds(dict):
    """Numbers for byte words in order of appearance, with a 64-bit hash of each."""

    def __init__(self):
        super().__init__()
        self.hashes = np.empty(1 << 16, np.uint64)
        self.bytes = 0

    def __missing__(self, word: bytes) -> int:
        number = len(self)
        if number == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)])
        self.hashes[number] = xxhash.xxh64_intdigest(word)
        self[word] = number
        self.bytes += len(word) + EACH
        return number

    def number(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def codes(self, words: list[bytes]) -> np.ndarray:
        """Hashes of the words."""
        numbers = self.number(words)
        return self.hashes[numbers]

    def trim(self) -> None:
        """Forget all words if there are too many; numbers given before no longer hold."""
        if self.bytes > MEMO:
            self.clear()
            self.bytes = 0


def tidied(task: Callable) -> Callable:
    """A task over batches that gives its memory back when it ends.

    Workers are used again by later stages; what one leaves behind, in cycles or in the pools of
    allocators, would add to what the next one takes.
    """

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # a C library other than GNU's
                ctypes.CDLL(None).malloc_trim(0)

    return run


def groups(
    batch: pa.RecordBatch, column: str = "text", most: int = GROUP
) -> Iterator[tuple[int, list[bytes]]]:
    """Position of the first row and the texts, ``most`` bytes or some more at a time, null as empty."""
    first, texts, size = 0, [], 0
    for value in batch[column]:
        text = value.as_py()
        texts.append(text.encode() if text else b"")
        size += len(texts[-1])
        if size >= most:
            yield first, texts
            first, texts, size = first + len(texts), [], 0
    if texts:
        yield first, texts


def spaced(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case."""
    return text.lower().split()
