"""Token ids as flat binary files with 64-bit document offsets.

A folder holds, for each shard, ``ids-N.bin`` (unsigned 16-bit or 32-bit token ids), ``ends-N.bin``
(64-bit offset behind each document, counted within the shard) and ``docs-N.bin`` (signed
64-bit document ids), all little-endian, and a Parquet table ``index`` with a row per shard: its
number of documents, of null ids (they come first) and of token ids. Shards follow each other
in ascending document id; a prefix sum over the index gives the position of the first token
of each.

Defined cases: a null text is empty and gives the end id alone; null ids come first; rows with
equal ids are ordered by a hash of their text, and equal rows are written as often as
they come; an empty table gives an empty index. Other columns are ignored.
"""

from __future__ import annotations

import re
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodespark.llm.storage import mapped, partitions, replacing
from lodespark.llm.words import tidied

# Bound on the bytes of each table of remembered words of a task; beyond it they are forgotten and
# encoded anew. An entry takes about so many besides its word and ids.
MEMO, EACH = 1 << 26, 200
# Longer pieces are not remembered.
LONG_WORD = 64
# Rows per batch that is read back.
BLOCK = 4096
# Tokens lie on both sides of such a space: patterns of byte-level tokenizers take at
# most one space in front of a word and none inside or behind it.
CUT = re.compile(r"(?<=\S) (?=\S)")
# Marks that form a run of their own behind letters; an apostrophe may start a contraction.
MARKS = string.punctuation.replace("'", "")


def byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others follow from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


class Encoder:
    """Encodes whole texts with one tokenizer, each distinct word of a task once.

    A text is cut at single spaces and line ends between other characters, where no token of a
    byte-level tokenizer without normaliser can lie across: a space goes with the word behind
    it, a line end stands alone. The ids of the pieces, joined, are those of the text.
    """

    def __init__(self, definition: str, code: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.code = code
        self.after_space = Memo(lambda word: self.piece(" ", word))
        self.first = Memo(lambda word: self.piece("", word))
        self.marks = Memo(self.whole)
        self.line_end = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def piece(self, space: str, word: str) -> bytes | None:
        """Ids of a word and the space before it; None if it cannot be cut off there."""
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        stem = word.rstrip(MARKS)
        if not stem.isalpha():
            return self.whole(space + word)
        if stem != word:  # marks behind letters are a run of their own
            known = self.after_space if space else self.first
            return known[stem] + self.marks[word[len(stem) :]]
        letters = (space + word).encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()

    def encode(self, text: str) -> bytes:
        find = self.after_space.__getitem__
        try:
            lines = []
            for line in text.split("\n"):
                first, *words = line.split(" ")
                lines.append(self.first[first] + b"".join(map(find, words)))
            return self.line_end.join(lines)
        except TypeError:  # a None: white space that touches other white space
            first, *words = CUT.split(text)
            found = map(find, words)  # only the last word can end in white space
            pieces = (self.whole(" " + w) if ids is None else ids for w, ids in zip(words, found))
            return self.whole(first) + b"".join(pieces)


class Memo(dict):
    """Remembered results of a function of short strings."""

    def __init__(self, function):
        super().__init__()
        self.function = function
        self.bytes = 0

    def __missing__(self, key: str):
        value = self.function(key)
        if len(key) <= LONG_WORD:
            if self.bytes >= MEMO:
                self.clear()
                self.bytes = 0
            self[key] = value
            self.bytes += EACH + len(key) + len(value or b"")
        return value


def write(docs: DataFrame, definition: str, end_id: int, folder: str) -> None:
    """Encode ``text`` of ``docs`` and write it to ``folder`` in ascending ``doc_id``.

    ``definition`` is the JSON text of a byte-level tokenizer without normaliser; it is sent
    with the job and as large as its vocabulary. Ids take 16 bits if all fit, else 32.
    """
    parsed = Tokenizer.from_str(definition)
    if parsed.normalizer is not None:
        raise ValueError("texts are cut at spaces, which a normaliser may change")
    largest = max(end_id, parsed.get_vocab_size(with_added_tokens=True))
    dtype = "<u2" if largest < 2**16 else "<u4"
    sent = docs.sparkSession.sparkContext.broadcast(definition)

    @tidied
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value, "H" if dtype == "<u2" else "I")
        end = np.array([end_id], dtype).tobytes()
        shard = TaskContext.get().partitionId()
        n_docs = n_nulls = n_ids = 0
        with (
            replacing(f"{folder}/ids-{shard}.bin") as ids_file,
            replacing(f"{folder}/ends-{shard}.bin") as ends_file,
            replacing(f"{folder}/docs-{shard}.bin") as docs_file,
        ):
            for batch in batches:
                lengths = []
                for text in batch["text"]:
                    ids = encoder.encode(text.as_py()) + end
                    ids_file.write(ids)
                    lengths.append(len(ids) // len(end))
                ends = n_ids + np.cumsum(np.array(lengths, "<i8"))
                ends_file.write(ends.astype("<i8").tobytes())
                numbers = batch["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)
                docs_file.write(numbers.astype("<i8").tobytes())
                n_docs += len(ends)
                n_nulls += batch["doc_id"].null_count
                n_ids = int(ends[-1]) if len(ends) else n_ids
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([shard], pa.int64()),
                "n_docs": pa.array([n_docs], pa.int64()),
                "n_nulls": pa.array([n_nulls], pa.int64()),
                "n_ids": pa.array([n_ids], pa.int64()),
                "dtype": [dtype],
            }
        )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(partitions(docs), *keys).sortWithinPartitions(*keys)
    dealt.mapInArrow(
        encoded, "shard long, n_docs long, n_nulls long, n_ids long, dtype string"
    ).write.parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document of the files: doc_id, start, n_tokens, ids_crc32, shard.

    ``start`` counts the ids of all documents before; the checksum is that of the ids as
    little-endian unsigned 32-bit integers.
    """
    index = spark.read.parquet(f"{folder}/index")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    located = index.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    last = index.agg(F.max("shard")).first()[0]
    shards = 0 if last is None else last + 1

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in (row for batch in batches for row in batch.to_pylist()):
            if not shard["n_docs"]:
                continue
            ids = mapped(f"{folder}/ids-{shard['shard']}.bin", shard["dtype"])
            ends = mapped(f"{folder}/ends-{shard['shard']}.bin", "<i8")
            numbers = mapped(f"{folder}/docs-{shard['shard']}.bin", "<i8")
            for low in range(0, len(ends), BLOCK):
                stops = np.array(ends[low : low + BLOCK])
                starts = np.concatenate([[ends[low - 1] if low else 0], stops[:-1]])
                sums = [
                    zlib.crc32(ids[a:b].astype("<u4").tobytes())
                    for a, b in zip(starts.tolist(), stops.tolist())
                ]
                null = np.arange(low, low + len(stops)) < shard["n_nulls"]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(np.array(numbers[low : low + BLOCK]), mask=null),
                        "start": shard["base"] + starts,
                        "n_tokens": stops - starts,
                        "ids_crc32": pa.array(sums, pa.int64()),
                        "shard": np.full(len(stops), shard["shard"], np.int64),
                    }
                )

    return located.repartitionByRange(max(1, shards), "shard").mapInArrow(
        documents, "doc_id long, start long, n_tokens long, ids_crc32 long, shard long"
    )
