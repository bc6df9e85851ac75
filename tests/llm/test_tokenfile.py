from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

from lodespark.llm import queries, tokenfile
from lodespark.llm.storage import new_folder
from tests.llm.conftest import ODD_TEXTS

DEFINITION = Path(queries.BYTE_TOKENIZER).read_text("utf-8")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_str(DEFINITION)


def expected(rows, tokenizer):
    start, found = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def written(spark, docs):
    folder = new_folder(spark, "test")
    tokenfile.write(docs, DEFINITION, 2, folder)
    rows = tokenfile.read(spark, folder).collect()
    return sorted((tuple(r)[:4] for r in rows), key=lambda r: r[1])


def test_whole_texts(spark, frame, tokenizer):
    rows = [(n, t) for n, t in enumerate(ODD_TEXTS)] + [(-5, "before all"), (None, "no id")]
    docs = frame([(*r, "extra") for r in rows], "doc_id long, text string, start string")
    assert written(spark, docs) == expected(rows, tokenizer)


def test_repeated_rows(spark, frame, tokenizer):
    rows = [(7, "same text")] * 5 + [(3, "other")]
    assert written(spark, frame(rows, "doc_id long, text string")) == expected(rows, tokenizer)


def test_empty_table(spark, frame):
    assert written(spark, frame([], "doc_id long, text string")) == []


def test_pieces_are_those_of_the_text(tokenizer):
    encoder = tokenfile.Encoder(DEFINITION, "H")
    rng = np.random.default_rng(3)
    parts = [" ", "\n", "  ", "\t", "a", "It", "'s", "n't", "é", "12", ".", "...", "%%%", "😀", " ", "\x1c"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(0, 12)))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == np.array(ids, "<u2").tobytes(), repr(text)


def test_forgotten_words_are_encoded_anew(tokenizer, monkeypatch):
    monkeypatch.setattr(tokenfile, "MEMO", 2)
    encoder = tokenfile.Encoder(DEFINITION, "H")
    text = "one two three two one, four three."
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.encode(text) == np.array(ids, "<u2").tobytes()
