from __future__ import annotations

import random
import re

import pytest

from lodespark.llm import pii, queries
from tests.llm.conftest import ODD_TEXTS

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, pattern in PLAIN.items():
        for match in re.finditer(pattern, text):
            number = re.sub("[^0-9]", "", match.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in match.group().split(".")) if kind == "ip" else 0,
                "card": 13 <= len(number) <= 19 and pii.luhn(number),
                "phone": 9 <= len(number) <= 15,
            }[kind]
            if good:
                found.append((kind, *match.span()))
    return found


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("a@.-1 +5(%2é") for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(text) == plain_spans(text), repr(text)


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000, "1." * 50_000, "a@" * 50_000, "+1" * 50_000])
def test_long_runs_end(text):
    pii.base_spans(text)
    pii.added_spans(text)


def test_luhn_and_mod97():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765433")


def test_context_lifts_weak_kinds():
    assert pii.added_spans("ssn 123-45-6789") == [("ssn", 4, 15)]
    assert pii.added_spans("part 123-45-6789") == []
    iban = "DE89 3704 0044 0532 0130 00"
    for after in ("", " BIC COBADEFF", " 2024", " 2024 AND MORE", " GB82 WEST 1234 5698 7654 32", ", X"):
        spans = pii.added_spans(f"to {iban}{after}")
        assert spans[0] == ("iban", 3, 3 + len(iban)), after
        assert len(spans) == (2 if "WEST" in after else 1)
    assert pii.added_spans("DE88 3704 0044 0532 0130 00 2024") == []
    assert pii.added_spans("IBAN GB82 WEST 1234 5698 7654 32.") == [("iban", 5, 32)]
    assert [s[0] for s in pii.added_spans("call (555) 123-4567")] == ["local_phone"]


def test_masked():
    text = "mail a.b@c.de or +49 (30) 1234567"
    assert pii.masked(text, pii.base_spans(text)) == "mail <email> or <phone>"


def test_rows(frame):
    texts = [*ODD_TEXTS, "😀 a@b.co", "10.0.0.1 999.1.1.1", "4111 1111 1111 1111"]
    docs = frame([(n, t, 0) for n, t in enumerate(texts)], "doc_id long, text string, base int")
    rows = {r["doc_id"]: r for r in pii.spans(docs).collect()}
    assert len(rows) == len(texts)
    for n, text in enumerate(texts):
        assert [tuple(s) for s in rows[n]["base"]] == plain_spans(text or "")
    assert pii.spans(docs.limit(0)).collect() == []


def test_query_counts(spark):
    found = queries.op4_personal_data(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    text = {d["doc_id"]: d["text"] or "" for d in docs}
    assert len(found) == len(text)
    for row in found:
        base = plain_spans(text[row["doc_id"]])
        assert row["n_email"] == sum(s[0] == "email" for s in base)
        assert row["spans"].startswith(",".join(f"{k}:{a}:{b}" for k, a, b in base))
