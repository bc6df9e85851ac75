"""Personal data: patterns propose spans, check sums confirm them, nearby words move the score.

The base kinds are found by the fixed patterns below and stand whatever words are near. The other
kinds are weaker patterns, which a check sum (IBAN, modulo 97) or words within reach
(national number, local telephone number, passport number) lift above the threshold.

Defined cases: a null text is empty and has no spans; positions count code points, with the end
exclusive; spans of different kinds may overlap. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from lodespark.staging import spread

# A digit run is entered at its first digit only, and never given back: a match from a later
# digit would need the rest that failed already. This keeps long runs of digits linear.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
BASE_KINDS = ("email", "ip", "card", "phone")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")

# Characters of the account numbers of a country.
IBAN_SIZES = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24,
    "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}


@dataclass(frozen=True)
class Weak:
    """A kind whose pattern alone does not reach the threshold."""

    kind: str
    pattern: re.Pattern
    score: float
    context: re.Pattern


THRESHOLD, CONTEXT_BONUS, REACH = 0.6, 0.4, 40
WEAK = (
    Weak(
        "ssn",
        re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
        0.4,
        re.compile(r"\b(?:ssn|social security|national number)\b", re.I),
    ),
    Weak(
        "local_phone",
        re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
        0.3,
        re.compile(r"\b(?:phone|tel|telephone|call|mobile|fax)\b", re.I),
    ),
    Weak(
        "passport",
        re.compile(r"(?<![A-Za-z0-9])[A-Z]{1,2}[0-9]{6,9}(?![A-Za-z0-9])"),
        0.2,
        re.compile(r"\bpassport\b", re.I),
    ),
)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """Check sum of card numbers."""
    total = 0
    for n, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(number: str) -> bool:
    """Check sum of international account numbers: the rest of the moved number is one."""
    moved = number[4:] + number[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``.

    Found from each at sign, with the longest local part that does not reach into the match
    before, so that long words without one cost nothing.
    """
    done, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if domain and start < at:
            yield "email", start, domain.end()
            done = domain.end()
        else:
            done = max(done, at)
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    """Spans of the base kinds, by kind and start."""
    found = list(emails(text))
    for m in IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        number = digits(m.group())
        if 13 <= len(number) <= 19 and luhn(number):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(digits(m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers: of each candidate the beginning that ends where a group does, has the length of
    its country, and passes the check sum, as words in capitals or numbers may follow. Of a
    country that is not listed any length will do, the longest first."""
    at = 0
    while m := IBAN.search(text, at):
        low, high = m.span()
        ends = [n for n in range(low + 15, high + 1) if n == high or text[n] == " "]
        at = high
        for end in reversed(ends):
            number = text[low:end].replace(" ", "")
            wanted = IBAN_SIZES.get(number[:2])
            if (len(number) == wanted if wanted else 15 <= len(number) <= 34) and mod97(number):
                yield low, end
                at = end
                break


def added_spans(text: str) -> list[Span]:
    """Spans of the other kinds that reach the threshold, by kind and start."""
    found = []
    found.extend(("iban", *span) for span in ibans(text))
    for weak in WEAK:
        for m in weak.pattern.finditer(text):
            near = text[max(0, m.start() - REACH) : m.end() + REACH]
            bonus = CONTEXT_BONUS if weak.context.search(near) else 0.0
            if weak.score + bonus >= THRESHOLD:
                found.append((weak.kind, *m.span()))
    return found


def spans(docs: DataFrame) -> DataFrame:
    """``doc_id, base, added`` with arrays of (kind, start, end)."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        )
        names = ("kind", "start", "end")
        for batch in batches:
            base, added = [], []
            for value in batch["text"]:
                text = value.as_py() or ""
                base.append([dict(zip(names, s)) for s in base_spans(text)])
                added.append([dict(zip(names, s)) for s in added_spans(text)])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(base, kind), pa.array(added, kind)],
                names=["doc_id", "base", "added"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    list_ = "array<struct<kind: string, start: int, end: int>>"
    return spread(docs.select("doc_id", "text")).mapInArrow(
        found, f"doc_id {kind}, base {list_}, added {list_}"
    )


def masked(text: str, found: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    parts, at = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2], s[0])):
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])
