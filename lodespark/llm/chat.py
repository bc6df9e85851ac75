"""Chat records of different layouts as turns, and turns as marked text with a loss mask.

A record is a JSON text. The paths of its nested fields, with array positions left out, make
its fingerprint, which selects a mapping: for each turn a role and where its text lies. Records
with the same fields need no code of their own; a new layout is a new line in ``MAPPINGS``.

The template puts each turn on its own as ``<s>role`` newline ``text</s>`` newline. Control
strings inside roles and texts get a backslash after their first character, and backslashes
are doubled, so that the marks are unambiguous and ``read_back`` restores every text.

Defined cases: a null record, one that is no JSON object, and one whose fingerprint no mapping
covers give no turns and ``mapping`` null; null or missing texts and roles are empty. Turns
are ordered by (turn, position in the record, role, text); a null turn comes first. Equal rows
count as often as they come. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodespark.llm.storage import partitions
from lodespark.staging import spread


def paths(value, above: str = "") -> set[str]:
    """Paths of the fields of a JSON value; all elements of an array share theirs."""
    if isinstance(value, dict):
        below = (paths(v, f"{above}.{k}") for k, v in value.items())
        return {f"{above}.{k}" for k in value}.union(*below)
    if isinstance(value, list):
        return {f"{above}[]"}.union(*(paths(v, f"{above}[]") for v in value))
    return set()


def fingerprint(fields: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(fields)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns: fixed fields with their roles, then a list of messages."""

    name: str
    fields: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()  # (role, field)
    messages: str | None = None  # field of the list; "" for a record that is one message
    role: str = "role"
    text: str = "content"


MAPPINGS = (
    Mapping("row", (".role", ".text"), messages="", text="text"),
    Mapping("message", (".role", ".content"), messages=""),
    Mapping(
        "messages",
        (".messages", ".messages[]", ".messages[].role", ".messages[].content"),
        messages="messages",
    ),
    Mapping(
        "conversations",
        (".conversations", ".conversations[]", ".conversations[].from", ".conversations[].value"),
        messages="conversations",
        role="from",
        text="value",
    ),
    Mapping(
        "prompt", (".prompt", ".completion"), (("user", "prompt"), ("assistant", "completion"))
    ),
    Mapping(
        "prompt_response", (".prompt", ".response"), (("user", "prompt"), ("assistant", "response"))
    ),
    Mapping(
        "question", (".question", ".answer"), (("user", "question"), ("assistant", "answer"))
    ),
    Mapping(
        "instruction",
        (".instruction", ".output"),
        (("user", "instruction"), ("assistant", "output")),
    ),
    Mapping(
        "instruction_input",
        (".instruction", ".input", ".output"),
        (("system", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
    Mapping(
        "system_messages",
        (".system", ".messages", ".messages[]", ".messages[].role", ".messages[].content"),
        (("system", "system"),),
        messages="messages",
    ),
)
BY_FINGERPRINT = {fingerprint(set(m.fields)): m for m in MAPPINGS}
# Other names of the three roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def canonical(record: str | None) -> tuple[str | None, list[tuple[str, str]]]:
    """Name of the mapping, and the turns as (role, text)."""
    try:
        value = json.loads(record or "null")
    except ValueError:
        return None, []
    mapping = BY_FINGERPRINT.get(fingerprint(paths(value))) if isinstance(value, dict) else None
    if mapping is None:
        return None, []
    found = [(role, value[field]) for role, field in mapping.turns]
    if mapping.messages is not None:
        messages = value[mapping.messages] if mapping.messages else [value]
        found += [(m.get(mapping.role), m.get(mapping.text)) for m in messages]
    return mapping.name, [(ROLES.get(r, _string(r)), _string(t)) for r, t in found]


def _string(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


# Control strings of common templates, the first two also those of this one.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")
LEARNT = "assistant"
_ESCAPED = re.compile("|".join(map(re.escape, ("\\", *CONTROLS))))
_BACKSLASHED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<s>((?:[^\\\n]|\\.)*)\n((?:(?!</s>).)*)</s>\n", re.S)


def escape(text: str) -> str:
    """Put a backslash behind each backslash and the first character of each control string."""
    return _ESCAPED.sub(lambda m: m.group()[0] + "\\" + m.group()[1:], text)


def unescape(text: str) -> str:
    return _BACKSLASHED.sub(r"\1", text)


def formatted(role: str, text: str) -> tuple[str, list[tuple[int, int]]]:
    """One turn as marked text, and the span of it that is learnt."""
    head = "<s>" + escape(role).replace("\n", "\\\n") + "\n"
    body = escape(text)
    learnt = [(len(head), len(head) + len(body))] if role == LEARNT else []
    return f"{head}{body}</s>\n", learnt


def read_back(marked: str) -> list[tuple[str, str]]:
    """The turns of a marked text."""
    turns, at = [], 0
    while at < len(marked):
        found = _TURN.match(marked, at)
        if found is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def marked(records: DataFrame) -> DataFrame:
    """``conv_id, turn, position, mapping, segment, learnt`` from (conv_id, turn, record).

    A row per turn, made row by row: the text of a conversation is that of its segments in
    order. ``learnt`` is the span of the segment under the loss mask, null if there is none. A record
    without turns has one row with a null segment.
    """

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for conv, turn, record in zip(*(c.to_pylist() for c in batch.columns)):
                mapping, found = canonical(record)
                for position, (role, text) in enumerate(found):
                    segment, learnt = formatted(role, text)
                    low, high = learnt[0] if learnt else (None, None)
                    rows.append((conv, turn, position, mapping, segment, low, high))
                if not found:
                    rows.append((conv, turn, 0, mapping, None, None, None))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(schema.names, row)) for row in rows], schema
            )

    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("turn", pa.int64()),
            ("position", pa.int32()),
            ("mapping", pa.string()),
            ("segment", pa.string()),
            ("learnt_start", pa.int32()),
            ("learnt_end", pa.int32()),
        ]
    )
    rows = records.select(*(F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")), "record")
    return spread(rows).mapInArrow(
        turns,
        "conv_id long, turn long, position int, mapping string, segment string,"
        " learnt_start int, learnt_end int",
    )


def digests(segments: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, read back from its segments.

    ``turns_sha256`` covers role, newline, text, newline of each turn; ``loss_sha256`` the texts
    under the loss mask with nothing between. Segments are parsed where they lie. A digest
    follows the order of a conversation, so its parts stream through one task in that order, of which
    the task holds one batch at a time.
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told, learnt, chars = [], [], []
            for segment, low, high in zip(
                *(batch[c].to_pylist() for c in ("segment", "learnt_start", "learnt_end"))
            ):
                ((role, text),) = read_back(segment)
                told.append(f"{role}\n{text}\n")
                learnt.append(None if low is None else unescape(segment[low:high]))
                chars.append(len(segment))
            kept = batch.select(["conv_id", "turn", "position"])
            added = (pa.array(told, pa.string()), pa.array(learnt, pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *added, pa.array(chars, pa.int64())],
                names=["conv_id", "turn", "position", "told", "learnt", "chars"],
            )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list | None = None  # conversation, turns, digest, learnt characters, digest, characters

        def closed(rows: list[list]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * 6
            conv, turns, told, loss_chars, loss, chars = columns
            return pa.RecordBatch.from_pydict(
                {
                    "conv_id": pa.array(conv, pa.int64()),
                    "n_turns": pa.array(turns, pa.int64()),
                    "turns_sha256": pa.array([d.hexdigest() for d in told], pa.string()),
                    "loss_chars": pa.array(loss_chars, pa.int64()),
                    "loss_sha256": pa.array([d.hexdigest() for d in loss], pa.string()),
                    "formatted_chars": pa.array(chars, pa.int64()),
                }
            )

        for batch in batches:
            done = []
            columns = (batch[c].to_pylist() for c in ("conv_id", "told", "learnt", "chars"))
            for conv, told, learnt, chars in zip(*columns):
                if open_ is None or open_[0] != conv:
                    if open_ is not None:
                        done.append(open_)
                    open_ = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                open_[1] += 1
                open_[2].update(told.encode())
                open_[3] += len(learnt or "")
                open_[4].update((learnt or "").encode())
                open_[5] += chars
            yield closed(done)
        if open_ is not None:
            yield closed([open_])

    told = segments.where("segment is not null").mapInArrow(
        parsed, "conv_id long, turn long, position int, told string, learnt string, chars long"
    )
    return (
        told.repartition(partitions(segments), "conv_id")
        .sortWithinPartitions("conv_id", "turn", "position", "told")
        .mapInArrow(
            hashed,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long,"
            " loss_sha256 string, formatted_chars long",
        )
    )


# The digests of one-message records in SQL; an escape adds a character.
SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
told AS (
  SELECT *, role || chr(10) || text || chr(10) AS said,
    8 + length(role) + length(text) + len(regexp_extract_all(role || chr(10) || text,
      '\\|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\|im_start\|>|<\|im_end\|>')) + 1
      + length(role) - length(replace(role, chr(10), '')) AS chars
  FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(said, '' ORDER BY turn NULLS FIRST, said)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, said)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM told GROUP BY conv_id
"""
