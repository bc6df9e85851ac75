"""Web archives: records written in segments and chunks, and read back whole.

A response is an HTTP message with a body in chunks. One that is longer than a segment is cut:
the rest follows in continuation records, which name the first as their origin and count up, the
last with the length of all. A payload that is at least ``LEAST_REPEATED`` bytes long and comes again is written once, by
the page with the largest id; the others are revisits that refer to it. Every record is a gzip
member of its own.

The reader streams through archives, of whoever wrote them. Records that are not cut are decoded where they
lie; segments, which may lie in different archives, are grouped by their origin, put in order, checked
against their numbers and the total length, joined, and freed from chunk framing.

Defined cases: a null text is an empty payload; null page ids sort below all others; of rows with
the same largest id and payload one is the response; control characters of an address are percent-encoded,
and a null address is left out. ``problem`` says what is wrong with a record whose segments,
framing, length or digest do not fit, and with an archive that breaks off; payloads are then null. Records
of other types are skipped. Other columns are ignored. A page must fit in a row, as in its table.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from contextlib import ExitStack

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodespark.llm.lookup import looked_up
from lodespark.llm.storage import opened, replacing
from lodespark.staging import spread, stage

SEGMENT = 1 << 15
CHUNK = 1 << 13
ARCHIVE = 1 << 28
# Shorter payloads are written as often as they come.
LEAST_REPEATED = 1000
DATE = "2000-01-01T00:00:00Z"
# Fixed value: the profile of revisits.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Bytes of records that a batch holds.
GROUP = 1 << 22

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_SIZE = re.compile(rb"[0-9A-Fa-f]+")


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """A body in chunks: length in hexadecimal, line end, bytes, line end; a chunk of length 0 ends it."""
    parts = []
    for low in range(0, len(payload), size):
        part = payload[low : low + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The bytes of a body in chunks; extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        if not _SIZE.fullmatch(size):
            raise ValueError(f"no chunk length at byte {at} of the body")
        low, at = end + 2, end + 2 + int(size, 16)
        if low == at:
            trailers = body[low:]
            if trailers != b"\r\n" and not trailers.endswith(b"\r\n\r\n"):
                raise ValueError("the body breaks off behind its last chunk")
            return b"".join(parts)
        if body[at : at + 2] != b"\r\n":
            raise ValueError(f"the chunk before byte {at} of the body is not closed")
        parts.append(body[low:at])
        at += 2


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP message."""
    head, end, body = block.partition(b"\r\n\r\n")
    if not end:
        raise ValueError("the message has no end of its header")
    fields = _fields(head.split(b"\r\n")[1:])
    if "chunked" in fields.get("transfer-encoding", "").lower():
        return unchunked(body)
    size = fields.get("content-length", str(len(body)))
    if not size.isdecimal() or int(size) > len(body):
        raise ValueError("the body is shorter than its length")
    return body[: int(size)]


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Header fields by lower-case name; an indented line goes on with the one before."""
    fields: dict[str, str] = {}
    name = ""
    for line in lines:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and name:
            fields[name] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def record(fields: dict[str, str | int | None], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = [f"{name}: {value}" for name, value in fields.items() if value is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""])
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _urn(*parts) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, '/'.join(map(str, parts))).urn}>"


def page_records(folder: str, row: int, page, url, payload: bytes, refers: int | None, segment: int) -> Iterator[bytes]:
    """The records of a page: a revisit, or a response and its continuations."""
    own = _urn(folder, row)
    digest = hashlib.sha1(payload).digest()
    fields = {
        "WARC-Type": "response",
        "WARC-Record-ID": own,
        "WARC-Date": DATE,
        "WARC-Target-URI": url and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Page-ID": page,
        "WARC-Payload-Digest": f"sha1:{base64.b32encode(digest).decode()}",
        "Content-Type": "application/http;msgtype=response",
    }
    if refers is not None:
        repeated = {"WARC-Type": "revisit", "WARC-Profile": PROFILE, "WARC-Refers-To": _urn(folder, refers)}
        yield record(fields | repeated, _HTTP)
        return
    block = _HTTP + chunked(payload)
    if len(block) <= segment:
        yield record(fields, block)
        return
    yield record(fields | {"WARC-Segment-Number": 1}, block[:segment])
    for number, low in enumerate(range(segment, len(block), segment), 2):
        rest = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": _urn(folder, row, number),
            "WARC-Date": DATE,
            "WARC-Segment-Origin-ID": own,
            "WARC-Segment-Number": number,
            "WARC-Segment-Total-Length": len(block) if low + segment >= len(block) else None,
        }
        yield record(rest, block[low : low + segment])


def repeats(rows: DataFrame) -> DataFrame:
    """``row, refers`` of the rows (row, page_id, payload) that repeat the payload of another."""
    long = stage(
        rows.where(F.octet_length("payload") >= LEAST_REPEATED).select(
            "row", "page_id", F.sha2("payload", 256).alias("same")
        )
    )
    groups = (
        long.groupBy("same")
        .agg(F.count("*").alias("n"), F.max(F.struct("page_id", "row")).alias("top"))
        .where("n > 1")
        .select("same", "n", F.col("top.row").alias("refers"))
    )
    return looked_up(long, stage(groups), ["same"], "n").where("row != refers").select("row", "refers")


def write(pages: DataFrame, folder: str, segment: int = SEGMENT, archive: int = ARCHIVE) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) to archives in ``folder``.

    A task fills its archives one after the other. The rows are kept with a number each, which says
    which of several equal rows is the response.
    """
    rows = stage(
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("page_id").cast("long").alias("page_id"),
            "url",
            F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
        )
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        out, size, count, done = None, 0, 0, []
        with ExitStack() as files:
            for batch in batches:
                for row in zip(*batch.columns):
                    for packed in page_records(folder, *(x.as_py() for x in row), segment):
                        if out is None or size >= archive:
                            if out is not None:
                                files.close()
                                done.append((name, count, size))
                            name = f"{folder}/archive-{task:06d}-{len(done):04d}.warc.gz"
                            out, size, count = files.enter_context(replacing(name)), 0, 0
                            info = {"WARC-Type": "warcinfo", "WARC-Record-ID": _urn(name), "WARC-Date": DATE}
                            size += out.write(record(info, b""))
                        size += out.write(packed)
                        count += 1
        if out is not None:
            done.append((name, count, size))
        names = ("archive", "records", "bytes")
        yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in done], index)

    index = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
    told = spread(rows).join(stage(repeats(rows)), "row", "left")
    told.select("row", "page_id", "url", "payload", "refers").mapInArrow(
        written, "archive string, records long, bytes long"
    ).write.parquet(f"{folder}/index")


def parsed(source) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """Header fields, block and problem of each record of an open archive, a buffered stream."""
    while True:
        try:
            line = source.readline()
            while line in (b"\r\n", b"\n"):
                line = source.readline()
            if not line:
                return
            if not line.startswith(b"WARC/"):
                yield {}, b"", "no record starts where the one before ends"
                return
            lines = []
            while (line := source.readline().rstrip(b"\r\n")) != b"":
                lines.append(line)
            fields = _fields(lines)
            size = fields.get("content-length", "")
            block = source.read(int(size)) if size.isdecimal() else b""
        except (EOFError, OSError, zlib.error) as error:
            yield {}, b"", f"the archive breaks off: {error}"
            return
        if not size.isdecimal() or len(block) < int(size):
            yield fields, b"", "the record breaks off"
            return
        yield fields, block, None


_SEGMENTS = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("page_id", pa.int64()),
        ("uri", pa.string()),
        ("refers_id", pa.string()),
        ("declared", pa.string()),
        ("segment", pa.int64()),
        ("total", pa.int64()),
        ("block", pa.binary()),
        ("problem", pa.string()),
    ]
)
_SEGMENT_COLUMNS = (
    "record_id string, record_type string, page_id long, uri string, refers_id string, declared string,"
    " segment long, total long, block binary, problem string"
)
_RECORDS = pa.schema(
    [_SEGMENTS.field(n) for n in range(6)] + [pa.field("payload", pa.binary()), _SEGMENTS.field("problem")]
)
_RECORD_COLUMNS = (
    "record_id string, record_type string, page_id long, uri string, refers_id string, declared string,"
    " payload binary, problem string"
)


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d{1,18}", text) else None


def _row(fields: dict[str, str], block: bytes, problem: str | None) -> dict:
    """A record as a row; continuations go by the id of their origin."""
    digest = fields.get("warc-payload-digest", "")
    own = fields.get("warc-segment-origin-id") or fields.get("warc-record-id")
    return {
        "record_id": own,
        "record_type": fields.get("warc-type"),
        "page_id": _number(fields.get("warc-page-id")),
        "uri": fields.get("warc-target-uri"),
        "refers_id": fields.get("warc-refers-to"),
        "declared": digest if digest.startswith("sha1:") else None,
        "segment": _number(fields.get("warc-segment-number")),
        "total": _number(fields.get("warc-segment-total-length")),
        "block": block,
        "problem": problem,
    }


def _decoded(row: dict) -> dict:
    """A whole record: its message without framing, checked against its digest; a revisit has none."""
    out = {name: row[name] for name in _RECORDS.names if name != "payload"} | {"payload": None}
    if row["problem"] is None and row["record_type"] == "response":
        try:
            payload = http_payload(row["block"])
            found = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if row["declared"] not in (None, found):
                raise ValueError("the payload does not have its digest")
            out["payload"] = payload
        except ValueError as error:
            out["problem"] = str(error)
    return out


def _batched(rows: Iterator[dict], schema: pa.Schema, size: str) -> Iterator[pa.RecordBatch]:
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += len(row[size] or b"")
        if total >= GROUP or len(held) >= 4096:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def joined(segments: list[dict]) -> dict:
    """The record of all segments of an origin, in the order of their numbers."""
    first = next((s for s in segments if s["record_type"] != "continuation"), None)
    whole = dict(first or segments[0])
    numbers = [s["segment"] for s in segments]
    totals = {s["total"] for s in segments if s["total"] is not None}
    block = b"".join(s["block"] for s in segments)
    if problems := [s["problem"] for s in segments if s["problem"]]:
        whole["problem"] = problems[0]
    elif first is None or numbers != list(range(1, len(numbers) + 1)):
        whole["problem"] = f"segments {numbers[:20]} are not all there, each once"
    elif totals != {len(block)}:
        whole["problem"] = f"the segments have {len(block)} bytes, not {sorted(totals)}"
    return _decoded(whole | {"block": block})


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``record_id, record_type, page_id, uri, refers_id, declared, payload, problem`` of the
    responses and revisits in the archives (``*.warc``, ``*.warc.gz``) of a folder.

    Archives are listed by Spark and streamed by the tasks. Only segments are shuffled.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.{warc,warc.gz}").load(folder)
    archives = listed.select("path")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                with opened(path) as raw:
                    packed = path.endswith(".gz")
                    for found in parsed(gzip.GzipFile(fileobj=raw) if packed else io.BufferedReader(raw, 1 << 20)):
                        yield _row(*found)

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            _decoded(r)
            for r in records(batches)
            if r["record_type"] in ("response", "revisit") and r["segment"] is None or r["record_type"] is None
        )
        yield from _batched(rows, _RECORDS, "payload")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            r
            for r in records(batches)
            if r["record_type"] == "continuation" or r["record_type"] == "response" and r["segment"] is not None
        )
        yield from _batched(rows, _SEGMENTS, "block")

    def reassembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def wholes() -> Iterator[dict]:
            held: list[dict] = []
            for batch in batches:
                for row in batch.to_pylist():
                    if held and held[0]["record_id"] != row["record_id"]:
                        yield joined(held)
                        held = []
                    held.append(row)
            if held:
                yield joined(held)

        yield from _batched(wholes(), _RECORDS, "payload")

    # A segment with neither an origin nor an id of its own belongs to no other.
    origin = F.coalesce("record_id", F.concat(F.lit("none-"), F.monotonically_increasing_id().cast("string")))
    cut = archives.mapInArrow(segments, _SEGMENT_COLUMNS).withColumn("record_id", origin)
    whole = cut.repartition("record_id").sortWithinPartitions("record_id", "segment")
    return archives.mapInArrow(complete, _RECORD_COLUMNS).unionByName(
        whole.mapInArrow(reassembled, _RECORD_COLUMNS)
    )


def resolved(records: DataFrame) -> DataFrame:
    """``page_id, uri, payload_bytes, payload_digest, record_type, refers_to, problem`` per record.

    Size, digest and page of a revisit are those of the response that it refers to; one that refers to no
    response of the archives has a problem.
    """
    facts = stage(
        records.select(
            *("record_id", "record_type", "page_id", "uri", "refers_id", "declared", "problem"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.sha1("payload").alias("payload_digest"),
        )
    )
    plain = facts.where("refers_id is null or record_type != 'revisit'")
    again = facts.where("refers_id is not null and record_type = 'revisit'")
    counted = again.groupBy("refers_id").agg(F.count("*").alias("n"))
    found = facts.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_id"),
        F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("bytes"),
        F.col("payload_digest").alias("digest"),
        F.col("declared").alias("first_declared"),
    )
    table = stage(counted.join(found, "refers_id", "left").dropDuplicates(["refers_id"]))
    differs = ~F.col("declared").eqNullSafe(F.col("first_declared"))
    problem = F.when(F.col("bytes").isNull(), "it refers to no response that can be read").when(
        differs, "its digest is not that of the response"
    )
    names = ("page_id", "uri", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")
    return plain.withColumn("refers_to", F.lit(None).cast("long")).select(*names).unionByName(
        looked_up(again, table, ["refers_id"], "n")
        .withColumns(
            {"payload_bytes": F.col("bytes"), "payload_digest": F.col("digest"), "problem": F.coalesce("problem", problem)}
        )
        .select(*names)
    )


# The records of ``pages`` in SQL.
SQL = f"""
WITH told AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
ranked AS (
  SELECT page_id, html, strlen(html) AS size,
    row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) AS place,
    max(page_id) OVER (PARTITION BY html) AS top FROM told)
SELECT page_id, size::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN place > 1 AND size >= {LEAST_REPEATED} THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN place > 1 AND size >= {LEAST_REPEATED} THEN top END AS refers_to
FROM ranked
"""
