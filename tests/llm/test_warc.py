from __future__ import annotations

import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from lodespark.llm import queries, warc
from lodespark.llm.storage import new_folder
from tests.compare import connect, differences
from tests.llm.conftest import ODD_TEXTS

SCHEMA = "page_id long, url string, html string"


def brute(pages):
    """Rows of (page_id, size, digest, type, refers_to) by a plain loop over equal payloads."""
    out, by = [], {}
    for page, _, html in pages:
        by.setdefault((html or "").encode(), []).append(page)
    for payload, ids in by.items():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        for n, page in enumerate(ids):
            again = n > 0 and len(payload) >= 1000
            digest = hashlib.sha1(payload).hexdigest()
            out.append((page, len(payload), digest, "revisit" if again else "response", ids[0] if again else None))
    return sorted(out, key=str)


def round_trip(spark, pages, **sizes):
    folder = new_folder(spark, "archives")
    warc.write(pages, folder, **sizes)
    records = warc.read(spark, folder)
    found = warc.resolved(records)
    assert found.where("problem is not null").count() == 0
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return records, sorted((tuple(r[n] for n in names) for r in found.collect()), key=str)


def pages():
    rng = random.Random(4)
    long = ["".join(rng.choices("abc <>é😀\r\n0", k=k)) for k in (999, 1000, 5000, 70000)]
    texts = [*ODD_TEXTS, *long, "\r\n\r\nWARC/1.1\r\n0\r\n\r\n" * 300, "a" * 999, "a" * 1000]
    rows = [(n, f"http://x/{n}\r\nWARC-Type: y é", t) for n, t in enumerate(texts)]
    rows += [(100 + n, None, t) for n, t in enumerate(texts)] + [(7, "u", long[2]), (None, None, long[2])]
    return rows + [(103, None, texts[3]), (107, "u", texts[7]), (107, "u", texts[7])]


@pytest.mark.parametrize("segment, archive", [(warc.SEGMENT, warc.ARCHIVE), (100, 3000)])
def test_round_trip(spark, frame, segment, archive):
    rows = pages()
    df = frame(rows, SCHEMA).repartition(3).withColumn("payload", F.lit(1)).withColumn("row", F.lit(2))
    records, found = round_trip(spark, df, segment=segment, archive=archive)
    assert found == brute(rows)
    texts = {(r["page_id"], bytes(r["payload"]).decode()) for r in records.where("payload is not null").collect()}
    assert texts <= {(i, t or "") for i, _, t in rows}


def test_empty_table(spark, frame):
    assert round_trip(spark, frame([], SCHEMA))[1] == []


def test_a_large_group_of_copies(spark):
    df = spark.range(3000).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.when(F.col("id") % 3 == 0, "a").otherwise(F.col("id").cast("string")), 1000).alias("html")
    )
    rows = [(r["page_id"], r["url"], r["html"]) for r in df.collect()]
    assert round_trip(spark, df)[1] == brute(rows)


def segments(block, cuts, total=None, kind="response"):
    """Records of a message, cut at given places."""
    parts = [block[a:b] for a, b in zip([0, *cuts], [*cuts, len(block)])]
    out = []
    for n, part in enumerate(parts, 1):
        fields = {"WARC-Type": kind if n == 1 else "continuation", "WARC-Segment-Number": n}
        fields |= {"WARC-Record-ID": "<o>"} if n == 1 else {"WARC-Record-ID": f"<c{n}>", "WARC-Segment-Origin-ID": "<o>"}
        if n == len(parts):
            fields["WARC-Segment-Total-Length"] = len(block) if total is None else total
        out.append(warc.record(fields, part))
    return out


MESSAGE = b"HTTP/1.1 200 OK\r\ntransfer-encoding:\r\n  Chunked\r\n\r\n"
BODY = b"5;name=x\r\nhello\r\n1 \r\n \r\n6\r\nworld!\r\n0\r\nTrailer: 1\r\n\r\n"


def files(tmp_path, *archives):
    for n, records in enumerate(archives):
        plain = n % 2 == 1
        (tmp_path / f"{n}.warc{'' if plain else '.gz'}").write_bytes(
            b"".join(gzip.decompress(r) if plain else r for r in records)
        )
    return str(tmp_path)


def test_segments_of_different_archives(spark, tmp_path):
    one, two, three = segments(MESSAGE + BODY, [20, 70])
    other = warc.record({"WARC-Type": "request", "WARC-Record-ID": "<r>"}, b"GET /")
    folder = files(tmp_path, [three, other], [two, one])
    (row,) = warc.read(spark, folder).collect()
    assert bytes(row["payload"]) == b"hello world!" and row["problem"] is None and row["record_id"] == "<o>"


@pytest.mark.parametrize("spoil", ["lost", "first", "twice", "total", "framing", "open"])
def test_spoilt_segments(spark, tmp_path, spoil):
    body = {"framing": BODY.replace(b"6\r\n", b"7\r\n"), "open": BODY[:-2].replace(b"Trailer: 1\r\n", b"")}.get(spoil, BODY)
    records = segments(MESSAGE + body, [20, 70], 5 if spoil == "total" else None)
    records = {"lost": [records[0], records[2]], "first": records[1:], "twice": [*records, records[1]]}.get(spoil, records)
    (row,) = warc.read(spark, files(tmp_path, records)).collect()
    assert row["payload"] is None and row["problem"]


def test_spoilt_archives(spark, tmp_path):
    fine = warc.record({"WARC-Type": "response", "WARC-Record-ID": "<a>"}, b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nabc")
    wrong = warc.record({"WARC-Type": "response", "WARC-Payload-Digest": "sha1:A"}, b"HTTP/1.1 200 OK\r\n\r\nabc")
    lone = warc.record({"WARC-Type": "revisit", "WARC-Refers-To": "<none>"}, b"")
    folder = files(tmp_path, [fine, wrong, fine[:60]], [fine, gzip.compress(b"junk\r\n")], [lone])
    records = warc.read(spark, folder)
    rows = records.collect()
    assert sorted(bytes(r["payload"]) for r in rows if r["payload"] is not None) == [b"ab", b"ab"]
    assert sum(r["problem"] is not None for r in rows) == 3
    found = warc.resolved(records).where("record_type = 'revisit'").collect()
    assert [r["problem"] for r in found] == ["it refers to no response that can be read"]


def test_chunks():
    for payload in (b"", b"a", b"\r\n" * 9, bytes(range(256)) * 5):
        for size in (1, 7, 1 << 13):
            assert warc.unchunked(warc.chunked(payload, size)) == payload
    for body in (b"", b"x\r\n", b"-1\r\na", b"1\r\na", b"0x1\r\na\r\n0\r\n\r\n", b"0\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(body)
    assert list(warc.parsed(io.BytesIO(b"\r\n\r\n"))) == []


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert differences(queries.op13_web_archives(spark, sf_dir), connect(sf_dir), warc.SQL) == ""
