import base64
import hashlib
import io
import struct

import pytest
import zstandard
from compare import of_spark, of_sql

from fernweave.llm import warc

PAGE = "<p>" + "same page " * 30


def archive(records, trained=b""):
    out = io.BytesIO()
    writer = warc.Writer(out, trained)
    for r in records:
        writer.write(r, 0)
    return out.getvalue()


def good(payload=b"x" * 10):
    return warc.record_bytes("urn:page:1", "http://a/\r\nb", "2024-01-01T00:00:00Z", payload, hashlib.sha256(payload).hexdigest(), None)


def test_dictionary_frame_and_one_frame_a_record():
    trained = warc.dictionary([PAGE.encode() + bytes([i % 251]) * (i % 50) for i in range(500)])
    assert trained
    data = archive([good(PAGE.encode()), good(b"")], trained)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and data[8 : 8 + size] == trained
    rest, frames = data[8 + size :], 0
    while rest:
        frame = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained)).decompressobj()
        frame.decompress(rest)
        rest, frames = frame.unused_data, frames + 1
    assert frames == 2
    found = list(warc.read_archive(io.BytesIO(data)))
    assert [r.payload for r in found] == [PAGE.encode(), b""] and found[0].uri == "http://a/%0D%0Ab"
    packed = zstandard.ZstdCompressor().compress(trained)  # a dictionary that is compressed itself
    again = struct.pack("<II", magic, len(packed)) + packed + data[8 + size :]
    assert len(list(warc.read_archive(io.BytesIO(again)))) == 2


@pytest.mark.parametrize(
    "broken",
    [
        good().replace(b"WARC/1.1", b"WARX/1.1"),
        good().replace(b"WARC-Date", b"X-Date"),
        good() + b"x",
        good()[:-1],
        good().replace(b"xxxxxxxxxx", b"xxxxxxxxxy"),
        good().replace(b"response\r\nWARC-Rec", b"resource\r\nWARC-Rec"),
    ],
)
def test_unsound_records_are_errors(broken):
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(io.BytesIO(archive([broken]))))


def test_cut_archives_are_errors():
    data = archive([good(), good()])
    for bad in (data[:-3], data[:5], b"\0" * 20):
        with pytest.raises((warc.WarcError, zstandard.ZstdError)):
            list(warc.read_archive(io.BytesIO(bad)))


ROWS = [(5, "u", PAGE), (3, None, PAGE), (9, "u", PAGE), (1, "u", None), (2, "u", ""), (4, "u", "short"), (6, "u", "short"), (7, "u", "é" * 60), (8, "u", "é" * 60), (10, "u", "z" * 300_000)]


@pytest.mark.parametrize("shuffled", [False, True])
def test_query_equals_sql(spark, folder, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(warc, "BROADCAST_ROWS", -1)
    at = folder(pages=ROWS)
    assert of_spark(warc.op2_warc(spark, at)) == of_sql(warc.ORACLE, at)


def test_payloads_come_back(spark, folder):
    out = warc.read_archives(warc.archive_pages(spark.read.parquet(folder(pages=ROWS) + "/pages.parquet")), payloads=True).collect()
    by = {r["record_id"]: bytes(r["payload"]) for r in out if r["record_type"] == "response"}
    assert by["urn:page:3"] == PAGE.encode() and by["urn:page:1"] == b"" and len(out) == len(ROWS)


def test_empty_table_and_null_key(spark, folder):
    at = folder(pages=[])
    assert warc.op2_warc(spark, at).count() == 0
    df = spark.createDataFrame([(None, "u", PAGE, 1), (1, "u", PAGE, 2)], "page_id long, url string, html string, payload int")
    kinds = {r["record_id"]: r["record_type"] for r in warc.read_archives(warc.archive_pages(df)).collect()}
    assert kinds == {"urn:page:none": "response", "urn:page:1": "response"}


def record(kind, block, **fields):
    lines = [f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:1>", "WARC-Date: 2024-02-29T23:59:59Z"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in fields.items()] + [f"Content-Length: {len(block)}"]
    return b"WARC/1.0\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_archives_of_others():
    """All kinds of records, other digests, repeated and folded fields, chunked bodies, no dictionary frame."""
    body = b"<p>body"
    sha1 = base64.b32encode(hashlib.sha1(body).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nSet-Cookie: a\r\nSet-Cookie: b\r\nX-Long: one\r\n two\r\nTransfer-Encoding: chunked\r\nContent-Length: 99\r\n\r\n"
    kind = {"WARC_Target_URI": "<http://a/>", "Content_Type": "application/http; msgtype=response"}
    records = [
        record("warcinfo", b"software: x\r\n", Content_Type="application/warc-fields"),
        record("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", WARC_Target_URI="http://a/", Content_Type="application/http; msgtype=request"),
        record("response", http + body, **kind, WARC_Payload_Digest=f"sha1:{sha1}", WARC_Concurrent_To="<urn:uuid:2>"),
        record("response", b"HTTP/1.1 204 No\r\n\r\n", **kind, WARC_Payload_Digest="blake3:whatever"),
        record("metadata", b"fetchTimeMs: 1", WARC_Refers_To="<urn:uuid:1>"),
        record("resource", body, WARC_Target_URI="http://a/", WARC_Payload_Digest=f"md5:{hashlib.md5(body).hexdigest()}"),
        record("revisit", http, **kind, WARC_Payload_Digest=f"sha1:{sha1}", WARC_Profile="http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
    ]
    data = b"".join(zstandard.ZstdCompressor().compress(r) for r in records)
    found = list(warc.read_archive(io.BytesIO(data)))
    assert [r.kind for r in found] == ["warcinfo", "request", "response", "response", "metadata", "resource", "revisit"]
    assert [r.payload for r in found] == [b"software: x\r\n", b"", body, b"", b"fetchTimeMs: 1", body, b""]
    assert found[2].payload_digest == hashlib.sha256(body).hexdigest() and found[2].uri == "http://a/" and found[6].payload_digest == sha1
    for bad in (
        record("response", http + b"other", **kind, WARC_Payload_Digest=f"sha1:{sha1}"),
        record("response", http + body, **kind, WARC_Payload_Digest="sha1:not base 32"),
        record("resource", body, WARC_Target_URI="http://a/", WARC_Block_Digest=f"sha1:{base64.b32encode(b'x' * 20).decode()}"),
        records[2].replace(b"2024-02-29T23", b"2024-02-29T25"),
        records[2].replace(b"<urn:uuid:1>", b"urn:uuid:1"),
        records[2].replace(b"WARC-Target-URI", b"X-Target"),
        record("odd", body),
    ):
        with pytest.raises(warc.WarcError):
            warc.parsed(bad)


def test_rows_that_repeat_a_key(spark, folder):
    at = folder(pages=[(1, "u", PAGE), (1, "u", PAGE), (2, "u", PAGE), (2, "u", PAGE)])
    assert of_spark(warc.op2_warc(spark, at)) == of_sql(warc.ORACLE, at)


def test_archives_are_removed_when_cleared(spark, tmp_path):
    """What the operator wrote under a name of its own goes; a folder that was asked for stays."""
    from pathlib import Path

    from fernweave.llm.common import cleared

    df = spark.createDataFrame([(1, "http://h/", PAGE)], "page_id long, url string, html string")
    cleared(spark)
    listed = [r["path"] for r in warc.archive_pages(df).select("path").collect()]
    at = [Path(p.removeprefix("file:")) for p in listed]
    assert at and all(p.exists() for p in at)
    kept = warc.archive_pages(df, at=f"file://{tmp_path}/kept")
    assert kept.count() and cleared(spark) >= 2
    assert not any(p.exists() for p in at) and list((tmp_path / "kept").iterdir())
