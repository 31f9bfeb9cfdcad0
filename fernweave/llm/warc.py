"""WARC archives compressed with Zstandard: one frame for each record, a dictionary in the leading skippable frame.

The writer's tasks each train a dictionary on their first payloads, put it into
a skippable frame (magic 0x184D2A5D) at the head of each archive, and compress
every record to a frame of its own. Archives hold some ``ARCHIVE_BYTES`` of
payload, are written to the shared folder under names that no other attempt of
a task uses, and are listed in a Parquet table; Spark commits the list of one
attempt only, so a lost executor or a task run twice leaves files that nothing
reads.

The reader streams an archive, its own or another's: it loads the dictionary,
if there is one, decodes one frame at a time, and checks each record's version
line, fields, date, lengths and digest. It knows all kinds of records, digests
by SHA-256, SHA-1 and MD5 in hex or Base32, and fields that repeat. A record that
fails is an error, never skipped.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernweave.llm.common import Scratch, bounded_batches, left, shared_dir, table, written

#: The skippable frame that holds the dictionary, and the magic of a data frame (fixed by the formats).
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
VERSION = b"WARC/1.1"
#: The profile of revisits by digest (fixed by the format).
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of payload in an archive about, of a dictionary, of its samples, and of one read.
ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES, READ_BYTES = 32 << 20, 32 << 10, 2 << 20, 1 << 18
#: Shorter payloads are stored again rather than referred to (fixed by the contract).
LEAST_REVISIT = 100
#: Duplicated payloads whose table (under 100 bytes each) is broadcast; more are joined by a shuffle, salted.
BROADCAST_ROWS, SALTS = 100_000, 16


class WarcError(ValueError):
    """An archive or record that does not keep to the format."""


@dataclass
class Record:
    kind: str
    record_id: str
    uri: str
    refers_to: str | None
    payload_bytes: int
    payload_digest: str
    payload: bytes


def field(text: str) -> str:
    """A header value: line ends and other controls are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def record_bytes(record_id: str, uri: str, date: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """A response record, or a revisit record if it refers to another; without compression."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    lines = [
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: <{field(record_id)}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {field(uri)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{field(refers_to)}>"]
    lines.append(f"Content-Length: {len(block)}")
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


#: Fields that every record has, and the kinds of records (fixed by the format).
FIELDS = ("warc-type", "warc-record-id", "warc-date", "content-length")
KINDS = set("warcinfo response resource request metadata revisit conversion continuation".split())
DATE = re.compile(r"\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])T([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d{1,9})?Z")
RECORD_ID = re.compile(r"<[A-Za-z][A-Za-z0-9+.-]*:[^<>\s]+>")
#: Bytes of the digests that are checked.
DIGESTS = {"sha256": 32, "sha1": 20, "md5": 16}


def headers(lines: bytes, once: tuple[str, ...] = ()) -> dict[str, str]:
    """Fields by lower-case name, of repeated ones the first; those of ``once`` must not repeat. A line that
    begins with white space goes on with the one before."""
    out: dict[str, str] = {}
    name = ""
    for line in lines.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"not a header line: {line[:80]!r}")
        name = name.lower()
        if name in out and name in once:
            raise WarcError(f"{name} stands twice")
        out.setdefault(name, value.strip())
    return out


def digest_holds(labelled: str, payload: bytes) -> bool:
    """Whether a labelled digest (``sha1:...``) is that of the payload; digests of other kinds are taken as they are."""
    kind, _, value = labelled.partition(":")
    kind = kind.lower().replace("-", "")
    if kind not in DIGESTS:
        return True
    try:
        given = bytes.fromhex(value) if len(value) == 2 * DIGESTS[kind] else base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except (ValueError, binascii.Error):
        return False
    return given == hashlib.new(kind, payload).digest()


def parsed(data: bytes) -> Record:
    """The record of one frame; raises ``WarcError`` if a field, a length or the digest is wrong.

    The payload is the body of an HTTP message, else the block. Its digest is
    given as bare hex SHA-256; that of a revisit, which has no payload, and its
    length are what its fields say.
    """
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version not in (b"WARC/1.0", VERSION):
        raise WarcError("no version line or end of header")
    own = headers(lines, FIELDS)
    for name in FIELDS:
        if name not in own:
            raise WarcError(f"no {name}")
    kind, refers_to = own["warc-type"], own.get("warc-refers-to")
    if kind not in KINDS or (kind not in ("warcinfo", "metadata", "continuation") and "warc-target-uri" not in own):
        raise WarcError(f"no known kind of record or no target: {kind}")
    if not DATE.fullmatch(own["warc-date"]) or not RECORD_ID.fullmatch(own["warc-record-id"]):
        raise WarcError(f"no date or no id: {own['warc-date']} {own['warc-record-id']}")
    if not own["content-length"].isdigit() or len(rest) != int(own["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError("the content length does not match the frame")
    block = payload = rest[:-4]
    length = ""
    if own.get("content-type", "").lower().startswith("application/http") and kind in ("response", "revisit", "request"):
        message, gap, payload = block.partition(b"\r\n\r\n")
        status, _, lines = message.removesuffix(b"\r\n").partition(b"\r\n")
        if not gap or b"HTTP/" not in status:
            raise WarcError("no HTTP header in the block")
        http = headers(lines) if lines else {}
        length = http.get("content-length", "")
        # Bodies that are cut, chunked or packed have other lengths than the server said.
        plain = "warc-truncated" not in own and "transfer-encoding" not in http and "content-encoding" not in http
        if kind == "response" and plain and length and (not length.isdigit() or int(length) != len(payload)):
            raise WarcError("the payload does not match its length")
    labelled = own.get("warc-payload-digest", "")
    if kind == "revisit":
        if "warc-profile" not in own or payload.strip() and "identical-payload-digest" in own["warc-profile"]:
            raise WarcError("not a sound revisit")
        size, digest = int(length) if length.isdigit() else 0, labelled.partition(":")[2]
    else:
        if refers_to and kind == "response":
            raise WarcError("a response refers to no other record")
        if labelled and "warc-truncated" not in own and not digest_holds(labelled, payload):
            raise WarcError("the payload does not match its digest")
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    if not digest_holds(own.get("warc-block-digest", ""), block):
        raise WarcError("the block does not match its digest")
    bare = lambda x: x and x.removeprefix("<").removesuffix(">")
    return Record(kind, bare(own["warc-record-id"]), bare(own.get("warc-target-uri", "")), bare(refers_to), size, digest, payload)


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained on the samples; empty if they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b""


class Writer:
    """Writes one archive to a binary stream."""

    def __init__(self, out: BinaryIO, trained: bytes):
        self.out, self.records, self.payload = out, 0, 0
        out.write(struct.pack("<II", DICTIONARY_MAGIC, len(trained)) + trained)
        given = {"dict_data": zstandard.ZstdCompressionDict(trained)} if trained else {}
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True, **given)

    def write(self, record: bytes, payload: int) -> None:
        self.out.write(self.compressor.compress(record))
        self.records += 1
        self.payload += payload


def read_archive(source: BinaryIO) -> Iterator[Record]:
    """The records of one archive, a frame at a time."""
    head = source.read(8)
    if not head:
        return
    magic = struct.unpack("<I", head[:4])[0] if len(head) == 8 else 0
    if magic not in (DICTIONARY_MAGIC, FRAME_MAGIC):
        raise WarcError("neither a dictionary nor a frame at the head")
    trained, held = b"", head
    if magic == DICTIONARY_MAGIC:
        size = struct.unpack("<I", head[4:])[0]
        trained, held = source.read(size), b""
        if len(trained) != size:
            raise WarcError("the dictionary is cut")
        if trained[:4] == struct.pack("<I", FRAME_MAGIC):  # it may be compressed itself
            trained = zstandard.ZstdDecompressor().decompress(trained)
    given = {"dict_data": zstandard.ZstdCompressionDict(trained)} if trained else {}
    frames = zstandard.ZstdDecompressor(**given)
    while held or (held := source.read(READ_BYTES)):
        frame, parts = frames.decompressobj(), []
        while not frame.eof:
            if not held and not (held := source.read(READ_BYTES)):
                raise WarcError("the last frame is cut")
            parts.append(frame.decompress(held))
            held = frame.unused_data
        yield parsed(b"".join(parts))


def write_archives(df: DataFrame, at: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write records (record_id, uri, payload, digest, refers_to) to archives under ``at``; list path, records, payload."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(at)
        store.create_dir(folder, recursive=True)
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in names), strict=True))
        first, size = [], 0
        for row in rows:
            first.append(row)
            size += len(row[2])
            if size >= SAMPLE_BYTES:
                break
        if not first:
            return
        trained = dictionary([r[2] for r in first if r[2]])

        def all_rows():
            yield from first
            yield from rows

        writer = name = out = None
        for record_id, uri, payload, digest, refers_to in all_rows():
            if writer is None:
                name = f"{uuid.uuid4().hex}.warc.zst"
                out = store.open_output_stream(f"{folder}/{name}")
                writer = Writer(out, trained)
            writer.write(record_bytes(record_id, uri or "", date, payload, digest, refers_to), len(payload))
            if writer.payload >= ARCHIVE_BYTES:
                out.close()
                yield listed(f"{at}/{name}", writer)
                writer = None
        if writer is not None:
            out.close()
            yield listed(f"{at}/{name}", writer)

    names = ["record_id", "uri", "payload", "digest", "refers_to"]
    return written(df.select(names).mapInArrow(run, "path string, records long, payload long"))


def listed(path: str, writer: Writer) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [path], "records": [writer.records], "payload": [writer.payload]})


RECORD = "record_id string, uri string, record_type string, refers_to string, payload_bytes long, payload_digest string"


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the archives listed by ``path``, with their payloads if wanted (empty for revisits)."""
    n = max(1, min(archives.count(), 1 << 15))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_stream(name) as source:
                    rows: list[Record] = []
                    size = 0
                    for record in read_archive(source):
                        rows.append(record)
                        size += len(record.payload) if payloads else 0
                        if len(rows) >= 2048 or size >= 1 << 22:
                            yield out(rows)
                            rows, size = [], 0
                    if rows:
                        yield out(rows)

    def out(rows: list[Record]) -> pa.RecordBatch:
        columns = {
            "record_id": [r.record_id for r in rows],
            "uri": [r.uri for r in rows],
            "record_type": [r.kind for r in rows],
            "refers_to": pa.array([r.refers_to for r in rows], pa.string()),
            "payload_bytes": [r.payload_bytes for r in rows],
            "payload_digest": [r.payload_digest for r in rows],
        }
        if payloads:
            columns["payload"] = pa.array([r.payload for r in rows], pa.binary())
        return pa.RecordBatch.from_pydict(columns)

    return archives.select("path").repartition(n).mapInArrow(run, RECORD + (", payload binary" if payloads else ""))


def archive_pages(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", at: str | None = None) -> DataFrame:
    """Write a record for each row of ``df``; the list of archives.

    The payload is the html in UTF-8, empty for null. Of the rows with equal
    payloads (by SHA-256) of at least ``LEAST_REVISIT`` bytes, that with the
    smallest key is the response and the others are revisits of it; rows that
    repeat the smallest key are all responses, and so is a row without a key.
    A null URL is empty. An empty table gives no archive; other columns do not
    matter.
    """
    spark: SparkSession = df.sparkSession
    rows = df.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{url}`").alias("uri"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    scratch = Scratch(spark)
    first = scratch.written(
        rows.where(F.octet_length("payload") >= LEAST_REVISIT)
        .select(F.col("digest").alias("same"), "key")
        .groupBy("same")
        .agg(F.min("key").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    if first.count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(first), F.col("digest") == F.col("same"), "left")
    else:
        salted = first.withColumn("salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
        joined = rows.join(salted, (F.col("digest") == F.col("same")) & (F.col("salt") == F.col("salt2")), "left")
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")))
    records = joined.select(
        name("key").alias("record_id"),
        "uri",
        "payload",
        "digest",
        F.when(F.col("first") < F.col("key"), name("first")).alias("refers_to"),
    )
    if at is None:
        at = shared_dir(spark)
        left(spark, at)
    archives = write_archives(records, at)
    scratch.drop()
    return archives


def op2_warc(spark, sf_dir: str) -> DataFrame:
    archives = archive_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    page = lambda c: F.expr(f"try_cast(substring({c}, 10) as long)")  # noqa: E731  after "urn:page:"
    return read_archives(archives).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


ORACLE = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM f
"""

QUERIES = {"op2_warc": op2_warc}
ORACLES = {"op2_warc": ORACLE}
