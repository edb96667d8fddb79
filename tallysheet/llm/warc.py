"""WARC archives compressed with zstandard, one frame per record.

An archive begins with a skippable frame (magic ``0x184D2A5D``) that holds the
dictionary; every record is a frame of its own, compressed with it.  The reader
takes the dictionary from that frame, decodes frame after frame in small pieces
and validates each record: version line, mandatory headers, ``Content-Length``
against the block, HTTP ``Content-Length`` and payload digest against the payload,
and the closing blank lines.  Anything else raises ``ValueError``.

Of records with equal payloads of at least ``min_bytes`` bytes, that with the least
``page_id`` is a response; the others are revisits that refer to it and carry the
HTTP header only.

Scale: payloads are compared by SHA-1 in an aggregate with map-side combining, then
joined once (a payload that a third of the pages share is split by Spark's skew join).
Each task writes its rows to archives of about ``ARCHIVE_BYTES`` in the shared folder
of ``spark.checkpoint.dir`` and returns their names; attempts use names of their own,
so a repeated task leaves no record twice.  Reading deals the archives to as many tasks as there are
archives, up to ``READ_TASKS``, and
holds one record at a time.  The dictionary is trained on the first ``SAMPLE_CHARS`` characters of ``SAMPLE_PAGES`` pages at most,
chosen by a hash of ``page_id``.

Defined cases: null html is an empty payload; null urls are written as an empty
target; characters that may not stand in a header are percent-encoded; a null ``page_id``
is never the response of others; rows repeated under the least ``page_id`` are all
responses; too few pages for a dictionary give archives whose dictionary frame is empty;
an empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallysheet.llm.staging import staged
from tallysheet.session import scratch_path

DICTIONARY_MAGIC = 0x184D2A5D
SAMPLE_PAGES = 500
SAMPLE_CHARS = 8 * 1024
READ_TASKS = 20_000
DICTIONARY_BYTES = 64 * 1024
ARCHIVE_BYTES = 64 * 1024 * 1024
READ_BYTES = 64 * 1024
LEVEL = 3
#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("WARC-Record-ID", "Content-Length", "WARC-Date", "WARC-Type")
WRITTEN_AT = "2020-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", WRITTEN_AT), ("WARC-Target-URI", quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", "sha1:" + payload_digest(payload))]
    if refers_to is not None:
        headers += [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    headers += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.decode().split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or name.lower() in out:
            raise ValueError(f"bad or repeated header line {line[:80]!r}")
        out[name.lower()] = value.strip()
    return out


def parse_record(raw: bytes) -> dict:
    """The validated fields of one decoded frame."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if version != VERSION or not gap:
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    headers = _headers(lines)
    for name in MANDATORY:
        if name.lower() not in headers:
            raise ValueError(f"header {name} is missing")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, Content-Length {length}")
    kind = headers["warc-type"]
    if kind not in ("response", "revisit") or (kind == "revisit") != ("warc-refers-to" in headers):
        raise ValueError(f"record type {kind!r} does not fit its headers")
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no HTTP header")
    size = int(_headers(http.partition(b"\r\n")[2])["content-length"])
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError("payload differs from its length or digest")
    if kind == "revisit" and payload:
        raise ValueError("a revisit holds a payload")
    refers = headers.get("warc-refers-to")
    return {"page_id": _page_id(headers["warc-record-id"]), "url": unquote(headers.get("warc-target-uri", "")),
            "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": None if refers is None else _page_id(refers),
            "payload": payload if kind == "response" else None}


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for the payloads; empty if they are too few."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _location(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


class ArchiveWriter:
    def __init__(self, stream, dictionary: bytes):
        self.stream, self.size, self.records = stream, 0, 0
        packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
        stream.write(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if known:
            known.precompute_compress(level=LEVEL)
            self.compressor = zstandard.ZstdCompressor(dict_data=known, write_checksum=True)
        else:
            self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def add(self, record: bytes) -> None:
        frame = self.compressor.compress(record)
        self.stream.write(frame)
        self.size += len(frame)
        self.records += 1


def read_records(stream):
    """The decoded frames of one archive, one at a time."""
    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<II", head)[0] != DICTIONARY_MAGIC:
        raise ValueError("the archive does not begin with a dictionary frame")
    packed = stream.read(struct.unpack("<II", head)[1])
    if len(packed) < struct.unpack("<II", head)[1]:
        raise ValueError("the dictionary frame is cut short")
    dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(packed)
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decoder = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    data = stream.read(READ_BYTES)
    while data:
        frame, parts = decoder.decompressobj(), []
        while not frame.eof:
            if not data:
                raise ValueError("the last record is cut short")
            parts.append(frame.decompress(data))
            data = frame.unused_data if frame.eof else stream.read(READ_BYTES)
        yield b"".join(parts)
        data = data or stream.read(READ_BYTES)


def with_references(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``(page_id, url, html, refers_to)``: ``refers_to`` is set for revisits."""
    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    first = (rows.where((F.octet_length("html") >= min_bytes) & F.col("page_id").isNotNull())
             .groupBy("sha").agg(F.min("page_id").alias("first")))
    # Staged, so that the join deals both sides anew and Spark can split a payload of many pages.
    first = staged(first, "warc-first")
    joined = rows.join(first, "sha", "left")
    revisit = F.col("first").isNotNull() & (F.octet_length("html") >= min_bytes) & (
        F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("first")).alias("refers_to"))


def sample_dictionary(pages: DataFrame, n: int = SAMPLE_PAGES) -> bytes:
    ids = pages.where("page_id is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(n)
    # Cut in Spark: what comes to the driver is bounded in bytes.
    start = F.substring("html", 1, SAMPLE_CHARS)
    rows = pages.join(F.broadcast(ids), "page_id").groupBy("page_id").agg(F.max(start).alias("html")).collect()
    rows.sort(key=lambda r: r["page_id"])
    return train_dictionary([r["html"].encode() for r in rows if r["html"]])


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes all pages under ``folder``; ``(path, records)`` per archive."""
    dictionary = sample_dictionary(pages)

    def per_task(batches):
        writer = stream = path = None
        fs, base = _location(folder)
        done = []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(i) for i in range(4))):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    path = f"{folder}/{name}"
                    fs.create_dir(base, recursive=True)
                    stream = fs.open_output_stream(f"{base}/{name}")
                    writer = ArchiveWriter(stream, dictionary)
                writer.add(make_record(page_id.as_py(), url.as_py(), html.as_buffer().to_pybytes(), refers_to.as_py()))
                if writer.size >= archive_bytes:
                    stream.close()
                    done.append((path, writer.records))
                    writer = None
        if writer is not None:
            stream.close()
            done.append((path, writer.records))
        yield pa.RecordBatch.from_pydict(
            {"path": [p for p, _ in done], "records": [n for _, n in done]},
            schema=pa.schema([("path", pa.string()), ("records", pa.int64())]))

    rows = with_references(pages, min_bytes)
    return staged(rows.mapInArrow(per_task, "path string, records long"), "warc-manifest")


_FIELDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                     ("payload", pa.binary())])


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """A row per record of the archives named in ``manifest.path``; without ``payloads`` these are null."""
    def per_task(batches):
        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, name = _location(path)
                rows, size, n = [], 0, 0
                with fs.open_input_stream(name) as stream:
                    for raw in read_records(stream):
                        record = parse_record(raw)
                        if not payloads:
                            record["payload"] = None
                        rows.append(record)
                        size, n = size + (len(raw) if payloads else 400), n + 1
                        if size > 4_000_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=_FIELDS)
                            rows, size = [], 0
                if n != expected:
                    raise ValueError(f"{path}: {n} records, {expected} written")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_FIELDS)

    # A list of names is tiny: without an explicit number Spark would read all archives in one task.
    tasks = max(1, min(manifest.count(), READ_TASKS))
    return manifest.select("path", "records").repartition(tasks).mapInArrow(
        per_task, "page_id long, url string, payload_bytes long, payload_digest string, record_type string,"
                  "refers_to long, payload binary")


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """The pages written to archives in the shared folder and read back, without payloads."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, min_bytes), payloads=False)
