import base64
import hashlib
import io
import struct

import pytest
import zstandard

from tallysheet.llm import warc as W
from tallysheet.session import scratch_path


def frame(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return df.selectExpr("*", "'x' AS sha", "'x' AS first", "'x' AS refers_to") if extra else df


def expected(rows, min_bytes=0):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None and len((html or "").encode()) >= min_bytes:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        least = first.get(html or "")
        refers = None if least is None or least == page_id else least
        out.append((page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def run(df, **options):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in W.round_trip(df, **options).collect()), key=str)


ROWS = [(i, f"http://h/{i}", f"<html>{'page ' * (i % 7)}{i % 11}</html>") for i in range(100, 200)] + [
    (1, None, None), (2, "http://x/\r\nInjected: 1", ""), (3, "ü", "日本 \r\n\r\n WARC/1.1"), (3, "ü", "日本 \r\n\r\n WARC/1.1"),
    (None, "http://n", "<html>0</html>"), (None, "http://n", "alone")]


@pytest.mark.parametrize("min_bytes", [0, 16])
def test_round_trip(spark, min_bytes):
    assert run(frame(spark, ROWS, extra=True), min_bytes=min_bytes) == expected(ROWS, min_bytes)


def test_payloads_urls_and_small_archives(spark):
    pages = frame(spark, ROWS)
    manifest = W.write_archives(pages, scratch_path(spark, "warc-test"), archive_bytes=500)
    assert manifest.count() > 10
    back = [r for r in W.read_archives(manifest).collect() if r.record_type == "response"]
    html = {(p, (h or "").encode()) for p, _, h in ROWS}
    assert all((r.page_id, bytes(r.payload)) in html for r in back)
    assert {r.url for r in back if r.page_id in (2, 3)} <= {"http://x/\r\nInjected: 1", "ü"}


def test_very_long_page_and_empty_table(spark):
    rows = [(1, "u", "x" * 5_000_000), (2, "u", "y")]
    assert run(frame(spark, rows)) == expected(rows)
    assert run(frame(spark, [])) == []


def archive(records, dictionary=b""):
    out = io.BytesIO()
    writer = W.ArchiveWriter(out, dictionary)
    for r in records:
        writer.add(r)
    return out.getvalue()


def test_layout_is_a_skippable_frame_and_a_frame_per_record():
    samples = [f"<html>{i} {'some page text ' * (i % 5)}</html>".encode() for i in range(300)]
    dictionary = W.train_dictionary(samples, 4096)
    records = [W.make_record(i, "u", s, None) for i, s in enumerate(samples)]
    raw = archive(records, dictionary)
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D and dictionary and zstandard.decompress(raw[8:8 + size]) == dictionary
    # A plain streaming decoder with the dictionary, across frames, gives the concatenated records.
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    whole = decoder.stream_reader(io.BytesIO(raw[8 + size:]), read_across_frames=True).read()
    assert whole == b"".join(records)
    assert list(W.read_records(io.BytesIO(raw))) == records


@pytest.mark.parametrize("damage", [
    lambda r: r.replace(b"WARC/1.1", b"WARC/9.9", 1), lambda r: r[:-1], lambda r: r + b"x",
    lambda r: r.replace(b"WARC-Date", b"X-Date", 1), lambda r: r.replace(b"payload!", b"payload?"),
    lambda r: r.replace(b"sha1:", b"sha1:A", 1), lambda r: r.replace(b"response\r\n", b"revisit\r\n", 1),
    lambda r: r.replace(b"WARC-Type: response\r\n", b"WARC-Type: response\r\n" * 2, 1)])
def test_damaged_records_are_refused(damage):
    good = W.make_record(5, "http://u", b"payload!", None)
    assert W.parse_record(good)["page_id"] == 5
    with pytest.raises(ValueError):
        W.parse_record(damage(good))


def test_damaged_archives_are_refused():
    raw = archive([W.make_record(1, "u", b"abc" * 1000, None)])
    for bad in (raw[4:], raw[:6], raw[:-3], b""):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(W.read_records(io.BytesIO(bad)))


def test_archives_are_read_in_parallel(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>" * 50) for i in range(60)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    manifest = W.write_archives(pages.repartition(12), folder, archive_bytes=200)
    n = manifest.count()
    back = W.read_archives(manifest, payloads=False)
    assert n >= 12 and back.rdd.getNumPartitions() == n
    assert sorted(r["page_id"] for r in back.collect()) == list(range(60))
