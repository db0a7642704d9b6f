"""Archives: round trip, brute force, and what the reader refuses."""

import base64
import hashlib
import io
import random
import struct
from collections import defaultdict

import pytest
import zstandard
from pyspark.errors import PythonException

from stridecast.llm import warc

SCHEMA = "page_id bigint, url string, html string, row bigint, sha1 string, weight int"


def digest(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    texts = [f"<html><p>{' '.join(draw.choice(['a', 'page', 'of', 'wörds', '<b>']) for _ in range(draw.randrange(200)))}" for _ in range(60)]
    pages = [(i, f"http://example.org/{i}", draw.choice(texts)) for i in range(-5, 200)]
    pages += [(1000 + i, None, None if i % 2 else "") for i in range(6)]
    pages += [(2000 + i, "http://e.org/a b\r\nX: y", "hot") for i in range(100)]
    pages += [(3000, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 3), (3001, "", "日本 \x00 " * 100_000)]
    pages += [(4000, "u", "twice"), (4000, "u", "twice"), (None, "u", "no id"), (None, "u", "no id"), (None, "u", "hot")]
    draw.shuffle(pages)
    return pages


@pytest.fixture(scope="module")
def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(4).cache()


def expected(rows, least=0):
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[html or ""].append(page_id)
    out = []
    for html, ids in groups.items():
        raw = html.encode()
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        for k, page_id in enumerate(ids):
            alone = k == 0 or len(raw) < least
            out.append((page_id, len(raw), digest(raw), "response" if alone else "revisit", None if alone else ids[0]))
    return sorted(out, key=repr)


def test_pages_equal_brute_force(pages, rows):
    assert sorted(map(tuple, warc.archived(pages).collect()), key=repr) == expected(rows)


def test_hot_payloads_without_broadcast(pages, rows, monkeypatch):
    from functools import partial

    monkeypatch.setattr(warc, "attach", partial(warc.attach, broadcast_bytes=-1, rows_per_task=10))
    assert sorted(map(tuple, warc.archived(pages).collect()), key=repr) == expected(rows)


def test_short_payloads_are_stored_each(spark, pages, rows):
    read = warc.read_archives(warc.write_archives(pages, least_revisit=4)).where("record_type <> 'warcinfo'").collect()
    kinds = defaultdict(int)
    for r in read:
        kinds[r["payload_bytes"] < 4, r["record_type"]] += 1
    wanted = defaultdict(int)
    for _, size, _, kind, _ in expected(rows, 4):
        wanted[size < 4, kind] += 1
    assert kinds == wanted and (True, "revisit") not in kinds


def test_records_hold_the_payloads(spark, pages, rows):
    manifest = warc.write_archives(pages, archive_bytes=5_000)
    read = warc.read_archives(manifest).collect()
    bodies = defaultdict(int)
    for r in read:
        if r["record_type"] == "response":
            bodies[bytes(r["payload"])] += 1
        elif r["record_type"] == "revisit":
            assert r["payload"] == b"" and r["refers_to"].startswith("urn:page:")
    assert bodies == {(h or "").encode(): 1 for _, _, h in rows}
    assert all("\n" not in r["target_uri"] and " " not in r["target_uri"] for r in read if r["target_uri"])
    totals = manifest.collect()
    assert len(totals) > 4 and sum(r["records"] for r in totals) == len(rows) + len(totals) == len(read)
    assert len({r["record_id"] for r in read}) == len(read)
    folder = totals[0]["path"].rpartition("/")[0]
    listed = warc.archives_in(spark, folder)
    assert {r["bytes"] for r in listed.collect()} == {r["bytes"] for r in totals}
    assert warc.read_archives(listed, with_payload=False).count() == len(read)


def test_files_of_failed_attempts_are_not_read(spark, pages, rows):
    manifest = warc.write_archives(pages)
    path = manifest.first()["path"]
    with open(path.removeprefix("file:").replace(".warc.zst", "-lost.warc.zst"), "wb") as f:
        f.write(b"half a record")
    assert warc.read_archives(manifest).where("record_type in ('response', 'revisit')").count() == len(rows)


def test_empty_table(pages):
    assert warc.archived(pages.limit(0)).collect() == []


def test_pages_as_large_as_many_reads():
    raw = bytes(random.Random(1).randbytes(3_000_000))
    sink = io.BytesIO()
    writer = warc.ArchiveWriter(sink, None)
    for block in (b"", raw, b"x"):
        writer.write(warc.record_bytes("resource", "urn:x:1", [("Content-Type", "text/plain")], block))
    found = list(warc.read_archive(io.BytesIO(sink.getvalue())))
    assert [r.payload for r in found] == [b"", raw, b"x"] and found[0].offset == 0


# What the reader refuses

BLOCK = b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nhello"
FIELDS = [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", "sha1:" + digest(b"hello"))]
GOOD = warc.record_bytes("response", "urn:page:1:0", FIELDS, BLOCK)
BLOCK_DIGEST = b"WARC-Block-Digest: sha1:" + digest(BLOCK).encode() + b"\r\n"


def parsed(content):
    return warc.parse_record(7, content)


def test_a_good_record():
    r = parsed(GOOD)
    assert (r.record_type, r.record_id, r.payload, r.payload_bytes) == ("response", "urn:page:1:0", b"hello", 5)
    assert parsed(GOOD.replace(b"Content-Type", b"CONTENT-type")).payload == b"hello"


@pytest.mark.parametrize(
    "content, message",
    [
        (GOOD.replace(b"WARC/1.1", b"WARC/9.9"), "version"),
        (GOOD.replace(b"WARC-Date: 2020-01-01T00:00:00Z\r\n", b""), "lacks warc-date"),
        (GOOD.replace(b"WARC-Type: response\r\n", b"WARC-Type response\r\n"), "malformed"),
        (GOOD.replace(b"WARC-Type: response", b"WARC-Type: response\r\nWARC-Type: revisit"), "twice"),
        (GOOD.replace(b"Content-Length: 43", b"Content-Length: 42"), "bytes of block"),
        (GOOD.replace(b"Content-Length: 43", b"Content-Length: 4x"), "length"),
        (GOOD + b"more", "bytes of block"),
        (GOOD[:-2], "bytes of block"),
        (GOOD[:60], "headers do not end"),
        (GOOD.replace(b"hello", b"hullo"), "digest"),
        (GOOD.replace(b"hello", b"hullo").replace(BLOCK_DIGEST, b""), "digest"),
        (GOOD.replace(BLOCK_DIGEST, b"").replace(b"Content-Length: 5", b"Content-Length: 6"), "bytes of payload"),
        (GOOD.replace(BLOCK_DIGEST, b"").replace(b"HTTP/1.1", b"HTTQ/1.1"), "HTTP"),
        (warc.record_bytes("revisit", "urn:page:2:0", FIELDS[:1], BLOCK[:-5]), "revisit of nothing"),
    ],
)
def test_broken_records(content, message):
    assert len(BLOCK) == 43
    with pytest.raises(ValueError, match=message):
        parsed(content)


def archive(dictionary=None):
    sink = io.BytesIO()
    writer = warc.ArchiveWriter(sink, dictionary)
    for _ in range(3):
        writer.write(GOOD)
    return sink.getvalue()


SAMPLES = [GOOD.replace(b"hello", b"hello %d" % (i * 7919)) for i in range(500)]


def test_dictionary_frames():
    dictionary = warc.train_dictionary(SAMPLES, 4096)
    whole = archive(dictionary)
    assert struct.unpack("<II", whole[:8]) == (0x184D2A5D, len(dictionary)) and len(whole) < len(archive()) + len(dictionary)
    small = zstandard.ZstdCompressor(write_content_size=True).compress(dictionary)
    packed = struct.pack("<II", 0x184D2A5D, len(small)) + small + whole[8 + len(dictionary) :]
    between = whole + struct.pack("<II", 0x184D2A50, 3) + b"abc" + archive()
    assert [len(list(warc.read_archive(io.BytesIO(x)))) for x in (whole, packed, archive(), between)] == [3, 3, 3, 6]
    assert warc.train_dictionary(SAMPLES[:3]) is None


def test_broken_archives():
    dictionary = warc.train_dictionary(SAMPLES, 4096)
    whole = archive(dictionary)
    wrong = struct.pack("<II", 0x184D2A5D, 4) + b"text" + archive()
    for broken, message in (
        (whole[:-3], "ends within"),
        (whole[:6], "ends"),
        (whole + b"text", "no frame"),
        (wrong, "no dictionary"),
        (whole[8 + len(dictionary) :], "frame at 0"),
        (whole[:-1] + bytes([whole[-1] ^ 1]), "frame at"),
    ):
        with pytest.raises(ValueError, match=message):
            list(warc.read_archive(io.BytesIO(broken)))


def test_the_path_is_told(spark, tmp_path):
    (tmp_path / "bad.warc.zst").write_bytes(archive()[:-3])
    with pytest.raises(PythonException, match="bad.warc.zst: archive ends"):
        warc.read_archives(warc.archives_in(spark, str(tmp_path))).collect()
