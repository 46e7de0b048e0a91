"""Zstandard web archives: round trips, equal payloads, and what a reader must refuse."""

import base64
import hashlib
import io
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.llm.conftest import prose
from tidemark.llm import warc

SCHEMA = "page_id bigint, url string, html string, payload string, mark string, path string, first bigint"


def payload_digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture
def pages(spark):
    """Null and empty payloads and ids, copies, repeated rows, and clashing columns."""
    data = [
        (4, "http://a/4", "<p>é</p>"),
        (2, "http://a/2", "<p>é</p>"),
        (9, "http://a/9", "<p>é</p>"),
        (None, "http://a/0", "<p>é</p>"),
        (5, None, None),
        (6, "http://a/6\r\nX: y 100%", ""),
        (7, "http://a/7", "x" * 3_000_000),
        (8, "http://a/8", "\r\n\r\n"),
        (10, "http://b", "same"),
        (10, "http://a", "same"),
        (11, "http://c", "twice"),
        (11, "http://c", "twice"),
        (12, "http://d", "a\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"),
    ] + [(100 + i, f"http://p/{i}", prose(i)) for i in range(60)]
    return spark.createDataFrame([(*d, "x", "x", "x", 1) for d in data], SCHEMA), data


@pytest.mark.parametrize("listed", [100_000, 0])
def test_records_say_what_the_pages_are(pages, monkeypatch, listed):
    monkeypatch.setattr(warc, "BROADCAST_FIRSTS", listed)  # by broadcast, and by a join
    df, data = pages
    got = sorted(rows(warc.archive_pages(df.repartition(3))), key=str)
    want = []
    order = lambda d: (d[0] is None, d[0] or 0, d[1] is not None, d[1] or "")
    for d in data:
        text = d[2] or ""
        first = min((e for e in data if (e[2] or "") == text), key=order)
        revisit = (d[0], d[1]) != (first[0], first[1])
        want.append(
            (d[0], len(text.encode()), payload_digest(text), "revisit" if revisit else "response",
             first[0] if revisit else None)
        )
    assert got == sorted(want, key=str)


def test_payloads_and_targets_come_back_whole(spark, pages):
    df, data = pages
    folder = warc.scratch_path(spark, "archives")
    manifest = warc.write_archives(df.repartition(2), folder)
    back = warc.read_archives(spark, folder, manifest)
    assert back.count() == len(data) == manifest.agg(F.sum("n_records")).first()[0]
    found = {(r.page_id, r.target): r for r in back.collect()}
    for page_id, url, html in data:
        r = found[page_id, url]
        assert r.wrong is None and r.record_type in ("response", "revisit")
        if r.record_type == "response":
            assert bytes(r.payload).decode() == (html or "")


def test_archives_end_at_their_size(spark):
    noise = random.Random(3)
    data = [(i, None, noise.randbytes(150_000).hex()) for i in range(40)]
    df = spark.createDataFrame(data, "page_id bigint, url string, html string").coalesce(1)
    folder = warc.scratch_path(spark, "archives")
    manifest = warc.write_archives(df, folder, archive_bytes=1_000_000)
    assert manifest.count() > 2 and manifest.agg(F.sum("n_records")).first()[0] == 40
    assert {r.page_id: r.payload_bytes for r in warc.read_archives(spark, folder, manifest).collect()} == {
        i: 300_000 for i in range(40)
    }


def test_no_pages(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(warc.archive_pages(empty)) == []


def test_text_ids(spark):
    df = spark.createDataFrame([("b>\n", "u", "x"), ("a", "u", "x"), ("", "u", "y")], "page_id string, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.archive_pages(df).collect()}
    assert got == {"a": ("response", None), "b>\n": ("revisit", "a"), "": ("response", None)}


# ---------------------------------------------------------------- the format


class Kept(io.BytesIO):
    def close(self):
        self.bytes = self.getvalue()
        super().close()


def archive(records):
    stream = Kept()
    writer = warc.ArchiveWriter(stream)
    for r in records:
        writer.add(r)
    writer.close()
    assert len(stream.bytes) == writer.n_bytes
    return stream.bytes


def some(n=200):
    return [warc.record_bytes(i, f"http://x/{i}", prose(i).encode()) for i in range(n)]


def read(data):
    return [(at, fields) for at, fields in warc.read_frames(io.BytesIO(data))]


@pytest.mark.parametrize("block", [1, 7, 1000, 1 << 20])
def test_frames_are_cut_at_any_block_size(block):
    records = some(40)
    data = archive(records)
    cut = list(warc.frames(io.BytesIO(data), block))
    assert b"".join(f for _, f in cut) == data
    assert len(cut) == 1 + len(records)  # the dictionary, then one a record


def test_the_first_frame_holds_the_dictionary():
    data = archive(some())
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_MAGIC
    (_, head), *others = warc.frames(io.BytesIO(data))
    known = warc.frame_dictionary(head)
    assert all(zstandard.get_frame_parameters(f).dict_id == known.dict_id() != 0 for _, f in others)
    with pytest.raises(zstandard.ZstdError):  # without it nothing can be read
        zstandard.ZstdDecompressor().decompress(others[0][1])
    # the same dictionary, not compressed
    plain = warc.DICTIONARY_MAGIC.to_bytes(4, "little") + len(known.as_bytes()).to_bytes(4, "little")
    again = plain + known.as_bytes() + b"".join(f for _, f in others)
    assert [f for _, f in read(again)] == [f for _, f in read(data)]


def test_other_writers_frames():
    """Frames of other shapes: no size, no checksum, runs, raw blocks, skippable ones between."""
    texts = [b"", b"a" * 500_000, random.Random(1).randbytes(300_000), prose(3).encode()]
    records = [warc.record_bytes(i, None, t) for i, t in enumerate(texts)]
    data = b""
    for r in records:
        for size, check in ((True, False), (False, True)):
            data += zstandard.ZstdCompressor(write_content_size=size, write_checksum=check).compress(r)
            packer = zstandard.ZstdCompressor().compressobj()  # a stream that does not know its size
            data += packer.compress(r) + packer.flush()
        data += (0x184D2A57).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"notes"
    got = read(data)
    assert len(got) == 16 and not [f for _, f in got if f["wrong"]]
    assert [f["payload"] for _, f in got[::4]] == texts


@pytest.mark.parametrize(
    "change, said",
    [
        (lambda r: r.replace(b"WARC/1.1", b"WARC/0.9"), "not WARC/1.1"),
        (lambda r: r.replace(b"WARC-Date", b"WARC-Data"), "without warc-date"),
        (lambda r: r[:-4], "bytes"),
        (lambda r: r + b"\r\n", "bytes"),
        (lambda r: r + r, "bytes"),
        (lambda r: r.replace(b"river", b"RIVER", 1).replace(b"WARC-Block", b"X-Block"), "payload's digest"),
        (lambda r: r.replace(b"river", b"RIVER", 1), "block's digest"),
        (lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: resource"), "unknown type"),
        (lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: revisit"), "carries a payload"),
        (lambda r: r.replace(b"Content-Length: ", b"Content-Length: -"), "no length"),
        (lambda r: r.replace(b"WARC-Date:", b"WARC-Type: x\r\nWARC-Date:"), "given twice"),
        (lambda r: r.replace(b"WARC-Record-ID: <urn:page", b"WARC-Record-ID: <urn:leaf"), "no page"),
        (lambda r: r.replace(b"\r\n\r\n", b"\r\n"), "headers"),
        (lambda r: b"", "headers"),
    ],
)
def test_malformed_records_are_told(change, said):
    good = warc.record_bytes(1, "http://x", b"the river\n" + b"y" * 40)
    frames = [zstandard.ZstdCompressor().compress(r) for r in (good, change(good), good)]
    got = [f["wrong"] for _, f in read(b"".join(frames))]
    assert got[0] is None and got[2] is None  # the record before and after can be read
    assert said in got[1]


def test_damaged_archives_end_where_the_damage_is():
    data = archive(some(50))
    cut = [at for at, _ in warc.frames(io.BytesIO(data))]
    whole = read(data)
    short = read(data[:-3])
    assert short[:-1] == whole[:-1] and "does not end" in short[-1][1]["wrong"]
    broken = bytearray(data)
    broken[cut[20]] ^= 1  # a frame's magic
    got = read(bytes(broken))
    assert got[:-1] == whole[:19] and "no frame" in got[-1][1]["wrong"]
    flipped = bytearray(data)
    flipped[cut[21] - 6] ^= 255  # inside a frame: its checksum or its coding tells
    bad = [k for k, (_, f) in enumerate(read(bytes(flipped))) if f["wrong"]]
    assert bad == [19]


def test_strict_reading_fails_and_lenient_reading_tells(spark, pages, tmp_path):
    df, data = pages
    folder = f"file:{tmp_path}/a"
    manifest = warc.write_archives(df.repartition(1), folder)
    name = manifest.first().path
    path = tmp_path / "a" / "archives" / name
    assert path.stat().st_size == manifest.first().n_bytes
    assert int.from_bytes(path.read_bytes()[:4], "little") == warc.DICTIONARY_MAGIC
    path.write_bytes(path.read_bytes()[:-2])
    with pytest.raises(Exception, match="does not end"):
        warc.read_archives(spark, folder, manifest).collect()
    back = warc.read_archives(spark, folder, manifest, strict=False).collect()
    assert [r.wrong is None for r in back].count(False) == 1 and len(back) == len(data)
