"""Web archives in Zstandard: one WARC record a frame, behind a dictionary frame.

An archive (``.warc.zst``) begins with a skippable frame of magic 0x184D2A5D that holds
the dictionary its other frames need, itself compressed or not. Each following frame is
one record of WARC 1.1, so a record can be read without those before it.

Writing: pages with equal payloads are told by SHA-256; the first page (smallest
page_id) is a ``response``, the others ``revisit`` records that name it and carry no
payload. Each task writes its records to archives of at most ``archive_bytes``, with a
dictionary trained on the first records of each (at most ``SAMPLE_BYTES``; records too
few to train on are written without). Archives have names of their own and the
manifest, a Parquet table, lists those of the attempts that counted, so a repeated task
leaves an unlisted file and nothing else.

Reading: an archive is read front to back in blocks. A frame's end follows from its
block headers, so frames are cut out and decoded one by one. Every record must have the
version line, the headers that WARC demands, a Content-Length that fills the frame up to
the closing line breaks, and a payload that agrees with its own length and digests.
``read_archives`` fails at the first record that does not; with ``strict=False`` such a
record has a row that says what is ``wrong`` with it. A damaged frame boundary ends an
archive, since nothing after it can be found.

The folder must be one that pyarrow can open by its URI from all executors.

Defined cases: a null payload is an empty one, and empty payloads are equal ones; a null
page_id comes after all others, a null url is an absent target; rows that share page_id
and payload revisit the one with the smallest url, and rows equal in all three are the
same capture and share its record type; an empty table gives a manifest without rows;
other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.plans import durable, scratch_path

# fixed values of the Zstandard and WARC formats
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DEMANDED = ("warc-record-id", "content-length", "warc-date", "warc-type")
END = b"\r\n\r\n"

LEVEL = 3
DICTIONARY_BYTES = 1 << 16
SAMPLE_BYTES = 4 << 20  # of an archive's first records, to train its dictionary on
SAMPLE_RECORDS = 16  # fewer are not trained on
ARCHIVE_BYTES = 1 << 30
READ_BYTES = 4 << 20
BROADCAST_FIRSTS = 100_000  # of repeated payloads, about 100 bytes each
DATE = "2024-01-01T00:00:00Z"
ID = "urn:page"
MAX_RECORD = 1 << 31  # bytes; a frame that claims more is not decoded

MANIFEST = "path string, n_records bigint, n_bytes bigint"
RECORDS = (
    "path string, position bigint, page_id {kind}, target string, record_type string, "
    "payload binary, payload_bytes bigint, payload_digest string, refers_to {kind}, wrong string"
)


# ------------------------------------------------------------------- records


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(
    page_id, target: str | None, payload: bytes, refers_to=None, revisit: bool = False, date: str = DATE
) -> bytes:
    """One WARC record, closing line breaks included."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    head = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_uri(page_id)}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
    ]
    if target is not None:
        head.append(f"WARC-Target-URI: {_escaped(target)}")
    if revisit:
        head += [f"WARC-Refers-To: <{_uri(refers_to)}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def _uri(page_id) -> str:
    return ID if page_id is None else f"{ID}:{_escaped(str(page_id))}"


def _escaped(target: str) -> str:
    """Control characters cannot stand in a header; they and % become %XX."""
    return "".join(f"%{ord(c):02X}" if c < " " or c in "%\x7f" else c for c in target)


def _unescaped(target: str) -> str:
    head, *rest = target.split("%")
    return head + "".join(chr(int(x[:2], 16)) + x[2:] for x in rest)


class Malformed(ValueError):
    """What is wrong with an archive or a record."""


def _headers(text: bytes) -> dict[str, str]:
    out = {}
    for line in text.decode("utf-8", "strict").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise Malformed(f"no header: {line[:80]!r}")
        if name.lower() in out:
            raise Malformed(f"header given twice: {name}")
        out[name.lower()] = value.strip()
    return out


def _number(headers: dict[str, str], name: str) -> int:
    value = headers.get(name, "")
    if not (value.isascii() and value.isdigit()):
        raise Malformed(f"{name} is no length: {value!r}")
    return int(value)


def _page(headers: dict[str, str], name: str) -> str | None:
    uri = headers.get(name, "")
    if uri == f"<{ID}>":
        return None
    if not (uri.startswith(f"<{ID}:") and uri.endswith(">")):
        raise Malformed(f"{name} is no page: {uri!r}")
    return _unescaped(uri[len(ID) + 2 : -1])


def parse_record(data: bytes) -> dict:
    """The checked fields of one record; raises :class:`Malformed`."""
    top, found, rest = data.partition(END)
    if not found:
        raise Malformed("the headers do not end")
    version, _, lines = top.partition(b"\r\n")
    if version != VERSION.encode():
        raise Malformed(f"not {VERSION}: {version[:20]!r}")
    headers = _headers(lines)
    if missing := [h for h in DEMANDED if h not in headers]:
        raise Malformed(f"without {', '.join(missing)}")
    length = _number(headers, "content-length")
    if len(rest) != length + len(END) or rest[length:] != END:
        raise Malformed(f"content-length {length}, but {len(rest) - len(END)} bytes")
    kind = headers["warc-type"]
    if kind not in ("response", "revisit"):
        raise Malformed(f"unknown type {kind[:20]!r}")
    block = rest[:length]
    if headers.get("warc-block-digest", said := f"sha1:{digest(block)}") != said:
        raise Malformed("the block's digest differs")
    http, found, payload = block.partition(END)
    if not found or not http.startswith(b"HTTP/"):
        raise Malformed("the block is no HTTP response")
    size = _number(_headers(http.partition(b"\r\n")[2]), "content-length")
    algorithm, _, said = headers.get("warc-payload-digest", "").partition(":")
    if algorithm != "sha1" or len(said) != 32:
        raise Malformed("without a SHA-1 payload digest")
    if kind == "response":
        if len(payload) != size:
            raise Malformed(f"the payload has {len(payload)} bytes, not {size}")
        if digest(payload) != said:
            raise Malformed("the payload's digest differs")
    elif payload:
        raise Malformed("a revisit carries a payload")
    target = headers.get("warc-target-uri")
    return {
        "page_id": _page(headers, "warc-record-id"),
        "target": None if target is None else _unescaped(target),
        "record_type": kind,
        "payload": payload if kind == "response" else None,
        "payload_bytes": size,
        "payload_digest": said,
        "refers_to": _page(headers, "warc-refers-to") if kind == "revisit" else None,
        "wrong": None,
    }


# -------------------------------------------------------------------- frames


def frame_end(data: bytes, at: int) -> int | None:
    """Where the frame at ``at`` ends, by its block headers; None: beyond the data."""
    if len(data) < at + 8:
        return None
    magic = int.from_bytes(data[at : at + 4], "little")
    if magic in SKIPPABLE:
        end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
        return end if end <= len(data) else None
    if magic != FRAME_MAGIC:
        raise Malformed(f"no frame at byte {at}")
    flags = data[at + 4]
    single, checksum = flags >> 5 & 1, flags >> 2 & 1
    # widths of the dictionary's id and of the content's size, by their codes
    size = (single, 2, 4, 8)[flags >> 6]
    end = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + size
    last = False
    while not last:
        if len(data) < end + 3:
            return None
        block = int.from_bytes(data[end : end + 3], "little")
        last, kind = block & 1, block >> 1 & 3
        if kind == 3:
            raise Malformed(f"no block at byte {end}")
        end += 3 + (1 if kind == 1 else block >> 3)  # a run is one byte, repeated
    end += 4 * checksum
    return end if end <= len(data) else None


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return DICTIONARY_MAGIC.to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed


def frame_dictionary(frame: bytes) -> zstandard.ZstdCompressionDict:
    """The dictionary in a leading skippable frame, compressed or plain."""
    content = frame[8:]
    if content[:4] == FRAME_MAGIC.to_bytes(4, "little"):
        content = zstandard.ZstdDecompressor().decompress(content)
    return zstandard.ZstdCompressionDict(content)


class ArchiveWriter:
    """Records of one archive: a dictionary frame, then a frame each."""

    def __init__(self, stream, level: int = LEVEL):
        self.stream, self.level = stream, level
        self.waiting: list[bytes] | None = []
        self.held = self.n_records = self.n_bytes = 0

    def add(self, record: bytes) -> None:
        self.n_records += 1
        if self.waiting is None:
            return self._put(self.packer.compress(record))
        self.waiting.append(record)
        self.held += len(record)
        if self.held >= SAMPLE_BYTES:
            self._start()

    def close(self) -> None:
        if self.waiting is not None:
            self._start()
        self.stream.close()

    def _put(self, frame: bytes) -> None:
        self.stream.write(frame)
        self.n_bytes += len(frame)

    def _start(self) -> None:
        waiting, self.waiting = self.waiting, None
        known = None
        if len(waiting) >= SAMPLE_RECORDS:
            try:
                known = zstandard.train_dictionary(DICTIONARY_BYTES, waiting)
            except zstandard.ZstdError:  # too little, or too uniform, to train on
                known = None
        if known is not None:
            self._put(dictionary_frame(known.as_bytes()))
        self.packer = zstandard.ZstdCompressor(
            level=self.level, dict_data=known, write_checksum=True, write_content_size=True
        )
        for record in waiting:
            self._put(self.packer.compress(record))


def frames(stream, block: int = READ_BYTES) -> Iterator[tuple[int, bytes]]:
    """(position, bytes) of each frame; holds a block and one frame at a time."""
    data, at, base = b"", 0, 0
    while True:
        end = frame_end(data, at)
        if end is not None:
            yield base + at, data[at:end]
            at = end
            continue
        more = stream.read(max(block, len(data) - at))  # doubles while a frame goes on
        if not more:
            if at < len(data):
                raise Malformed(f"the frame at byte {base + at} does not end")
            return
        data, base, at = data[at:] + more, base + at, 0


def read_frames(stream) -> Iterator[tuple[int, dict]]:
    """(position, fields) of each record; fields of a bad one say what is ``wrong``."""
    unpacker = zstandard.ZstdDecompressor()
    try:
        for k, (position, frame) in enumerate(frames(stream)):
            magic = int.from_bytes(frame[:4], "little")
            if magic in SKIPPABLE:
                if k == 0 and magic == DICTIONARY_MAGIC:
                    unpacker = zstandard.ZstdDecompressor(dict_data=frame_dictionary(frame))
                continue
            try:
                size = zstandard.frame_content_size(frame)
                if size > MAX_RECORD:
                    raise Malformed(f"a record of {size} bytes")
                # a frame that does not name its size is decoded piece by piece
                unpack = unpacker if size >= 0 else unpacker.decompressobj()
                yield position, parse_record(unpack.decompress(frame))
            except (ValueError, zstandard.ZstdError) as error:
                yield position, {"wrong": str(error) or type(error).__name__}
    except (Malformed, zstandard.ZstdError) as error:
        yield -1, {"wrong": str(error)}


# --------------------------------------------------------------------- Spark


def with_roles(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, revisit, refers_to): each page and what its record is.

    The first page of each repeated payload is found from digests alone and written down.
    If the list is small for certain it goes to all tasks, and no payload is moved; a
    longer one is joined, which moves each payload once, by digest.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    whole = pages.select(
        "page_id",
        "url",
        payload.alias("payload"),
        F.unhex(F.sha2(payload, 256)).alias("mark"),
    )
    order = F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("url").isNull(), F.col("url"))
    firsts = durable(
        whole.groupBy("mark")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        # targets can be long; a digest tells whether a page's is the first one's
        .select("mark", F.col("first.page_id").alias("first"), _capture(F.col("first.url")).alias("capture"))
    )
    if firsts.count() <= BROADCAST_FIRSTS:
        firsts = F.broadcast(firsts)
    first = F.col("first").eqNullSafe(F.col("page_id")) & (F.col("capture") == _capture(F.col("url")))
    return whole.join(firsts, "mark", "left").select(
        "page_id",
        "url",
        "payload",
        (F.col("capture").isNotNull() & ~first).alias("revisit"),
        F.col("first").alias("refers_to"),
    )


def _capture(url) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.concat(F.lit("<"), url), F.lit("")), 256))


def _write(folder: str, archive_bytes: int, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = fs.FileSystem.from_uri(folder)
        where.create_dir(root, recursive=True)
        name = writer = None
        done = []

        def closed():
            writer.close()
            done.append((name, writer.n_records, writer.n_bytes))

        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    # as it is: by its name the file would be compressed once more
                    stream = where.open_output_stream(f"{root}/{name}", compression=None)
                    writer = ArchiveWriter(stream, level)
                page, first = row["page_id"].as_py(), row["refers_to"].as_py()
                writer.add(
                    record_bytes(page, row["url"].as_py(), row["payload"].as_py(), first, row["revisit"].as_py())
                )
                if writer.n_bytes >= archive_bytes:
                    closed()
                    writer = None
        if writer is not None:
            closed()
        names, records, sizes = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
            ["path", "n_records", "n_bytes"],
        )

    return write


def write_archives(
    pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = LEVEL
) -> DataFrame:
    """Write a record per page and return the manifest (path, n_records, n_bytes)."""
    spark = pages.sparkSession
    written = with_roles(pages).mapInArrow(_write(f"{folder}/archives", archive_bytes, level), MANIFEST)
    written.write.parquet(f"{folder}/manifest")
    return spark.read.schema(written.schema).parquet(f"{folder}/manifest")


def _read(folder: str, strict: bool, whole: bool, schema: pa.Schema, rows: int = 256):
    kind = schema.field("page_id").type

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held = []
                with where.open_input_stream(f"{root}/{path}", compression=None) as stream:
                    for position, fields in read_frames(stream):
                        if strict and fields["wrong"]:
                            raise Malformed(f"{path} at byte {position}: {fields['wrong']}")
                        if not whole:
                            fields.pop("payload", None)
                        held.append(fields | {"path": path, "position": position})
                        if len(held) == rows:
                            yield packed(held)
                            held = []
                if held:
                    yield packed(held)

    def packed(held: list[dict]) -> pa.RecordBatch:
        columns = []
        for field in schema:
            values = [x.get(field.name) for x in held]
            if field.name in ("page_id", "refers_to"):
                columns.append(pa.array(values, pa.string()).cast(kind))
            else:
                columns.append(pa.array(values, field.type))
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    return read


def read_archives(
    spark: SparkSession, folder: str, manifest: DataFrame, kind: str = "bigint", strict: bool = True, payloads: bool = True
) -> DataFrame:
    """A row per record of the archives that the manifest lists, with its position.

    ``kind`` is the type of page ids. Without ``payloads`` that column is left out; the
    payloads are decoded and checked all the same.
    """
    fields = RECORDS.format(kind=kind).split(", ")
    schema = ", ".join(f for f in fields if payloads or f != "payload binary")
    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)
    return (
        manifest.select("path")
        .repartition(max(1, spark.sparkContext.defaultParallelism), "path")
        .mapInArrow(_read(f"{folder}/archives", strict, payloads, arrow), schema)
    )


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages' archives, read them back and return what their records say."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "archives")
    manifest = write_archives(pages, folder)
    kind = pages.schema["page_id"].dataType.simpleString()
    return read_archives(spark, folder, manifest, kind, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
