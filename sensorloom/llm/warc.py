"""WARC archives in seekable Zstandard bundles."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import looked_up, shared_folder, stored

#: Bytes of records after which a frame, and a bundle, is closed.
FRAME, BUNDLE = 1 << 18, 1 << 25
#: Fixed values of the seekable Zstandard format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Fixed value: the profile of a WARC revisit record with an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record: a response, or a revisit of the response of page ``refers_to``."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    # a URL is one token of a header line
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {uri}"] if uri else []),
        *(
            [f"WARC-Refers-To: <{ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
            if refers_to is not None
            else []
        ),
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, HTTP header and payload of one record; its digests must hold."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size = int(fields["Content-Length"])
    block = rest[:size]
    http, _, payload = block.partition(b"\r\n\r\n")
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"{fields['WARC-Record-ID']}: broken record")
    if fields["WARC-Block-Digest"] != f"sha1:{payload_digest(block)}":
        raise ValueError(f"{fields['WARC-Record-ID']}: the block's digest differs")
    return fields, http, payload


class BundleWriter:
    """Independent frames, then a skippable frame with the table of their sizes."""

    def __init__(self, path: str):
        system, at = pa.fs.FileSystem.from_uri(path)
        system.create_dir(at.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(at, compression=None)
        self.sizes: list[tuple[int, int]] = []
        self.frame: list[bytes] = []
        self.filled = self.written = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame and offset inside its decompressed bytes."""
        at = len(self.sizes), self.filled
        self.frame.append(data)
        self.filled += len(data)
        self.written += len(data)
        if self.filled >= FRAME:
            self.flush()
        return at

    def flush(self) -> None:
        if self.frame:
            packed = zstandard.ZstdCompressor(level=3).compress(b"".join(self.frame))
            self.out.write(packed)
            self.sizes.append((len(packed), self.filled))
            self.frame, self.filled = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *size) for size in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Reads single frames of a bundle by the seek table at its end."""

    def __init__(self, path: str):
        system, at = pa.fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(at)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE or flags & 0x7F:
            raise ValueError(f"{path}: no seek table")
        entry = 12 if flags & 0x80 else 8
        table = self.file.read_at(n * entry, size - 9 - n * entry)
        self.frames, start = [], 0
        for k in range(n):
            packed, plain = struct.unpack_from("<II", table, k * entry)
            self.frames.append((start, packed, plain))
            start += packed

    def read(self, frame: int) -> bytes:
        start, packed, plain = self.frames[frame]
        return zstandard.ZstdDecompressor().decompress(
            self.file.read_at(packed, start), max_output_size=max(plain, 1)
        )

    def close(self) -> None:
        self.file.close()


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, refers_to``: of equal payloads of at least ``min_bytes`` bytes that
    with the largest page_id stands for all; the others refer to it. The pages of a payload that very
    many share are not gathered: what they refer to is broadcast."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("same", F.unhex(F.sha2("payload", 256)))
    keeper = rows.groupBy("same").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    keeper = stored(keeper, "payloads")
    total = keeper.agg(F.sum("n")).first()[0] or 0
    refers = F.when(
        (F.octet_length("payload") >= min_bytes)
        & ~F.coalesce(F.col("page_id") == F.col("keeper"), F.lit(False)),
        F.col("keeper"),
    )
    found = looked_up(rows, keeper, ["same"], total, ["page_id", "url"])
    return found.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archive(
    pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z"
) -> DataFrame:
    """Writes a WARC record for every row of ``pages(page_id, url, html)`` into bundles under
    ``folder`` (any path that pyarrow can open from all executors), and returns the index:
    ``page_id, bundle, frame, offset, length``.

    A bundle's name is the attempt's own and only the index of the attempt that counted is kept,
    so a task that is run again leaves at most files that nothing refers to.
    """

    def write(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = path = None
        for batch in source:
            out = {"page_id": [], "bundle": [], "frame": [], "offset": [], "length": []}
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))
            for id, url, payload, refers_to in zip(*columns):
                if writer is not None and writer.written >= BUNDLE:
                    writer.close()
                    writer = None
                if writer is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(path)
                data = record(id, url, payload, refers_to, date)
                frame, offset = writer.add(data)
                for name, value in zip(out, (id, path, frame, offset, len(data))):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(
                out,
                pa.schema(
                    [
                        ("page_id", pa.int64()),
                        ("bundle", pa.string()),
                        ("frame", pa.int32()),
                        ("offset", pa.int64()),
                        ("length", pa.int64()),
                    ]
                ),
            )
        if writer is not None:
            writer.close()

    return stored(
        revisits(pages, min_bytes).mapInArrow(
            write, "page_id long, bundle string, frame int, offset long, length long"
        ),
        "warc-index",
    )


def read_records(index: DataFrame) -> DataFrame:
    """The records that rows of an index name, from their frames alone: ``page_id, url,
    record_type, refers_to, payload_bytes, payload_digest, payload`` (NULL for a revisit).
    All rows of an index read the whole archive."""

    def read(group: pa.Table) -> pa.Table:
        names = ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")
        out = {name: [] for name in names}
        group = group.sort_by([("frame", "ascending"), ("offset", "ascending")])
        reader, now, frame = BundleReader(group.column("bundle")[0].as_py()), None, b""
        places = (group.column(c).to_pylist() for c in ("frame", "offset", "length"))
        for at, offset, length in zip(*places):
            if at != now:
                now, frame = at, reader.read(at)
            fields, http, payload = parsed(frame[offset : offset + length])
            refers = fields.get("WARC-Refers-To")
            sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if refers is None and payload_digest(payload) != sha:
                raise ValueError(f"{fields['WARC-Record-ID']}: the payload's digest differs")
            id = fields["WARC-Record-ID"][1:-1].removeprefix(ID)
            size = int(re.search(rb"Content-Length: (\d+)", http)[1])
            values = (
                int(id) if id else None,
                fields.get("WARC-Target-URI"),
                fields["WARC-Type"],
                int(refers[1:-1].removeprefix(ID)) if refers else None,
                size,
                sha,
                None if refers else payload,
            )
            for name, value in zip(names, values):
                out[name].append(value)
        reader.close()
        types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.table(dict(zip(names, (pa.array(out[n], t) for n, t in zip(names, types)))))

    return (
        index.select("bundle", "frame", "offset", "length")
        .groupBy("bundle")
        .applyInArrow(
            read,
            "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
            "payload_digest string, payload binary",
        )
    )


def archived(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Writes ``pages(page_id, url, html)`` as WARC and reads all of it back: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to`` for every row.

    A NULL html is an empty payload; empty payloads are equal to each other. A NULL url leaves the
    target out. A row with a NULL page_id is a record without a number: it refers to the payload's
    largest page_id if there is one and is a response otherwise. Rows that repeat the largest
    page_id are all responses. Other columns are ignored.
    """
    folder = folder or shared_folder(pages.sparkSession, "warc")
    index = write_archive(pages, folder, min_bytes)
    return read_records(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
