"""WARC archives in Zstandard: a dictionary in the leading skippable frame, one frame per record."""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.llm.common import slices, stage, stage_path

# Fixed values of the archive format.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Equal payloads of so many bytes are stored once.
LEAST_REVISIT = 100
#: An archive is closed once it has so many bytes.
ARCHIVE_BYTES = 64 << 20
#: The dictionary's size, and what it is trained on: the heads of so many pages with the least id hash.
DICTIONARY_BYTES, DICTIONARY_PAGES, DICTIONARY_HEAD = 32 << 10, 200, 16 << 10
_CHUNK = 64 << 10
_URN = "urn:x-page:"


def train_dictionary(pages: DataFrame) -> bytes | None:
    """A dictionary from a bounded sample of pages; none if they are too few or too short to train on.

    Of several pages with one id the least head counts, found on the executors.
    """
    chosen = pages.filter("page_id IS NOT NULL").select("page_id").distinct()
    chosen = chosen.orderBy(F.xxhash64("page_id"), "page_id").limit(DICTIONARY_PAGES)
    head = F.substring("html", 1, DICTIONARY_HEAD)
    heads = pages.join(F.broadcast(chosen), "page_id").groupBy("page_id").agg(F.min(head).alias("head"))
    samples = [r["head"].encode() for r in sorted(heads.collect(), key=lambda r: r["page_id"]) if r["head"]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 16 else None
    except zstandard.ZstdError:
        return None


def record(kind: str, record_id: str, date: str, uri: str | None, digest: str, payload: bytes | None, length: int, refers_to: str | None) -> bytes:
    """One WARC record; a revisit carries the HTTP head with the payload's length, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload or b"")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if uri is None else quote(uri, safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Refers-To", None if refers_to is None else f"<{refers_to}>"),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


class ArchiveWriter:
    """Writes archives below ``root``, each with its own copy of the dictionary."""

    def __init__(self, root: str, dictionary: bytes | None, most: int = ARCHIVE_BYTES):
        self.root, self.dictionary, self.most = root.rstrip("/"), dictionary, most
        extra = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, **extra)
        self.file = None
        self.done: list[tuple[str, int, int]] = []

    def _open(self) -> None:
        self.path, self.records, self.bytes = f"{self.root}/{uuid.uuid4().hex}.warc.zst", 0, 0
        system, place = fs.FileSystem.from_uri(self.root)
        system.create_dir(place, recursive=True)
        self.file = system.open_output_stream(f"{place}/{self.path.rsplit('/', 1)[1]}", compression=None)
        if self.dictionary:
            body = zstandard.ZstdCompressor(level=9).compress(self.dictionary)
            self.file.write(struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body)

    def write(self, raw: bytes) -> None:
        if self.file is None:
            self._open()
        frame = self.compressor.compress(raw)
        self.file.write(frame)
        self.records += 1
        self.bytes += len(frame)
        if self.bytes >= self.most:
            self.close()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.done.append((self.path, self.records, self.bytes))
            self.file = None


def write_archives(pages: DataFrame, root: str, date: str = "2024-01-01T00:00:00Z", most: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)`` below ``root``; returns ``path, records, bytes``.

    ``root`` is a folder that all executors reach, by any path that Arrow's file systems know. Of equal
    payloads of at least LEAST_REVISIT bytes those with the smallest page_id are responses, the others
    revisits of it; a null page_id counts as the largest, and if no copy has an id all are responses.
    Null html is an empty payload; without a url the record has no target. An archive is listed only once
    its task has ended, so files that lost tasks leave behind are never read. Columns other than the
    three are ignored. An empty table writes nothing.
    """
    dictionary = train_dictionary(pages)
    named = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    long = named.filter(F.octet_length("payload") >= LEAST_REVISIT)
    copied = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    marked = named.join(copied.select("digest", "first"), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    marked = marked.select("page_id", "url", "payload", "digest", F.when(again, F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(root, dictionary, most)
        for part in slices(batches, "payload"):
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in part.columns)):
                own = f"{_URN}{page_id}" if page_id is not None else f"{_URN}none:{uuid.uuid4().hex}"
                if refers_to is None:
                    writer.write(record("response", own, date, url, digest, payload, len(payload), None))
                else:
                    writer.write(record("revisit", own, date, url, digest, None, len(payload), f"{_URN}{refers_to}"))
        writer.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in writer.done], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64()))],
            ["path", "records", "bytes"],
        )

    return stage(marked.mapInArrow(run, "path string, records long, bytes long"), "archives")


def frames(file) -> Iterator[bytes]:
    """The decoded frames of an archive, one after another; memory holds a chunk and one frame.

    A leading skippable frame with the dictionary's mark is loaded, itself compressed or plain; other
    skippable frames are passed over. A cut or broken frame raises ``ZstdError``.
    """
    held, first = b"", True
    decompressor = zstandard.ZstdDecompressor()

    def more(n: int) -> bool:
        nonlocal held
        while len(held) < n and (chunk := file.read(max(_CHUNK, n - len(held)))):
            held += chunk
        return len(held) >= n

    while more(1):
        if not more(4):
            raise zstandard.ZstdError("the archive ends inside a frame's mark")
        magic = struct.unpack_from("<I", held)[0]
        if magic in SKIPPABLE:
            if not more(8) or not more(8 + struct.unpack_from("<I", held, 4)[0]):
                raise zstandard.ZstdError("the archive ends inside a skippable frame")
            size = struct.unpack_from("<I", held, 4)[0]
            body, held = held[8 : 8 + size], held[8 + size :]
            if first and magic == DICTIONARY_MAGIC:
                if body[:4] == zstandard.FRAME_HEADER:
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            first = False
            continue
        first, whole = False, decompressor.decompressobj()
        parts = [whole.decompress(held)]
        while not whole.eof:
            chunk = file.read(_CHUNK)
            if not chunk:
                raise zstandard.ZstdError("the archive ends inside a frame")
            parts.append(whole.decompress(chunk))
        held = whole.unused_data
        yield b"".join(parts)


def parse(raw: bytes) -> dict:
    """A record's fields, checked: version, required headers, lengths, and a response's digest."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] not in VERSIONS:
        raise ValueError("no WARC header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon or not name.strip():
            raise ValueError(f"not a header line: {name[:80]}")
        headers[name.strip().lower()] = value.strip()
    for name in REQUIRED:
        if not headers.get(name.lower()):
            raise ValueError(f"no {name}")
    if not re.fullmatch("[0-9]+", headers["content-length"]):
        raise ValueError("Content-Length is no number")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {length}, the block has {len(rest) - 4}")
    out = {
        "record_type": headers["warc-type"],
        "record_id": headers["warc-record-id"].strip("<>"),
        "date": headers["warc-date"],
        "target_uri": headers.get("warc-target-uri"),
        "refers_to": headers["warc-refers-to"].strip("<>") if "warc-refers-to" in headers else None,
        "digest": headers.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        "payload_bytes": length,
        "payload": rest[:length],
    }
    if headers.get("content-type", "").startswith("application/http"):
        http, found, body = out["payload"].partition(b"\r\n\r\n")
        declared = re.search(rb"(?im)^content-length:\s*([0-9]+)\s*$", http)
        out["payload_bytes"] = int(declared[1]) if declared else len(body)
        out["payload"] = body if out["record_type"] == "response" else None
        if not found or out["payload"] is not None and len(body) != out["payload_bytes"]:
            raise ValueError(f"the HTTP head says {out['payload_bytes']} bytes, the payload has {len(body)}")
    if out["record_type"] == "revisit" and not out["refers_to"]:
        raise ValueError("a revisit without WARC-Refers-To")
    if out["record_type"] == "response" and out["digest"] and hashlib.sha256(out["payload"]).hexdigest() != out["digest"]:
        raise ValueError("the payload has another digest")
    return out


_TEXT = ["record_type", "record_id", "date", "target_uri", "refers_to", "digest"]
_READ = pa.schema(
    [("path", pa.string()), ("number", pa.int64()), *[(c, pa.string()) for c in _TEXT]]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary()), ("error", pa.string())]
)
_BATCH_BYTES = 4 << 20


def read_archives(archives: DataFrame) -> DataFrame:
    """A row per record of the archives in ``path``, decoded frame by frame.

    Columns: path, number (of the record in its archive), record_type, record_id, date, target_uri,
    refers_to, digest, payload_bytes, payload (null for revisits), error. A record that fails a check
    gives a row with ``error`` and no fields, and reading goes on; a broken frame gives one such row and
    ends its archive, since later frames cannot be found. A file that cannot be opened raises. Null
    paths are skipped; no archives give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for row in _records(path):
                    rows.append(row)
                    held += len(row.get("payload") or b"")
                    if held >= _BATCH_BYTES or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                        rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    ddl = "path string, number long, " + ", ".join(f"{c} string" for c in _TEXT) + ", payload_bytes long, payload binary, error string"
    return archives.select("path").filter("path IS NOT NULL").repartition("path").mapInArrow(run, ddl)


def _records(path: str) -> Iterator[dict]:
    system, place = fs.FileSystem.from_uri(path)
    number = 0
    with system.open_input_stream(place, compression=None) as file:
        try:
            for raw in frames(file):
                try:
                    fields = parse(raw)
                except ValueError as fault:
                    fields = {"error": str(fault)}
                yield {"path": path, "number": number, **fields}
                number += 1
        except zstandard.ZstdError as fault:
            yield {"path": path, "number": number, "error": str(fault)}


def page_of(urn: str) -> F.Column:
    """The page_id in a record's name, null where there is none."""
    return F.regexp_extract(F.col(urn), f"^{_URN}(-?[0-9]+)$", 1).try_cast("long")


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Archives in the shared folder, written and read back."""
    return read_archives(write_archives(pages, stage_path(pages.sparkSession, "warc")))
