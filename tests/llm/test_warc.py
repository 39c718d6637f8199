from __future__ import annotations

import io
import struct

import pytest
import zstandard

from clickledger.llm.warc import (
    DICTIONARY_MAGIC, ArchiveWriter, frames, page_of, parse, read_archives, record, train_dictionary, write_archives,
)
from small import SMALL

DATE = "2024-01-01T00:00:00Z"


def response(i, payload):
    import hashlib

    return record("response", f"urn:x-page:{i}", DATE, "http://a/ b\r\nX: y", hashlib.sha256(payload).hexdigest(), payload, len(payload), None)


@pytest.fixture
def make_pages(spark):
    return lambda rows: spark.createDataFrame(list(rows), "page_id LONG, url STRING, html STRING")


def test_revisits_nulls_and_extra_columns(spark, make_pages, tmp_path):
    long = "é" * 60
    rows = [(5, "u", long), (3, None, long), (9, "u", long), (1, "u", None), (2, "u", ""), (7, "u", "x" * 99), (8, "u", "x" * 99), (None, "u", long), (3, "v", long)]
    pages = make_pages(rows).selectExpr("*", "'x' AS digest", "1 AS first")
    read = read_archives(write_archives(pages, str(tmp_path), most=200))
    got = sorted((r.id if r.id is not None else -1, r.record_type, r.to, r.payload_bytes, r.error) for r in read.select("*", page_of("record_id").alias("id"), page_of("refers_to").alias("to")).collect())
    assert got == [
        (-1, "revisit", 3, 120, None), (1, "response", None, 0, None), (2, "response", None, 0, None),
        (3, "response", None, 120, None), (3, "response", None, 120, None), (5, "revisit", 3, 120, None),
        (7, "response", None, 99, None), (8, "response", None, 99, None), (9, "revisit", 3, 120, None),
    ]
    assert read_archives(write_archives(make_pages([]), str(tmp_path))).collect() == []


def test_payloads_come_back_whole(spark, tmp_path):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    archives = write_archives(pages, str(tmp_path))
    want = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    rows = read_archives(archives).select("*", page_of("record_id").alias("id")).collect()
    assert archives.selectExpr("sum(records)").first()[0] == len(rows) == len(want)
    assert all(r.error is None for r in rows)
    assert all(bytes(r.payload) == want[r.id] for r in rows if r.record_type == "response")
    with open(archives.first().path, "rb") as file:
        assert struct.unpack("<I", file.read(4))[0] == DICTIONARY_MAGIC


def test_dictionary_plain_compressed_or_absent(spark, tmp_path):
    dictionary = train_dictionary(spark.read.parquet(f"{SMALL}/pages.parquet"))
    raw = [response(i, b"<html>%d" % i) for i in range(50)]
    with_it = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    body = b"".join(with_it.compress(r) for r in raw)
    for leading in (dictionary, zstandard.ZstdCompressor().compress(dictionary)):
        archive = struct.pack("<II", DICTIONARY_MAGIC, len(leading)) + leading + struct.pack("<II", 0x184D2A50, 3) + b"abc" + body
        assert list(frames(io.BytesIO(archive))) == raw
    writer = ArchiveWriter(str(tmp_path), None, 300)
    for r in raw:
        writer.write(r)
    writer.close()
    assert len(writer.done) > 1 and sum(n for _, n, _ in writer.done) == 50
    assert [x for path, _, _ in writer.done for x in frames(open(path, "rb"))] == raw


def test_broken_records_and_frames(spark, tmp_path):
    good = response(1, b"hello")
    assert parse(good)["target_uri"] == "http://a/%20b%0D%0AX:%20y"
    broken = [
        good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"WARC-Date", b"X-Date"), good[:-1], good.replace(b"hello", b"hallo"),
        good.replace(b"Content-Length: 5", b"Content-Length: 6"), b"", good.replace(b"response\r\nWARC-R", b"revisit\r\nWARC-R", 1),
    ]
    for raw in broken:
        with pytest.raises(ValueError):
            parse(raw)
    compress = zstandard.ZstdCompressor().compress
    (tmp_path / "a.warc.zst").write_bytes(compress(good) + compress(broken[0]) + compress(good) + compress(good)[:-3])
    (tmp_path / "b.warc.zst").write_bytes(b"")
    paths = spark.createDataFrame([(str(tmp_path / "a.warc.zst"),), (str(tmp_path / "b.warc.zst"),), (None,)], "path STRING")
    rows = sorted(read_archives(paths).collect(), key=lambda r: r.number)
    assert [r.error is None for r in rows] == [True, False, True, False]


def test_an_id_on_most_rows_gives_one_sample(spark, monkeypatch):
    pages = spark.range(2000).selectExpr("IF(id < 1900, 7, id) AS page_id", "CONCAT('<p>page ', id % 5, REPEAT(' body', 40)) AS html")
    seen = []
    monkeypatch.setattr(zstandard, "train_dictionary", lambda size, samples: seen.append(samples) or zstandard.ZstdCompressionDict(b"x" * 64))
    assert train_dictionary(pages) == train_dictionary(pages.repartition(3)) == b"x" * 64
    assert len(seen[0]) == 101 and seen[0] == seen[1]
