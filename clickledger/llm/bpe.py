"""Byte-level BPE: every distinct pre-token of the corpus is encoded once, ids return by position."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.llm.bytewords import Words, coded_ranges, cut_marks, hashed, leading, text_bytes, word_bounds
from clickledger.llm.common import mixed, slices

#: Texts of one block are coded against one word list; its size bounds the memory of a task.
BLOCK_BYTES = 4 << 20

_DDL = "block long, bucket int, blob binary, doc_ids array<long>, counts array<int>"
_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("bucket", pa.int32()),
        ("blob", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int32())),
    ]
)


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The token-byte table, by id."""
    table = [b""] * (max(ranks(path).values()) + 1)
    for token, i in ranks(path).items():
        table[i] = token
    return table


@lru_cache(maxsize=2)
def _one_piece(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks(path), special_tokens={})


def _not_plain(data: np.ndarray) -> np.ndarray:
    """Where a byte is of a character whose class may differ between libraries."""
    table = np.zeros(256, bool)
    table[[*range(0x09), *range(0x0E, 0x20), 0x7F, 0xC0, 0xC1, *range(0xCA, 0x100)]] = True
    odd = table[data]
    odd[:-1] |= (data[:-1] == 0xC2) & (data[1:] < 0xA1)
    return odd


def _pieces(texts: pa.Array) -> Words:
    """Ranges that the pattern never matches across: white space with the word after it, closing marks.

    A text with other than plain characters is one range.
    """
    data, text_ends = text_bytes(texts)
    _, ends, _ = word_bounds(data, text_ends)
    odd = np.flatnonzero(_not_plain(data))
    where = np.searchsorted(text_ends, odd, side="right")
    whole = np.zeros(len(text_ends), bool)
    whole[where] = True
    ends = ends[~whole[np.searchsorted(text_ends, ends - 1, side="right")]]
    place = np.searchsorted(ends, text_ends)
    listed = np.append(ends, -1)[place] == text_ends
    trailing = np.unique(text_ends[~listed & (text_ends > 0)])
    ends = np.sort(np.concatenate([ends, trailing]), kind="stable")
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    is_whole = whole[np.searchsorted(text_ends, starts, side="right")]
    begins, stops = cut_marks(data, starts[~is_whole], ends[~is_whole])
    begins = np.sort(np.concatenate([begins, starts[is_whole]]))
    stops = np.sort(np.concatenate([stops, ends[is_whole]]))
    bounds = np.concatenate([[0], np.searchsorted(begins, text_ends, side="left")])
    return coded_ranges(data, text_ends, begins, stops, bounds)


def _spread(parts_size: np.ndarray, flat: np.ndarray, codes: np.ndarray, bounds: np.ndarray):
    """Replace each code by its part of ``flat``; also the bounds after that."""
    first = np.cumsum(parts_size) - parts_size
    length = parts_size[codes]
    ends = np.cumsum(length)
    out = flat[np.arange(length.sum()) + np.repeat(first[codes] - (ends - length), length)]
    return out, np.concatenate([[0], ends])[bounds]


class Block:
    """Pre-tokens of a slice: distinct words by bucket and leading bytes, each text's positions among them."""

    def __init__(self, texts: pa.Array, pattern: regex.Pattern, buckets: int):
        pieces = _pieces(texts)
        index: dict[str, int] = {}
        flat, size = [], []
        for piece in pieces.distinct():
            text = piece.decode()
            if text.isalpha() or (text[0] == " " and text[1:].isalpha()):
                flat.append(index.setdefault(text, len(index)))
                size.append(1)
            else:
                found = pattern.findall(text)
                flat += [index.setdefault(w, len(index)) for w in found]
                size.append(len(found))
        words = [w.encode() for w in index]
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        blob = np.frombuffer(b"".join(words), np.uint8)
        starts = ends - np.diff(ends, prepend=0)
        hashes = hashed(blob, starts, ends)[0]
        bucket = (mixed(hashes) >> np.uint64(33)).astype(np.int64) % buckets
        order = np.lexsort((hashes, leading(blob, starts, ends), bucket))
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words), dtype=np.int32)
        self.words = [words[i] for i in order]
        self.starts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        flat = rank[np.array(flat, np.int64)] if flat else np.empty(0, np.int32)
        self.codes, self.bounds = _spread(np.array(size, np.int64), flat, pieces.codes, pieces.bounds)


def _joined(parts: list[bytes]) -> bytes:
    """Parts and their lengths in one compressed value."""
    size = np.array([len(parts), *map(len, parts)], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(size + b"".join(parts))


def _digest(words: list[bytes]) -> int:
    size = np.array(list(map(len, words)), "<u4").tobytes()
    return int(np.uint64(xxhash.xxh3_64_intdigest(size + b"".join(words))).view(np.int64))


def _parted(blob: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = (np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 * (n + 1)).tolist()
    return [raw[a:b] for a, b in zip([4 * (n + 1), *ends], ends)]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def encode(docs: DataFrame, rank_file: str, pattern: str, buckets: int | None = None, round_trip: bool = False) -> DataFrame:
    """``doc_id, ids``: each text's ids as little-endian 32-bit integers, as tiktoken would give them.

    With ``round_trip`` also ``decoded``, the ids decoded in the task that put them in order.

    Texts are cut into blocks of about BLOCK_BYTES. A block's distinct pre-tokens go to ``buckets`` hash
    buckets (default: the shuffle partitions), one row per block and bucket, so the commonest word costs
    a row no more than a rare one; each bucket encodes each of its words once for the whole corpus. The
    ids go back to the blocks, where every text's positions put them in order. A task holds one block,
    or the distinct words of one bucket. ``docs`` is read twice and must give the same rows in the same
    partitions both times, as a table does. Each word list travels with a digest, and positions with the
    digests of the lists they were made for, so a difference raises and never gives wrong ids.

    Null texts are empty and give no ids. Null and repeated doc_ids are rows like others. Columns other
    than doc_id and text are ignored. An empty table gives no rows.
    """
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.spark_partition_id().alias("part"),
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, Block]]:
        compiled = regex.compile(pattern)
        for number, rows in enumerate(slices(batches, "text", BLOCK_BYTES)):
            part = rows.column("part")[0].as_py()
            yield (part << 32) | number, rows, Block(rows.column("text"), compiled, buckets)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, block in blocks(batches):
            spans = zip(block.starts[:-1], block.starts[1:])
            listed = [(k, block.words[a:b]) for k, (a, b) in enumerate(spans) if b > a]
            yield _rows([(number, k, _joined(part), [_digest(part)], None) for k, part in listed])

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows, block in blocks(batches):
            spans = zip(block.starts[:-1], block.starts[1:])
            digests = np.array([_digest(block.words[a:b]) for a, b in spans if b > a], "<i8").tobytes()
            codes = _joined([digests, block.codes.astype("<u4").tobytes()])
            counts = np.diff(block.bounds).astype(np.int32)
            yield _rows([(number, buckets, codes, rows.column("doc_id").to_pylist(), counts)])

    def ids_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, at, known = _one_piece(rank_file), None, {}
        for batch in batches:
            out = []
            for number, bucket, blob, digest in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "blob", "doc_ids"))):
                if bucket != at:
                    at, known = bucket, {}
                listed = _parted(blob)
                for word in listed:
                    if word not in known:
                        known[word] = np.array(encoding.encode_ordinary(word.decode()), "<u4").tobytes()
                out.append((number, bucket, _joined(list(map(known.__getitem__, listed))), digest, None))
            yield _rows(out)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[bytes] = []
        digests: list[int] = []
        at = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != at:
                    if parts:
                        raise ValueError("the documents changed between two reads")
                    at = row["block"]
                if row["bucket"] < buckets:
                    parts += _parted(row["blob"])
                    digests += row["doc_ids"]
                    continue
                expected, codes = _parted(row["blob"])
                if np.array(digests, "<i8").tobytes() != expected:
                    raise ValueError("the documents changed between two reads")
                size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
                flat = np.frombuffer(b"".join(parts), "<u4")
                bounds = np.concatenate([[0], np.cumsum(row["counts"], dtype=np.int64)])
                ids, bounds = _spread(size, flat, np.frombuffer(codes, "<u4"), bounds)
                ids = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                columns = {"doc_id": pa.array(row["doc_ids"], pa.int64()), "ids": pa.array([i.tobytes() for i in ids], pa.binary())}
                if round_trip:
                    columns["decoded"] = pa.array([decoded_bytes(i, rank_file) for i in ids], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)
                parts, digests = [], []
        if parts:
            raise ValueError("the documents changed between two reads")

    listed = texts.mapInArrow(words, _DDL).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    known = listed.mapInArrow(ids_of_words, _DDL)
    both = known.unionAll(texts.mapInArrow(positions, _DDL))
    ddl = "doc_id long, ids binary" + ", decoded binary" * round_trip
    return both.repartition("block").sortWithinPartitions("block", "bucket").mapInArrow(assemble, ddl)


def decoded_bytes(ids: np.ndarray, rank_file: str) -> bytes:
    """The bytes of some ids, looked up in the token-byte table and put in order."""
    return b"".join(map(token_bytes(rank_file).__getitem__, ids.tolist()))


def decode(encoded: DataFrame, rank_file: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ids, joined from the token-byte table in order.

    The table has one row per token of the vocabulary, a fixed size, so each task joins it from memory.
    Null ids decode to null, no ids to no bytes; an id outside the table raises.
    """

    @F.udf("binary", useArrow=True)
    def bytes_of(ids: bytes | None) -> bytes | None:
        return None if ids is None else decoded_bytes(np.frombuffer(ids, "<u4"), rank_file)

    return encoded.withColumn("decoded", bytes_of("ids"))
