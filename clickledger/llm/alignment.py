"""Two tokenizers' tokens of the same texts, aligned where their byte offsets meet, with link statistics."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from clickledger.llm.bytewords import text_bytes
from clickledger.llm.common import slices, stage

#: Texts of one block share one list of id pairs; its size bounds the memory of a task.
BLOCK_BYTES = 3 << 20
#: Characters given to a tokenizer at a time, since its own results are many times as large.
_GIVEN = 1 << 18
#: Groups with more links than this are counted by their distinct ids; results are the same.
WIDE = 4096
#: The pattern that byte-level tokenizer files split by, unless told otherwise.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts of characters whose class every library agrees on: ASCII, Latin letters, common punctuation.
_PLAIN = re.compile("[\t\n\r -~¡-ɏ‐-‧‰-⁞]*")


def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}


class Side:
    """A tokenizer's ids for texts, and the bytes of each id, one after another with their ends."""

    def _keep(self, table: list[bytes]) -> None:
        self.flat = np.frombuffer(b"".join(table), np.uint8)
        self.size = np.fromiter(map(len, table), np.int64, len(table))
        self.first = np.cumsum(self.size) - self.size

    def arrays(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, a few texts at a time; an empty text has none."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        given: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            if text:
                given.append(i)
                size += len(text)
            if given and (size >= _GIVEN or i == len(texts) - 1):
                for j, ids in zip(given, self.encode([texts[k] for k in given])):
                    out[j] = np.asarray(ids, np.int32)
                given, size = [], 0
        return out

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.flat[np.arange(size.sum()) + np.repeat(self.first[ids] - (ends - size), size)]


class ByteLevel(Side):
    """A byte-level BPE file of the tokenizers library; special strings in texts are plain text.

    Texts of plain characters are merged by the ranks that the file's own vocabulary gives, which is
    the same and faster; all others go through the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        added = {a["content"] for a in spec["added_tokens"]}
        alphabet = _byte_alphabet()
        table = [b""] * (max(self.tokenizer.get_vocab().values()) + 1)
        for token, i in spec["model"]["vocab"].items():
            table[i] = token.encode() if token in added else bytes(map(alphabet.__getitem__, token))
        self._keep(table)
        ranks = {table[i]: i for token, i in spec["model"]["vocab"].items() if token not in added}
        self.ranked = tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        plain = [_PLAIN.fullmatch(t) is not None for t in texts]
        odd = [t for t, p in zip(texts, plain) if not p]
        rest = iter([e.ids for e in self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)])
        return [self.ranked.encode_ordinary(t) if p else next(rest) for t, p in zip(texts, plain)]


class Pieces(Side):
    """A sentencepiece model; it puts the space before a text itself."""

    def __init__(self, path: str):
        self.processor = SentencePieceProcessor(model_file=path)
        n = self.processor.get_piece_size()
        names = [self.processor.id_to_piece(i) for i in range(n)]
        self._keep(
            [
                bytes([int(name[3:5], 16)]) if self.processor.is_byte(i) else name.replace("▁", " ").encode()
                for i, name in enumerate(names)
            ]
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(path_a), Pieces(path_b)


def gallop(
    wanted: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray, values: np.ndarray
) -> np.ndarray:
    """For each ``wanted[i]`` the first place in the ascending ``values[low[i]:high[i]]`` that is not below it.

    Every search sets out from its own ``start[i]``: steps of 1, 2, 4... in the direction of the value
    until it is passed, then halving between the last two steps. All searches take a step together.
    """
    start = np.clip(start, low, high - 1)
    below = values[start] < wanted
    left = np.where(below, start, low - 1)  # a place below wanted, or before all
    right = np.where(below, high, start)  # a place not below wanted, or after all
    step = np.ones(len(wanted), np.int64)
    rows = np.arange(len(wanted))
    while len(rows):
        up = below[rows]
        probe = np.where(up, left[rows] + step[rows], right[rows] - step[rows])
        inside = np.where(up, probe < right[rows], probe > left[rows])
        rows, probe, up = rows[inside], probe[inside], up[inside]
        less = values[probe] < wanted[rows]
        left[rows[less]], right[rows[~less]] = probe[less], probe[~less]
        rows = rows[less == up]
        step[rows] *= 2
    rows = np.flatnonzero(right - left > 1)
    while len(rows):
        middle = (left[rows] + right[rows]) // 2
        less = values[middle] < wanted[rows]
        left[rows[less]], right[rows[~less]] = middle[less], middle[~less]
        rows = rows[right[rows] - left[rows] > 1]
    return right


@dataclass
class Tokens:
    """Ids of many texts in one array, where each text's begin and end, and their byte ends in the text."""

    ids: np.ndarray
    bounds: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, side: Side, parts: list[np.ndarray]) -> "Tokens":
        ids = np.concatenate([np.empty(0, np.int32), *parts])
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)
        running = np.concatenate([[0], np.cumsum(side.size[ids])])
        return cls(ids, bounds, running[1:] - np.repeat(running[bounds[:-1]], np.diff(bounds)))

    def only(self, texts: np.ndarray) -> "Tokens":
        """Without the tokens of the other texts, which stay as texts without tokens."""
        n = np.diff(self.bounds)
        kept = np.repeat(texts, n)
        return Tokens(self.ids[kept], np.concatenate([[0], np.cumsum(n * texts)]), self.ends[kept])


def common_ends(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of all tokens that end at the same byte of the same text.

    In each text the shorter list of ends drives: its ends are sought in the longer by galloping, each
    from where an even spread would have it.
    """
    n_a, n_b = np.diff(a.bounds), np.diff(b.bounds)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for short, long, texts in ((a, b, n_a <= n_b), (b, a, n_a > n_b)):
        of = np.repeat(np.arange(len(texts)), np.diff(short.bounds))
        at = np.flatnonzero(texts[of])
        of = of[at]
        low, high = long.bounds[of], long.bounds[of + 1]
        at, of, low, high = (x[high > low] for x in (at, of, low, high))
        length = short.bounds[of + 1] - short.bounds[of]
        guess = low + (at - short.bounds[of]) * (high - low) // length
        place = gallop(short.ends[at], guess, low, high, long.ends)
        meets = place < high
        meets[meets] = long.ends[place[meets]] == short.ends[at[meets]]
        found.append((at[meets], place[meets]))
    (a1, b1), (b2, a2) = found
    at_a, at_b = np.concatenate([a1, a2]), np.concatenate([b1, b2])
    order = np.argsort(at_a)
    return at_a[order], at_b[order]


@dataclass
class Groups:
    """Ranges of tokens between common ends: group g has ``a_from[g]:a_to[g]`` and ``b_from[g]:b_to[g]``."""

    text: np.ndarray
    a_from: np.ndarray
    a_to: np.ndarray
    b_from: np.ndarray
    b_to: np.ndarray


def grouped(a: Tokens, b: Tokens) -> Groups:
    """Common ends slice both lists; where a text's last ends meet, the groups hold all its tokens."""
    at_a, at_b = common_ends(a, b)
    text = np.searchsorted(a.bounds, at_a, side="right") - 1
    first = np.ones(len(text), bool)
    first[1:] = text[1:] != text[:-1]
    a_from = np.where(first, a.bounds[text], np.concatenate([[0], at_a[:-1] + 1]))
    b_from = np.where(first, b.bounds[text], np.concatenate([[0], at_b[:-1] + 1]))
    return Groups(text, a_from, at_a + 1, b_from, at_b + 1)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.arange(size.sum()) + np.repeat(start - (ends - size), size)


def linked_pairs(
    a: Tokens, b: Tokens, groups: Groups, size_a: int, size_b: int, wide: int = WIDE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, id pair, links) for each distinct id pair of each text; a pair is ``a * size_b + b``.

    Groups of up to ``wide`` links are spelled out; in a wider one distinct ids meet, their counts multiplied.
    """
    n_a, n_b = groups.a_to - groups.a_from, groups.b_to - groups.b_from
    links = n_a * n_b
    space = size_a * size_b
    small = links <= wide
    rows = np.repeat(np.flatnonzero(small), n_a[small])
    places = _ranges(groups.a_from[small], n_a[small])
    left = np.repeat(a.ids[places].astype(np.int64), n_b[rows])
    right = b.ids[_ranges(groups.b_from[rows], n_b[rows])]
    key = np.repeat(groups.text[rows].astype(np.int64) * space, n_b[rows]) + left * size_b + right
    key, count = np.unique(key, return_counts=True)
    keys, counts = [key], [count.astype(np.int64)]
    for g in np.flatnonzero(~small).tolist():
        one, times_one = np.unique(a.ids[groups.a_from[g] : groups.a_to[g]].astype(np.int64), return_counts=True)
        two, times_two = np.unique(b.ids[groups.b_from[g] : groups.b_to[g]], return_counts=True)
        keys.append((int(groups.text[g]) * space + one[:, None] * size_b + two[None, :]).ravel())
        counts.append((times_one[:, None] * times_two[None, :]).ravel())
    if len(keys) > 1:
        key, place = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.zeros(len(key), np.int64)
        np.add.at(count, place, np.concatenate(counts))
    return key // space, key % space, count


@lru_cache(maxsize=2)
def _spelled(n: int) -> list[str]:
    """Ids in decimal with each mark that may follow: places 4 * id + (0 ',', 1 '|', 2 ';', 3 nothing)."""
    return [f"{i}{mark}" for i in range(n) for mark in (",", "|", ";", "")]


def group_digests(a: Tokens, b: Tokens, groups: Groups, n_ids: int) -> list[str]:
    """SHA-256 of each text's groups, ``a1,a2|b1;a3|b2,b3``; '' for a text without tokens."""
    mark_a, mark_b = a.ids.astype(np.int64) * 4, b.ids.astype(np.int64) * 4
    mark_a[groups.a_to - 1] += 1
    mark_b[groups.b_to - 1] += 2
    lasts = b.bounds[1:][np.diff(b.bounds) > 0] - 1
    mark_b[lasts] += 1
    n_a, n_b = groups.a_to - groups.a_from, groups.b_to - groups.b_from
    before = np.cumsum(n_a + n_b) - (n_a + n_b)
    flat = np.empty(len(a.ids) + len(b.ids), np.int64)
    flat[_ranges(before, n_a)] = mark_a
    flat[_ranges(before + n_a, n_b)] = mark_b
    spelled = _spelled(n_ids)
    out = []
    for low, high in zip(a.bounds[:-1] + b.bounds[:-1], a.bounds[1:] + b.bounds[1:]):
        line = "".join(map(spelled.__getitem__, flat[low:high].tolist()))
        out.append(hashlib.sha256(line.encode()).hexdigest() if high > low else "")
    return out


def tokenised(texts: pa.Array, a: Side, b: Side) -> tuple[Tokens, Tokens]:
    """Tokens of both sides; a text whose tokens do not spell a space and the text has none on either."""
    texts = texts.fill_null("")
    strings = texts.to_pylist()
    wanted, ends = text_bytes(texts)
    starts = ends - np.diff(ends, prepend=0)
    good = np.ones(len(strings), bool)
    both = []
    for side, given in ((a, [" " + t if t else t for t in strings]), (b, strings)):
        tokens = Tokens.of(side, side.arrays(given))
        spelled = side.bytes_of(tokens.ids)
        length = np.concatenate([[0], np.cumsum(side.size[tokens.ids])])[tokens.bounds]
        same = np.diff(length) == ends - starts + 1
        same[same] &= spelled[length[:-1][same]] == 0x20
        rows = np.flatnonzero(same)
        size = (ends - starts)[rows]
        differ = spelled[_ranges(length[rows] + 1, size)] != wanted[_ranges(starts[rows], size)]
        same[np.repeat(rows, size)[differ]] = False
        good &= same
        both.append(tokens)
    return both[0].only(good), both[1].only(good)


_BLOCKS = (
    "block long, pairs array<long>, holders array<int>, doc_ids array<long>, n_a array<long>, n_b array<long>, "
    "n_groups array<long>, n_links array<long>, digests array<string>, ends array<long>, places binary, links binary"
)


def _packed(values: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def _unpacked(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


def blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per block of texts: its distinct id pairs with the documents that hold each, and per document
    its counts, its digest, and its pairs as places among the block's with their links."""

    schema = _arrow(_BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(path_a, path_b)
        size_a, size_b = len(a.size), len(b.size)
        number = 0
        for part in slices(batches, "text", BLOCK_BYTES):
            one, two = tokenised(part.column("text"), a, b)
            groups = grouped(one, two)
            text, pair, links = linked_pairs(one, two, groups, size_a, size_b)
            pairs, place, holders = np.unique(pair, return_inverse=True, return_counts=True)
            n = part.num_rows
            n_links = np.zeros(n, np.int64)
            np.add.at(n_links, text, links)
            row = {
                "block": (part.column("part")[0].as_py() << 32) | number,
                "pairs": pairs,
                "holders": holders.astype(np.int32),
                "doc_ids": part.column("doc_id").to_pylist(),
                "n_a": np.diff(one.bounds),
                "n_b": np.diff(two.bounds),
                "n_groups": np.bincount(groups.text, minlength=n),
                "n_links": n_links,
                "digests": group_digests(one, two, groups, max(size_a, size_b)),
                "ends": np.searchsorted(text, np.arange(n), side="right"),
                "places": _packed(place, "<u4"),
                "links": _packed(links, "<u8"),
            }
            number += 1
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.spark_partition_id().cast("long").alias("part"),
    )
    return texts.mapInArrow(run, _BLOCKS)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = (f.split() for f in ddl.split(", "))
    return pa.schema([(n, pa.list_(kinds[k[6:-1]]) if k.startswith("array") else kinds[k]) for n, k in fields])


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair, held, best``: documents that hold a pair linked; whether that is the most for its first id.

    A block brings each of its pairs once, so the commonest pair is a row a block, summed before the
    shuffle. An id has at most ``size_b`` pairs.
    """
    rows = aligned.select(F.explode(F.arrays_zip("pairs", "holders")).alias("x")).select("x.pairs", "x.holders")
    held = rows.groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").alias("held"))
    held = stage(held, "pairs")
    first = F.floor(F.col("pair") / size_b)
    most = held.groupBy(first.alias("first")).agg(F.max("held").alias("most"))
    return held.join(most, first == F.col("first")).select("pair", "held", (F.col("held") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document the alignment of its tokens under a byte-level file and a sentencepiece model.

    Returns ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``. Bytes where tokens of
    both end cut them into groups; every token of one side in a group links with every one of the other.
    A pair of ids counts the documents that hold it linked; ``count_sum`` adds that over a document's
    links, ``n_best`` counts links whose pair has its first id's highest count.

    Every text is tokenised once; blocks are staged with their pairs, the pairs' counts come back as one
    row per block and pair, and a task holds one block. Texts null or empty, or that the tokens do not
    spell, have no tokens: zeros and ''. Null and repeated doc_ids are rows like others. Columns other
    than doc_id and text are ignored. An empty table gives no rows.
    """
    aligned = stage(blocks(docs, path_a, path_b), "aligned")
    size_b = len(sides(path_a, path_b)[1].size)
    counts = pair_counts(aligned, size_b)
    asked = aligned.select("block", F.explode("pairs").alias("pair"))
    answers = asked.join(counts, "pair").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("pair", "held", "best"))).alias("answers")
    )
    columns = ["doc_ids", "n_a", "n_b", "n_groups", "n_links", "digests", "ends", "places", "links"]
    joined = aligned.select("block", *columns).join(answers, "block", "left")
    joined = joined.select(*columns, F.col("answers.held").alias("held"), F.col("answers.best").alias("best"))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                places, links = _unpacked(row["places"].as_py(), "<u4"), _unpacked(row["links"].as_py(), "<u8")
                bounds = np.concatenate([[0], row["ends"].values.to_numpy()])
                sums = []
                for value in ("best", "held"):
                    known = row[value].values if row[value].is_valid else pa.array([], pa.int64())
                    each = links.astype(np.int64) * known.cast(pa.int64()).to_numpy()[places]
                    sums.append(pa.array(np.diff(np.concatenate([[0], np.cumsum(each)])[bounds])))
                kept = [row[c].values for c in columns[:5]]
                yield pa.RecordBatch.from_arrays([*kept, *sums, row["digests"].values], names)

    ddl = ", ".join(f"{n} long" for n in names[:-1]) + ", groups_sha256 string"
    return joined.mapInArrow(run, ddl)
