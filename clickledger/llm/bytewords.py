"""Words of a whole slice of texts at once, from the text column's bytes, as integer codes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from clickledger.llm.common import mixed

#: Space and tab to carriage return.
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: Marks that may close a word.
_MARK, _ALNUM = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True
_ALNUM[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")] = True
_MOST_MARKS = 8

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Words:
    """Words in order as ``codes``; text i has ``codes[bounds[i]:bounds[i + 1]]``.

    ``starts`` and ``ends`` are byte positions in ``data``; ``first`` is a word of each code.
    """

    data: np.ndarray
    text_ends: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    codes: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def distinct(self) -> list[bytes]:
        blob, a, b = self.data.tobytes(), self.starts[self.first].tolist(), self.ends[self.first].tolist()
        return [blob[i:j] for i, j in zip(a, b)]

    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, nulls as empty, and the end of each text among them."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(texts), np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    at = at.astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at[1:] - at[0]


def word_bounds(data: np.ndarray, text_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII white space, never across texts, and their bounds."""
    solid = ~_WHITE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:]
    inner = text_ends[(text_ends > 0) & (text_ends < len(data))]
    begins[inner] = solid[inner]
    stops[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.concatenate([[0], np.searchsorted(starts, text_ends, side="left")])


def cut_marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut closing marks off each range where an ASCII or Latin letter or a digit stands before them.

    Patterns that match letters, digits and other signs apart end a match there in any case, so both
    parts tokenise as they do together.
    """
    cut = ends.copy()
    for _ in range(_MOST_MARKS):
        moved = (cut - 1 > starts) & _MARK[data[cut - 1]]
        if not moved.any():
            break
        cut -= moved
    if len(cut):
        last, before = data[cut - 1], data[np.maximum(cut - 2, 0)]
        wide = (last >= 0x80) & (last < 0xC0) & (before >= 0xC3) & (before <= 0xC9) & (cut - 2 >= starts)
        wide &= ~((before == 0xC3) & ((last == 0x97) | (last == 0xB7)))  # the times and division signs
        wide &= ~((before == 0xC4) & (last == 0xB0))  # dotted I, whose small form ends in a mark
        cut = np.where(_ALNUM[last] | wide, cut, ends)
    begins = np.stack([starts, cut], axis=1).reshape(-1)
    stops = np.stack([cut, ends], axis=1).reshape(-1)
    real = stops > begins
    return begins[real], stops[real]


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each byte range, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))
    length = (ends - starts).astype(np.uint64)
    with np.errstate(over="ignore"):
        one, two = length * _A, length * _B
        rows, at = np.arange(len(starts)), starts
        while len(rows):
            left = ends[rows] - at
            keep = np.where(left >= 8, np.uint64(2**64 - 1), (np.uint64(1) << (8 * np.minimum(left, 7)).astype(np.uint64)) - np.uint64(1))
            block = eight[at] & keep
            if len(rows) == len(starts):
                one, two = mixed((one ^ block) * _B), mixed((two + block) * _A)
            else:
                one[rows], two[rows] = mixed((one[rows] ^ block) * _B), mixed((two[rows] + block) * _A)
            more = left > 8
            rows, at = rows[more], at[more] + 8
    return one, two


def leading(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first eight bytes of each range as a number that sorts as they do."""
    eight = np.ndarray(len(data) + 1, ">u8", np.concatenate([data, np.zeros(8, np.uint8)]), 0, (1,))[starts]
    short = (8 * (8 - np.minimum(ends - starts, 8))).astype(np.uint64)
    return np.where(short > 63, np.uint64(0), eight.astype(np.uint64) >> short << short)


def coded_ranges(data: np.ndarray, text_ends: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> Words:
    """Equal byte ranges get equal codes; where different ones share the first hash, the second tells them apart."""
    one, two = hashed(data, starts, ends)
    codes, hashes = pd.factorize(one)
    first = np.empty(len(hashes), np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    if not (two[first][codes] == two).all():
        other = pd.factorize(two)[0].astype(np.int64)
        codes, pairs = pd.factorize(codes.astype(np.int64) * (other.max() + 1) + other)
        first = np.empty(len(pairs), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        hashes = one[first]
    return Words(data, text_ends, starts, ends, bounds, codes, hashes, first)


def byte_words(texts: pa.Array) -> Words:
    data, text_ends = text_bytes(texts)
    return coded_ranges(data, text_ends, *word_bounds(data, text_ends))


def lowered(texts: pa.Array) -> pa.Array:
    """A to Z in lower case, every other byte as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    data, text_ends = text_bytes(texts)
    offsets = np.concatenate([[0], text_ends]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(table[data]))
