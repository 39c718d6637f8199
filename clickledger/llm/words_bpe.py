"""Token ids of texts under a word-end BPE tokenizer file, each distinct word encoded once per worker."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from clickledger.llm.bytewords import Words, coded_ranges, cut_marks, lowered, text_bytes, word_bounds

#: Characters whose case, class and normal form every library agrees on.
_PLAIN = re.compile("[!-~¡-įı-ɏ]+")
#: Words a worker remembers at most, in two generations: words of the older that are met again move to the
#: newer, and when that holds half, it becomes the older and the rest is forgotten.
CACHE = 200_000
_JOINED = 256


class WordEncoder:
    """Encodes by chunks between ASCII white space, which the tokenizer drops.

    Chunks new to the worker that are of plain characters are cut into words as the file's own pattern
    does; the words go through the tokenizer, many at a time, and are told apart by the word-end mark of
    their last token. Any other chunk goes through the tokenizer as it is.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        suffix = spec["model"]["end_of_word_suffix"]
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.end = np.array([end_id], "<u4").tobytes()
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in encoded]

    def _encode_words(self, words: list[str], found: dict[str, bytes]) -> None:
        groups = [words[i : i + _JOINED] for i in range(0, len(words), _JOINED)]
        for group, ids in zip(groups, self._ids([" ".join(g) for g in groups])):
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(group) and len(ids) == ends[-1]:
                blob, at = ids.tobytes(), (4 * ends).tolist()
                found.update(zip(group, map(blob.__getitem__, map(slice, [0, *at], at))))
            else:
                found.update((w, i.tobytes()) for w, i in zip(group, self._ids(group)))

    def _learn(self, chunks: list[bytes]) -> None:
        whole: dict[str, bytes] = {}  # chunks that are one word of a to z
        parsed: dict[bytes, list[str]] = {}
        for chunk, text in zip(chunks, b"\n".join(chunks).decode().split("\n")):
            if text.isascii() and text.isalpha():
                whole[text] = chunk
            elif text.isalpha() or not _PLAIN.fullmatch(text):
                parsed[chunk] = [text]
            else:
                parsed[chunk] = self.pattern.findall(text.lower())
        found: dict[str, bytes] = {}
        words = {w for part in parsed.values() for w in part}.difference(whole)
        plain = sorted(filter(_PLAIN.fullmatch, words))
        other = sorted(words.difference(plain))
        self._encode_words([*whole, *plain], found)
        found.update((w, i.tobytes()) for w, i in zip(other, self._ids(other)))
        self.known.update(zip(whole.values(), map(found.__getitem__, whole)))
        self.known.update((c, b"".join([found[w] for w in part])) for c, part in parsed.items())

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Little-endian 32-bit ids of each text, closed by the end id; a null text is empty."""
        words = _cores_and_marks(lowered(texts))
        chunks = words.distinct()
        if len(self.known) > CACHE // 2:
            self.known, self.older = {}, self.known
        new = [c for c in chunks if c not in self.known]
        again = {c: ids for c in new if (ids := self.older.get(c)) is not None}
        self.known |= again
        self._learn([c for c in new if c not in again])
        parts = [*map(self.known.__getitem__, chunks), self.end]
        codes = np.insert(words.codes, words.bounds[1:], len(parts) - 1)
        bounds = words.bounds + np.arange(len(words.bounds))
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), "<u4")
        first = np.cumsum(size) - size
        length = size[codes]
        ends = np.cumsum(length)
        ids = flat[np.arange(length.sum()) + np.repeat(first[codes] - (ends - length), length)]
        at = np.concatenate([[0], ends])[bounds]
        return [ids[a:b] for a, b in zip(at[:-1], at[1:])]


def _cores_and_marks(texts: pa.Array) -> Words:
    """Words between white space, each cut into its core and the marks that close it."""
    data, text_ends = text_bytes(texts)
    starts, ends, _ = word_bounds(data, text_ends)
    begins, stops = cut_marks(data, starts, ends)
    bounds = np.concatenate([[0], np.searchsorted(begins, text_ends, side="left")])
    return coded_ranges(data, text_ends, begins, stops, bounds)


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> WordEncoder:
    return WordEncoder(path, end_id)
