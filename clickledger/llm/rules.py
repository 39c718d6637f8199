"""Quality rules as a short-circuit cascade: cheap, selective rules first, each on what the last ones left."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.llm.bytewords import Words, byte_words, coded_ranges, text_bytes, word_bounds
from clickledger.llm.common import slices

#: Documents, those with the least id hash, on which cost and selectivity are measured.
SAMPLE = 400

SYMBOLS, CAPITALS, DIGITS = b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"


@dataclass(frozen=True)
class Rule:
    """``rejects`` gives a boolean per text of an array without nulls."""

    name: str
    rejects: Callable[[pa.Array], np.ndarray]


def count(texts: pa.Array, chars: bytes) -> np.ndarray:
    """How often the given ASCII characters occur in each text."""
    data, ends = text_bytes(texts)
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return _sums(table[data], ends)


def _sums(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(total[ends], prepend=0)


def word_count(texts: pa.Array) -> np.ndarray:
    return np.diff(word_bounds(*text_bytes(texts))[2])


def word_chars(texts: pa.Array) -> np.ndarray:
    """Code points that are not ASCII white space."""
    data, ends = text_bytes(texts)
    return _sums(((data & 0xC0) != 0x80) & (data != 0x20) & ~((data >= 0x09) & (data <= 0x0D)), ends)


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word in each text, and those of them equal to an earlier line."""
    data, ends = text_bytes(texts)
    breaks = np.flatnonzero(data == 10)
    stops = np.sort(np.concatenate([breaks, ends]))
    of = np.concatenate([np.searchsorted(ends, breaks, side="right"), np.arange(len(ends))])
    of = of[np.argsort(np.concatenate([breaks, ends]), kind="stable")]
    fresh = np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.empty(0, bool)
    starts = np.concatenate([[0], stops[:-1] + 1])[: len(stops)]
    starts = np.where(fresh, (ends - np.diff(ends, prepend=0))[of], starts)
    word_starts = word_bounds(data, ends)[0]
    real = np.searchsorted(word_starts, stops) > np.searchsorted(word_starts, starts)
    starts, stops, of = starts[real], stops[real], of[real]
    lines = np.bincount(of, minlength=len(ends))
    if not len(of):
        return lines, lines
    codes = coded_ranges(data, ends, starts, stops, np.empty(0)).codes
    different = np.unique(of * (codes.max() + 1) + codes) // (codes.max() + 1)
    return lines, lines - np.bincount(different, minlength=len(ends))


def duplicate_lines(texts: pa.Array) -> np.ndarray:
    return _lines(texts)[1]


def repeated_words(texts: pa.Array, words: Words | None = None) -> np.ndarray:
    """Words in windows of three that occur twice or more in their text, the first occurrence included."""
    words = words or byte_words(texts)
    owner = np.repeat(np.arange(len(words.bounds) - 1), words.sizes())
    docs = len(words.bounds) - 1
    if len(owner) < 3:
        return np.zeros(docs, np.int64)
    c, n = words.codes.astype(np.uint64), np.uint64(len(words.first))
    pair = c[:-1] * n + c[1:]  # below 2**64 for up to four milliard distinct words
    pair = np.unique(pair, return_inverse=True)[1].astype(np.uint64)
    key = pair[:-1] * n + c[2:]
    at = np.flatnonzero(owner[2:] == owner[:-2])
    at = at[np.lexsort((key[at], owner[at]))]
    same = (key[at][1:] == key[at][:-1]) & (owner[at][1:] == owner[at][:-1])
    twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    inside = np.zeros(len(owner), bool)
    for k in range(3):
        inside[at[twice] + k] = True
    return np.bincount(owner, inside, docs).astype(np.int64)


def commonest_word(texts: pa.Array) -> np.ndarray:
    words = byte_words(texts)
    owner = np.repeat(np.arange(len(texts)), words.sizes())
    out = np.zeros(len(texts), np.int64)
    key, n = np.unique(owner * max(len(words.first), 1) + words.codes, return_counts=True)
    np.maximum.at(out, key // max(len(words.first), 1), n)
    return out


def _odd_length(texts: pa.Array) -> np.ndarray:
    chars, words = word_chars(texts), word_count(texts)
    return (chars < 3 * words) | (chars > 10 * words)


def _same_lines(texts: pa.Array) -> np.ndarray:
    lines, again = _lines(texts)
    return 2 * again > lines


#: Thresholds are shares of words, of characters in words, or of lines with a word.
RULES = (
    Rule("word_length", _odd_length),
    Rule("symbols", lambda t: 10 * count(t, SYMBOLS) > word_count(t)),
    Rule("exclamations", lambda t: 2 * count(t, b"!") > word_count(t)),
    Rule("capitals", lambda t: 10 * count(t, CAPITALS) > 3 * word_chars(t)),
    Rule("digits", lambda t: 5 * count(t, DIGITS) > word_chars(t)),
    Rule("duplicate_lines", _same_lines),
    Rule("commonest_word", lambda t: 10 * commonest_word(t) > 3 * word_count(t)),
    Rule("repeated_words", lambda t: 5 * repeated_words(t) > word_count(t) * 2),
)


def fails_base(words: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    return (words < 50) | (100 * repeated > 50 * words)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> list[tuple[str, float, float]]:
    """Each rule's name, seconds a text and share rejected, on those of ``sample`` documents that pass the base."""
    texts = _narrow(docs).filter("text IS NOT NULL AND doc_id IS NOT NULL")
    chosen = texts.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts, found = part.column("text"), []
            words = byte_words(texts)
            texts = texts.filter(pa.array(~fails_base(words.sizes(), repeated_words(texts, words))))
            for rule in rules if len(texts) else ():
                began = time.perf_counter()
                rejected = int(rule.rejects(texts).sum())
                found.append((rule.name, time.perf_counter() - began, rejected, len(texts)))
            if not found:
                continue
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["name", "seconds", "rejected", "n"])

    timed = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(run, "name string, seconds double, rejected long, n long")
    sums = timed.groupBy("name").agg(F.sum("seconds") / F.sum("n"), F.sum("rejected") / F.sum("n"))
    found = {r[0]: (r[1], r[2]) for r in sums.collect()}  # one row a rule
    return [(rule.name, *found.get(rule.name, (0.0, 0.0))) for rule in rules]


def ordered(rules: tuple[Rule, ...], measured: list[tuple[str, float, float]]) -> list[Rule]:
    """Rules by rejections per second, most first; equal ones as they were given."""
    gain = {name: rejected / max(seconds, 1e-12) for name, seconds, rejected in measured}
    return sorted(rules, key=lambda rule: -gain[rule.name])


def first_rejection(texts: pa.Array, rules: list[Rule]) -> np.ndarray:
    """The number of the first rule that rejects each text, or the number of rules."""
    out = np.full(len(texts), len(rules), np.int64)
    alive = np.arange(len(texts))
    for k, rule in enumerate(rules):
        if not len(alive):
            break
        left = texts if len(alive) == len(texts) else texts.take(pa.array(alive))
        rejected = rule.rejects(left)
        out[alive[rejected]] = k
        alive = alive[~rejected]
    return out


def cascade(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per document its base counts, ``base_failed``, ``rejected_by`` and ``kept``.

    Base counts (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) are taken of every whole
    text. A text fails the base with fewer than 50 words or with more than half of them in repeated
    windows; the others go through ``rules`` in order, each rule seeing only what all before it kept, and
    ``rejected_by`` names the first that rejects. The order changes work, never ``kept``. A null text has
    no words and fails the base. Null and repeated doc_ids are rows like others; columns other than
    doc_id and text are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = pa.compute.fill_null(part.column("text"), "")
            words = byte_words(texts)
            n, repeated = words.sizes(), repeated_words(texts, words)
            failed = fails_base(n, repeated)
            verdict = np.full(len(n), -1)
            left = np.flatnonzero(~failed)
            verdict[left] = first_rejection(texts.take(pa.array(left)), rules)
            names = [None if v in (-1, len(rules)) else rules[v].name for v in verdict.tolist()]
            columns = [n, word_chars(texts), count(texts, SYMBOLS), duplicate_lines(texts), repeated, failed]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *map(pa.array, columns), pa.array(names, pa.string()), pa.array(verdict == len(rules))],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by", "kept"],
            )

    counts = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    return _narrow(docs).mapInArrow(run, f"doc_id long, {counts}, base_failed boolean, rejected_by string, kept boolean")


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """Measure the rules on a sample, order them, and run the cascade over all documents."""
    return cascade(docs, ordered(rules, measure(docs, rules, sample)))
