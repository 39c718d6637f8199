"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickledger.llm.bytewords import byte_words, lowered, text_bytes
from clickledger.llm.common import mixed, slices

#: Hash buckets of words and of metadata values, intervals per statistic, interaction rank.
BUCKETS, META_BUCKETS, BINS, RANK = 1 << 13, 256, 12, 8
#: Most labelled rows that the model is fitted on, taken by a hash of the id. Their features (at most
#: BUCKETS a row) are all that the driver ever holds.
TRAINING_ROWS = 8000
#: Texts are worked on in slices of so many bytes, whose words and features a worker holds at once.
TEXT_BYTES = 1 << 20

_SIGNS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#*$%&|<>", "bang": b"!", "stop": b".,;:?", "high": bytes(range(128, 256))}
STATISTICS = 13


@dataclass
class Rows:
    """Sparse rows: row i has ``index[bounds[i]:bounds[i + 1]]`` with ``value``; and dense statistics."""

    index: np.ndarray
    value: np.ndarray
    bounds: np.ndarray
    statistics: np.ndarray


def features(texts: pa.Array, metadata: Sequence[pa.Array] = ()) -> Rows:
    """Features of whole texts; a null text counts as empty, null metadata as its own value."""
    words = byte_words(lowered(texts))
    data, ends = text_bytes(texts)
    docs = len(ends)
    n = words.sizes()
    owner = np.repeat(np.arange(docs), n)
    bucket = (mixed(words.hashes) % np.uint64(BUCKETS)).astype(np.int64)
    key, count = np.unique(owner * BUCKETS + bucket[words.codes], return_counts=True)
    of, index, value = key // BUCKETS, key % BUCKETS, np.log1p(count)
    norm = np.sqrt(np.bincount(of, value**2, docs))
    value = value / np.maximum(norm[of], 1e-9)
    distinct = np.bincount(of, minlength=docs)
    commonest = np.zeros(docs)
    np.maximum.at(commonest, of, count)
    for k, column in enumerate(metadata):
        hashed = [zlib.crc32(repr((k, v)).encode()) % META_BUCKETS for v in column.to_pylist()]
        of = np.concatenate([of, np.arange(docs)])
        index = np.concatenate([index, BUCKETS + np.array(hashed, np.int64)])
        value = np.concatenate([value, np.ones(docs)])
    order = np.argsort(of, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=docs))])

    size = np.diff(ends, prepend=0)
    per_byte, per_word = np.maximum(size, 1), np.maximum(n, 1)
    signs = {}
    for name, chars in _SIGNS.items():
        table = np.zeros(256, bool)
        table[list(chars)] = True
        signs[name] = np.diff(np.searchsorted(np.flatnonzero(table[data]), ends), prepend=0)
    same = np.zeros(len(owner), bool)
    same[1:] = (words.codes[1:] == words.codes[:-1]) & (owner[1:] == owner[:-1])
    lines, repeated = _lines(words, owner, docs)
    statistics = np.stack(
        [
            np.log1p(n),
            np.bincount(owner, words.ends - words.starts, docs) / per_word,
            signs["upper"] / per_byte,
            signs["digit"] / per_byte,
            signs["symbol"] / per_word,
            signs["bang"] / per_word,
            signs["stop"] / per_word,
            signs["high"] / per_byte,
            distinct / per_word,
            np.bincount(owner, same, docs) / per_word,
            commonest / per_word,
            repeated / np.maximum(lines, 1),
            np.log1p(n / np.maximum(lines, 1)),
        ],
        axis=1,
    )
    return Rows(index[order], value[order].astype(np.float32), bounds, statistics)


def _lines(words, owner: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them equal in words to an earlier line of the text."""
    if not len(owner):
        return np.zeros(docs), np.zeros(docs)
    breaks = np.flatnonzero(words.data == 10)
    line = np.searchsorted(breaks, words.starts)
    first = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (owner[1:] != owner[:-1])]))
    place = np.arange(len(owner)) - np.repeat(first, np.diff(first, append=len(owner)))
    with np.errstate(over="ignore"):
        signature = np.add.reduceat(mixed(words.hashes[words.codes] + place.astype(np.uint64)), first)
        pair = np.unique(mixed(signature) ^ mixed(owner[first].astype(np.uint64) + np.uint64(1)), return_index=True)[1]
    lines = np.bincount(owner[first], minlength=docs)
    return lines, lines - np.bincount(owner[first][pair], minlength=docs)


@dataclass
class Model:
    edges: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def rows(self, found: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Indices, values and bounds with one more entry per statistic, its interval."""
        docs = len(found.bounds) - 1
        place = np.stack([np.searchsorted(e, s, side="left") for e, s in zip(self.edges, found.statistics.T)], axis=1)
        place = BUCKETS + META_BUCKETS + np.arange(STATISTICS) * BINS + place
        of = np.concatenate([np.repeat(np.arange(docs), np.diff(found.bounds)), np.repeat(np.arange(docs), STATISTICS)])
        order = np.argsort(of, kind="stable")
        index = np.concatenate([found.index, place.reshape(-1)])[order]
        value = np.concatenate([found.value, np.ones(place.size, np.float32)])[order]
        return index, value, found.bounds + STATISTICS * np.arange(docs + 1)

    def terms(self, index: np.ndarray, value: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Margins, and the factor sums they are made of: pairs cost no more than single features.

        The sum over pairs of <v_i, v_j> x_i x_j is half of (sum of v_i x_i)^2 - sum of (v_i x_i)^2.
        """
        scaled = self.factor[index] * value[:, None]
        total = np.add.reduceat(scaled, bounds[:-1], axis=0)
        squares = np.add.reduceat((scaled**2).sum(axis=1), bounds[:-1])
        linear = np.add.reduceat(self.weight[index] * value, bounds[:-1])
        return self.bias + linear + 0.5 * ((total**2).sum(axis=1) - squares), total

    def scores(self, found: Rows) -> np.ndarray:
        if len(found.bounds) == 1:
            return np.empty(0)
        margin, _ = self.terms(*self.rows(found))
        return 1 / (1 + np.exp(-np.clip(margin.astype(np.float64), -30, 30)))


def fit(found: Rows, target: np.ndarray, epochs: int = 12, batch: int = 256, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """Logistic loss by AdaGrad over shuffled batches, from a fixed seed. Targets lie in 0 to 1."""
    rng = np.random.default_rng(7)
    cuts = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.stack([np.quantile(s, cuts) for s in found.statistics.T])
    width = BUCKETS + META_BUCKETS + STATISTICS * BINS
    rate_of_ones = float(np.clip(target.mean(), 0.01, 0.99))
    model = Model(
        edges,
        float(np.log(rate_of_ones / (1 - rate_of_ones))),
        np.zeros(width, np.float32),
        rng.normal(0, 0.02, (width, RANK)).astype(np.float32),
    )
    index, value, bounds = model.rows(found)
    seen_w, seen_v = np.full(width, 1e-6), np.full((width, RANK), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(target))
        for chosen in (order[i : i + batch] for i in range(0, len(order), batch)):
            spans = [np.arange(bounds[i], bounds[i + 1]) for i in chosen]
            at = np.concatenate(spans)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in spans])])
            i, x = index[at], value[at]
            margin, total = model.terms(i, x, ends)
            slope = 1 / (1 + np.exp(-margin)) - target[chosen]
            row = np.repeat(np.arange(len(chosen)), np.diff(ends))
            pull = (slope[row] * x / len(chosen)).astype(np.float64)
            grad = np.bincount(i, pull, width) + decay * model.weight
            seen_w += grad**2
            model.weight -= (rate * grad / np.sqrt(seen_w)).astype(np.float32)
            inner = pull[:, None] * (total[row] - model.factor[i] * x[:, None])
            slopes = np.stack([np.bincount(i, inner[:, r], width) for r in range(RANK)], axis=1) + decay * model.factor
            seen_v += slopes**2
            model.factor -= (rate * slopes / np.sqrt(seen_v)).astype(np.float32)
            model.bias -= rate * float(slope.mean())
    return model


def size_class(column: str) -> Column:
    """How many binary digits a length has, as metadata; null for null."""
    return F.length(F.bin(F.col(column).cast("long")))


def _texts_of(metadata: Sequence[str | Column]) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).cast("string") for c in metadata]


def _narrow(docs: DataFrame, metadata: Sequence[str | Column]) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *[c.alias(f"meta_{i}") for i, c in enumerate(_texts_of(metadata))],
    )


def _found(part: pa.RecordBatch, beside: int) -> Rows:
    return features(part.column("text"), [part.column(f"meta_{i}") for i in range(beside)])


def train(docs: DataFrame, labels: DataFrame, metadata: Sequence[str | Column] = (), rows: int = TRAINING_ROWS) -> Model | None:
    """Fit on up to ``rows`` documents of ``labels(doc_id, target)``, those with the least id hash.

    Null ids, null targets and labels without a document are left out; several labels of one document
    are averaged. Of several documents with one id the least text counts, found on the executors, so the
    driver holds ``rows`` rows at most however often an id is repeated. ``metadata`` are columns or
    expressions over them. Without any label there is no model.
    """
    targets = labels.filter("doc_id IS NOT NULL AND target IS NOT NULL").groupBy("doc_id").agg(F.avg("target").alias("target"))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    chosen = targets.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    beside = len(metadata)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", TEXT_BYTES):
            found = _found(part, beside)
            bounds = pa.array(found.bounds, pa.int32())
            wide = pa.array(np.arange(0, found.statistics.size + 1, STATISTICS), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("target"),
                    pa.ListArray.from_arrays(bounds, pa.array(found.index.astype(np.int32))),
                    pa.ListArray.from_arrays(bounds, pa.array(found.value)),
                    pa.ListArray.from_arrays(wide, pa.array(found.statistics.reshape(-1))),
                ],
                ["doc_id", "target", "index", "value", "statistics"],
            )

    ddl = "doc_id long, target double, index array<int>, value array<float>, statistics array<double>"
    copies = _narrow(docs, metadata).join(F.broadcast(chosen), "doc_id")
    used = ["text", *[f"meta_{i}" for i in range(beside)]]
    one = copies.groupBy("doc_id", "target").agg(F.min(F.struct(*used)).alias("copy"))
    table = one.select("doc_id", "target", "copy.*").mapInArrow(run, ddl).toArrow().combine_chunks()
    if not table.num_rows:
        return None
    table = table.take(pa.compute.sort_indices(table, [("doc_id", "ascending")])).combine_chunks()
    sizes = np.array([len(x) for x in table["index"]], np.int64)
    flat = [pa.compute.list_flatten(table[c]).to_numpy() for c in ("index", "value", "statistics")]
    found = Rows(
        flat[0].astype(np.int64), flat[1], np.concatenate([[0], np.cumsum(sizes)]), flat[2].reshape(-1, STATISTICS)
    )
    return fit(found, table["target"].to_numpy())


def score(docs: DataFrame, model: Model | None, metadata: Sequence[str | Column] = ()) -> DataFrame:
    """``doc_id, score`` of every whole text, 0 to 1, higher for better texts.

    Null and empty texts are scored by their statistics like others; null and repeated doc_ids are rows
    like others. Without a model every score is 0.5. Columns other than doc_id, text and ``metadata``
    are ignored. An empty table gives no rows. The model (under 1 MB) goes with the tasks.
    """
    if model is None:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0.5).alias("score"))
    beside = len(metadata)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", TEXT_BYTES):
            scores = pa.array(model.scores(_found(part, beside)), pa.float64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), scores], ["doc_id", "score"])

    return _narrow(docs, metadata).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model | None, least: float, metadata: Sequence[str | Column] = ()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score ``least`` or more; in one pass, no shuffle.

    ``metadata`` is what the model was fitted with. Without a model every row stays.
    """
    if model is None:
        return docs
    width, mark = len(docs.columns), "_" * (1 + max(map(len, docs.columns)))  # no column's name

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", TEXT_BYTES):
            beside = [part.column(i) for i in range(width, part.num_columns)]
            good = pa.array(model.scores(features(part.column("text"), beside)) >= least)
            yield part.select(range(width)).filter(good)

    beside = [c.alias(f"{mark}{i}") for i, c in enumerate(_texts_of(metadata))]
    return docs.select("*", *beside).mapInArrow(run, docs.schema)
