"""Language identification: a linear-chain conditional random field labels the words of each text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.llm.bytewords import byte_words, lowered
from clickledger.llm.common import mixed, slices

#: Hash buckets of word features.
BUCKETS = 1 << 15
#: Documents of each language that the model is fitted on, about, by a hash of the id; and how many
#: runs of how many words of each are used. Nothing else bounds the work.
TRAINING_DOCS, RUNS, RUN_WORDS = 500, 6, 24
#: Languages that are learned at most, those of most rows, and documents of all languages together, about.
LANGUAGES, ALL_TRAINING_DOCS = 64, 16_000
#: Commonest training words of a language that make its lexicon.
LEXICON = 300
#: Texts are worked on in slices of so many bytes, whose messages a worker holds at once. Each slice scores
#: its distinct words anew, so smaller ones cost time.
TEXT_BYTES = 2 << 20
UNDETERMINED = "und"

_AFFIX, _GRAM, _WORD = 1, 2, 3


@dataclass
class WordFeatures:
    """Sparse rows of word features."""

    index: np.ndarray
    value: np.ndarray
    bounds: np.ndarray


def letters(word: bytes) -> str:
    """The word's letters in lower case."""
    text = word.decode().lower()
    return text if text.isalpha() else "".join(filter(str.isalpha, text))


def _hash(kind: int, *codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = np.full(codes[0].shape, kind, np.uint64)
        for c in codes:
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64))
    return (h % np.uint64(BUCKETS)).astype(np.int64)


def _same_width(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, indices and values for words of at most ``width`` letters."""
    chars = np.zeros((len(words), width + 4), np.uint32)
    text = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)
    size = np.array([len(w) for w in words])
    chars[:, 1 : width + 1] = text
    chars[:, 0], chars[np.arange(len(words)), size + 1] = 2, 3  # marks of both ends
    here = np.arange(len(words))
    rows, index, value = [], [], []

    def add(at: np.ndarray, hashed: np.ndarray, weight: np.ndarray | float) -> None:
        rows.append(at)
        index.append(hashed)
        value.append(np.broadcast_to(weight, hashed.shape))

    for n in (1, 2, 3):
        add(here, _hash(_AFFIX, *(chars[:, k] for k in range(n + 1))), 1.0)
        long = here[size >= n]
        tail = [chars[long, size[long] + 1 - k] for k in range(n + 1)]
        add(long, _hash(_AFFIX + 8, *tail), 1.0)
        grams = width + 3 - n
        at, place = np.nonzero(np.arange(grams)[None, :] < (size + 3 - n)[:, None])
        add(at, _hash(_GRAM, *(chars[at, place + k] for k in range(n)), np.full(len(at), n)), 3.0 / (size + 2)[at])
    folded = np.zeros(len(words), np.uint64)
    for k in range(width):
        folded = np.where(k < size, mixed(folded * np.uint64(31) + text[:, k]), folded)
    add(here, _hash(_WORD, folded), 1.0)
    return np.concatenate(rows), np.concatenate(index), np.concatenate(value)


def word_features(words: list[str], lexicon: dict[str, list[int]]) -> WordFeatures:
    """Affixes, character n-grams, the word itself and the lexicons it is in; words are not empty."""
    size = np.array([len(w) for w in words], np.int64)
    rows, index, value = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    low = 0
    while low < size.max(initial=0):
        high = max(8, 2 * low)
        chosen = np.flatnonzero((size > low) & (size <= high))
        if len(chosen):
            r, i, v = _same_width([words[k] for k in chosen], int(size[chosen].max()))
            rows.append(chosen[r])
            index.append(i)
            value.append(v)
        low = high
    known = [(k, BUCKETS + lang) for k, w in enumerate(words) for lang in lexicon.get(w, ())]
    if known:
        found = np.array(known, np.int64)
        rows.append(found[:, 0])
        index.append(found[:, 1])
        value.append(np.ones(len(found)))
    at = np.concatenate(rows)
    order = np.argsort(at, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(words)))])
    return WordFeatures(np.concatenate(index)[order], np.concatenate(value)[order].astype(np.float32), bounds)


@dataclass
class Model:
    languages: list[str]
    lexicon: dict[str, list[int]]
    weight: np.ndarray
    step: np.ndarray
    first: np.ndarray

    def potentials(self, words: list[str], most: int = 10_000) -> np.ndarray:
        """exp of each word's score by language, its largest scaled to one."""
        parts = [np.empty((0, len(self.languages)))]
        for k in range(0, len(words), most):
            f = word_features(words[k : k + most], self.lexicon)
            parts.append(self.from_features(f))
        return np.concatenate(parts)

    def from_features(self, f: WordFeatures) -> np.ndarray:
        score = np.add.reduceat(self.weight[f.index] * f.value[:, None], f.bounds[:-1], axis=0)
        return np.exp(np.maximum(score - score.max(axis=1, keepdims=True), -40.0)).astype(np.float64)


def passes(potential: np.ndarray, sizes: np.ndarray, step: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages over many chains at once.

    Chain i has ``sizes[i]`` rows of ``potential``, one chain after another. Step t is taken for all
    chains that are that long together; each row is scaled to sum to one, so long chains keep their
    precision.
    """
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    starts, length = starts[order], sizes[order]
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(longest), side="left")
    forward, backward = np.empty_like(potential), np.ones_like(potential)
    state = None
    for t in range(longest):
        at = starts[: active[t]] + t
        state = (first if t == 0 else state[: active[t]] @ step) * potential[at]
        state = state / state.sum(axis=1, keepdims=True)
        forward[at] = state
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        message = (potential[at + 1] * backward[at + 1]) @ step.T
        backward[at] = message / message.sum(axis=1, keepdims=True)
    return forward, backward


def posteriors(forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """Each word's label probabilities."""
    both = forward * backward
    both /= both.sum(axis=1, keepdims=True)
    return both


def fit(runs: list[tuple[str, list[str]]], epochs: int = 4, batch: int = 128, rate: float = 0.3, decay: float = 1e-4) -> Model | None:
    """Maximum likelihood of the labels of code-switched sequences, by AdaGrad from a fixed seed.

    ``runs`` are (language, words). Sequences join two or three random runs, so that transitions see
    both words that stay in a language and words that leave it.
    """
    runs = sorted(r for r in runs if r[1])
    languages = sorted({lang for lang, _ in runs})
    if not languages:
        return None
    code, k = {lang: i for i, lang in enumerate(languages)}, len(languages)
    lexicon: dict[str, list[int]] = {}
    for lang in languages:
        counts = Counter(w for x, words in runs if x == lang for w in words)
        for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            lexicon.setdefault(w, []).append(code[lang])
    model = Model(languages, lexicon, np.zeros((BUCKETS + k, k), np.float32), np.zeros((k, k)), np.zeros(k))
    seen = [np.full(x.shape, 1e-6) for x in (model.weight, model.step, model.first)]
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        order, chains = rng.permutation(len(runs)), []
        while len(order):
            n = int(rng.integers(2, 4))
            chains.append(order[:n])
            order = order[n:]
        for some in (chains[i : i + batch] for i in range(0, len(chains), batch)):
            _improve(model, seen, [[(code[runs[r][0]], runs[r][1]) for r in chain] for chain in some], rate, decay)
    model.step, model.first = np.exp(model.step - model.step.max()), np.exp(model.first - model.first.max())
    return model


def _improve(model: Model, seen: list[np.ndarray], chains: list[list[tuple[int, list[str]]]], rate: float, decay: float) -> None:
    index: dict[str, int] = {}
    words = np.array([index.setdefault(w, len(index)) for chain in chains for _, run in chain for w in run])
    label = np.array([lang for chain in chains for lang, run in chain for _ in run])
    sizes = np.array([sum(len(run) for _, run in chain) for chain in chains])
    starts = np.cumsum(sizes) - sizes
    f = word_features(list(index), model.lexicon)
    potential = model.from_features(f)[words]
    step, first, k = np.exp(model.step), np.exp(model.first), len(model.languages)
    forward, backward = passes(potential, sizes, step, first)
    error = np.eye(k)[label] - posteriors(forward, backward)
    linked = np.ones(len(words), bool)
    linked[starts] = False
    right = np.flatnonzero(linked)
    pair = forward[right - 1][:, :, None] * step[None] * (potential[right] * backward[right])[:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    observed = np.zeros((k, k))
    np.add.at(observed, (label[right - 1], label[right]), 1)
    by_word = np.stack([np.bincount(words, error[:, j], len(index)) for j in range(k)], axis=1)
    spread = np.repeat(np.arange(len(index)), np.diff(f.bounds))
    pull = by_word[spread] * f.value[:, None]
    n = len(chains)
    slopes = [
        np.stack([np.bincount(f.index, pull[:, j], len(model.weight)) for j in range(k)], axis=1) / n - decay * model.weight,
        (observed - pair.sum(axis=0)) / n - decay * model.step,
        error[starts].mean(axis=0) - decay * model.first,
    ]
    for past, slope, what in zip(seen, slopes, (model.weight, model.step, model.first)):
        past += slope**2
        what += (rate * slope / np.sqrt(past)).astype(what.dtype)


def train(docs: DataFrame, docs_per_language: int = TRAINING_DOCS) -> Model | None:
    """Fit on about ``docs_per_language`` documents of each language of ``docs(doc_id, text, lang)``.

    Rows with a null text, lang or doc_id are left out. Of several documents with one id one counts, found
    on the executors. The LANGUAGES values of lang with most rows are learned, ties by name; documents in
    others are taken for one of these. The driver holds at most RUNS * RUN_WORDS words of about
    ALL_TRAINING_DOCS documents, taken at even distances from the whole text. Without any there is no model.
    """
    labelled = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).dropna()
    counts = labelled.groupBy("lang").agg(F.count("*").alias("rows"), F.approx_count_distinct("doc_id").alias("n"))
    most = counts.orderBy(F.col("rows").desc(), "lang").limit(LANGUAGES).collect()
    share = min(docs_per_language, ALL_TRAINING_DOCS // max(len(most), 1))
    rates = docs.sparkSession.createDataFrame([(r.lang, share / r.n) for r in most], "lang string, rate double")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000_007)) / 1_000_000_007
    copies = labelled.join(F.broadcast(rates), "lang").filter(place < F.col("rate"))
    chosen = copies.groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("copy")).select("doc_id", "copy.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", TEXT_BYTES):
            words = byte_words(lowered(part.column("text")))
            plain = [letters(w) for w in words.distinct()]
            out = []
            for a, b, doc, lang in zip(words.bounds[:-1], words.bounds[1:], *(part.column(c).to_pylist() for c in ("doc_id", "lang"))):
                for s in sorted({int(x) for x in np.linspace(a, max(a, b - RUN_WORDS), RUNS)}):
                    out.append((doc, lang, [p for c in words.codes[s : min(s + RUN_WORDS, b)] if (p := plain[c])]))
            columns = list(zip(*out)) or [[]] * 3
            kinds = {"doc_id": pa.int64(), "lang": pa.string(), "words": pa.list_(pa.string())}
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds))

    table = chosen.mapInArrow(run, "doc_id long, lang string, words array<string>").toArrow()
    table = table.take(pa.compute.sort_indices(table, [("doc_id", "ascending")]))  # stable: a text's runs stay in order
    return fit(list(zip(table["lang"].to_pylist(), table["words"].to_pylist())))


_SPAN = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("length", pa.int64())])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` of every whole text.

    Words are those between ASCII white space that hold a letter, one chain per text. ``lang_pred`` is
    the language with the most expected words and ``score`` its share of them; ``spans`` are the runs of
    words of one language, for code-switched texts, as (lang, first word, words). Texts that are null or
    hold no letter, and all texts without a model, give ``und``, score 0 and no spans. Equal shares go to
    the language that sorts first. Null and repeated doc_ids are rows like others; columns other than
    doc_id and text are ignored; an empty table gives no rows. The model (under 1 MB for ten languages)
    goes with the tasks; memory follows a slice of texts, or one longer text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", TEXT_BYTES):
            yield _identified(part, model)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ddl = "doc_id long, lang_pred string, score double, spans array<struct<lang: string, start: long, length: long>>"
    return texts.mapInArrow(run, ddl)


def _identified(part: pa.RecordBatch, model: Model | None) -> pa.RecordBatch:
    words = byte_words(lowered(part.column("text")))
    docs = part.num_rows
    owner = np.repeat(np.arange(docs), words.sizes())
    plain = [letters(w) for w in words.distinct()]
    known = {w: i for i, w in enumerate(dict.fromkeys(filter(None, plain)))}
    code = np.array([known.get(w, -1) for w in plain], np.int64)[words.codes]
    if model is None:
        code[:] = -1
    owner, code = owner[code >= 0], code[code >= 0]
    languages = model.languages if model else [UNDETERMINED]
    sizes = np.bincount(owner, minlength=docs)
    best, score = np.zeros(docs, np.int64), np.zeros(docs)
    spans = np.zeros(docs + 1, np.int32)
    runs = pa.array([], _SPAN)
    if len(code):
        found = posteriors(*passes(model.potentials(list(known))[code], sizes, model.step, model.first))
        mass = np.stack([np.bincount(owner, found[:, j], docs) for j in range(len(languages))], axis=1)
        best, score = mass.argmax(axis=1), np.minimum(mass.max(axis=1) / np.maximum(sizes, 1), 1.0)
        label = found.argmax(axis=1)
        begins = np.flatnonzero(np.concatenate([[True], (label[1:] != label[:-1]) | (owner[1:] != owner[:-1])]))
        place = begins - (np.cumsum(sizes) - sizes)[owner[begins]]
        names = pa.array(languages).take(pa.array(label[begins]))
        runs = pa.StructArray.from_arrays([names, pa.array(place), pa.array(np.diff(begins, append=len(label)))], fields=list(_SPAN))
        spans[1:] = np.cumsum(np.bincount(owner[begins], minlength=docs))
    lang = [languages[b] if n else UNDETERMINED for b, n in zip(best, sizes)]
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), pa.ListArray.from_arrays(pa.array(spans), runs)],
        ["doc_id", "lang_pred", "score", "spans"],
    )


def keep_identified(docs: DataFrame, model: Model | None, least: float) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is told with a share of ``least``.

    Texts that are null or hold no letter go; without a model every row stays.
    """
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", TEXT_BYTES):
            found = _identified(pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text")], ["doc_id", "text"]), model)
            told = pa.compute.not_equal(found.column("lang_pred"), UNDETERMINED)
            yield part.filter(pa.compute.and_(told, pa.compute.greater_equal(found.column("score"), least)))

    return docs.mapInArrow(run, docs.schema)
