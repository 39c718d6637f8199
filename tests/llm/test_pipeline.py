from __future__ import annotations

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brute import near_components
from clickledger.llm import langid, neardup, quality
from clickledger.llm.words_bpe import WordEncoder
from small import make_docs  # noqa: F401

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage gives, in order, the documents first."""
    out = [spark.read.parquet(f"{MEDIUM}/documents.parquet").cache()]
    for _, step in corpus_pipeline.STAGES:
        out.append(step(spark, out[-1], MEDIUM).cache())
    return out


def test_filters_keep_columns_and_clean_documents(spark, steps):
    docs, good, told, single, _ = steps
    assert docs.schema == good.schema == told.schema == single.schema
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.select("doc_id").collect()}
    clean, junk = [{d for d, q in labels.items() if q == k} for k in (1, 0)]
    assert len(clean & kept) >= 0.98 * len(clean) and len(junk & kept) <= 0.05 * len(junk)
    assert told.count() >= 0.99 * good.count()


def test_one_document_of_each_group_stays(steps):
    _, _, told, single, _ = steps
    texts = {r.doc_id: r.text for r in told.collect()}
    want = {d for d, (_, group) in near_components(texts, 5, 80).items() if d == group}
    assert {r.doc_id for r in single.collect()} == want and len(want) < len(texts)


def test_all_ids_of_the_last_documents_are_packed(steps):
    *_, single, packed = steps
    encode = WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 2)
    rows = single.collect()
    texts = single.select("text").toArrow()["text"].combine_chunks()
    want = {r.doc_id: ids.tolist() for r, ids in zip(rows, encode.encode(texts))}
    got: dict = {}
    for p in packed.orderBy("doc_id", "start").collect():
        got.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
    assert got == want
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 4096


def test_stages_stand_empty_and_null_documents(spark, steps):
    docs = spark.createDataFrame([(1, None, None, None, None), (None, "a word", "en", None, 1)], steps[0].schema)
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, docs.limit(0), MEDIUM).collect() == []
        assert step(spark, docs, MEDIUM).count() <= 2, name


def _model_of_quality() -> quality.Model:
    width = quality.BUCKETS + quality.META_BUCKETS + quality.STATISTICS * quality.BINS
    edges = np.tile(np.arange(quality.BINS - 1.0), (quality.STATISTICS, 1))
    return quality.Model(edges, 0.0, np.zeros(width, "f4"), np.zeros((width, quality.RANK), "f4"))


def _model_of_language() -> langid.Model:
    return langid.Model(list("abcdefgh"), {}, np.zeros((langid.BUCKETS + 8, 8), "f4"), np.ones((8, 8)), np.ones(8))


@pytest.mark.parametrize(
    "step, most",
    [
        (lambda docs: quality.keep_good(docs, _model_of_quality(), 0.0), 45),
        (lambda docs: quality.score(docs, _model_of_quality()), 45),
        (lambda docs: langid.keep_identified(docs, _model_of_language(), 0.0), 150),
        (lambda docs: neardup.sketches(docs, 5), 75),
    ],
)
def test_workers_hold_little_beside_a_batch(make_docs, monkeypatch, step, most):
    """Two workers share an executor with its heap, and a batch may hold many megabytes of text."""
    rng = np.random.default_rng(3)
    words = np.array([f"{a}{b}" for a in "bcdfgh" for b in ("ab", "ecod", "ifogu", "o")] + ["Ab,", "1", "é"])
    texts = [" ".join(rng.choice(words, 500)) for _ in range(3000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    assert batch.nbytes > 5 << 20
    docs, seen = make_docs([(1, "a")]), []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: seen.append(run) or self)
    step(docs)
    (run,) = seen
    tracemalloc.start()
    try:
        rows = sum(part.num_rows for part in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1] / (1 << 20)
    finally:
        tracemalloc.stop()
    assert rows == len(texts) and peak < most
