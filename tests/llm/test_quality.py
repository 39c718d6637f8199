from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickledger.llm import quality
from clickledger.llm.quality import BINS, BUCKETS, META_BUCKETS, STATISTICS, Model, features, score, train
from clickledger.llm.queries import op1_factorisation_machine
from small import SMALL, make_docs  # noqa: F401

MEDIUM = "/root/testdata/sf0.01"


def test_linear_time_form_equals_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    width = BUCKETS + META_BUCKETS + STATISTICS * BINS
    model = Model(np.sort(rng.random((STATISTICS, BINS - 1))), 0.3, rng.normal(size=width), rng.normal(0, 0.1, (width, 4)))
    found = features(pa.array(["one two two", None, "a\na\nb c", "é!"]), [pa.array(["x", None, "x", "y"])])
    index, value, bounds = model.rows(found)
    margin, _ = model.terms(index, value, bounds)
    for d in range(4):
        items = list(zip(index[bounds[d] : bounds[d + 1]], value[bounds[d] : bounds[d + 1]]))
        want = 0.3 + sum(model.weight[i] * x for i, x in items)
        want += sum(model.factor[i] @ model.factor[j] * x * y for (i, x), (j, y) in itertools.combinations(items, 2))
        assert margin[d] == pytest.approx(want, rel=1e-4)


def test_statistics_count_what_they_say():
    found = features(pa.array(["Ab ab ab\nx 1!\nAB AB AB\n\n#", "", None]))
    words, _, upper, digit, symbol, bang, stop, high, distinct, same, most, lines, _ = found.statistics[0]
    assert words == pytest.approx(np.log(10)) and distinct == pytest.approx(4 / 9) and same == pytest.approx(4 / 9)
    assert most == pytest.approx(6 / 9) and lines == pytest.approx(1 / 4) and symbol == bang == pytest.approx(1 / 9)
    assert upper == pytest.approx(7 / 25) and digit == pytest.approx(1 / 25) and stop == high == 0
    assert np.isfinite(found.statistics).all() and (found.statistics[1] == found.statistics[2]).all()


def test_held_out_documents_are_told_apart(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = op1_factorisation_machine(spark, MEDIUM).collect()
    held = [(r, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == q for r, q in held]) > 0.97


def test_edge_cases(make_docs, spark):
    docs = make_docs([(1, "good words here"), (1, "good words here"), (2, None), (3, ""), (None, "#### !!! ####")])
    docs = docs.selectExpr("*", "1 AS score", "1 AS target", "CAST(NULL AS STRING) AS site")
    labels = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, 0.0), (9, 1.0), (None, 0.0), (3, None)], "doc_id LONG, target DOUBLE")
    model = train(docs, labels, ["site"])
    rows = score(docs, model, ["site"]).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert score(make_docs([]), model, []).collect() == []
    assert train(docs, labels.limit(0)) is None
    assert {r.score for r in score(docs, None).collect()} == {0.5}


def test_an_id_on_most_rows_gives_one_training_row(spark, make_docs, monkeypatch):
    docs = make_docs([(7, f"word{i % 3} again") for i in range(3000)] + [(i, f"text {i}") for i in range(20, 40)])
    labels = spark.createDataFrame([(i, float(i % 2)) for i in [7, *range(20, 40)]], "doc_id LONG, target DOUBLE")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda found, target: seen.append((found, target)))
    train(docs, labels)
    train(docs.orderBy("text", ascending=False).repartition(3), labels)
    (first, target), (second, _) = seen
    assert len(target) == len(first.bounds) - 1 == 21
    assert (first.index == second.index).all() and (first.statistics == second.statistics).all()


def test_lengths_are_metadata_and_all_columns_stay(spark, make_docs):
    docs = make_docs([(i, "same text") for i in range(40)]).selectExpr("*", "IF(doc_id < 20, 3, 900) AS n_chars", "'x' AS _0", "doc_id AS DOC")
    docs = docs.unionByName(docs.limit(1).withColumn("n_chars", F.lit(None).cast("int")))
    labels = spark.createDataFrame([(i, float(i >= 20)) for i in range(40)], "doc_id LONG, target DOUBLE")
    metadata = [quality.size_class("n_chars")]
    model = train(docs, labels, metadata)
    scores = {(r.doc_id, r.score > 0.5) for r in score(docs.where("n_chars IS NOT NULL"), model, metadata).collect()}
    assert scores == {(i, i >= 20) for i in range(40)}
    kept = quality.keep_good(docs, model, 0.5, metadata)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} >= set(range(20, 40))
    assert [r[0] for r in spark.range(3).selectExpr("CASE id WHEN 0 THEN 0 WHEN 1 THEN 4096 END AS n").select(quality.size_class("n")).collect()] == [1, 13, None]
