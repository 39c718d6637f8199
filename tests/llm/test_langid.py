from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pytest

from clickledger.llm import langid
from clickledger.llm.langid import Model, fit, identify, passes, posteriors, train, word_features
from clickledger.llm.queries import op4_conditional_random_field
from small import make_docs  # noqa: F401

MEDIUM = "/root/testdata/sf0.01"


def test_forward_backward_equals_the_sum_over_all_labellings():
    rng = np.random.default_rng(1)
    sizes, k = np.array([3, 0, 1, 5]), 3
    potential, step, first = rng.random((9, k)), rng.random((k, k)), rng.random(k)
    got, at = posteriors(*passes(potential, sizes, step, first)), 0
    for n in sizes:
        want = np.zeros((n, k))
        for labels in itertools.product(range(k), repeat=n):
            p = 1.0
            for t, y in enumerate(labels):
                p *= potential[at + t, y] * (first[y] if t == 0 else step[labels[t - 1], y])
            for t, y in enumerate(labels):
                want[t, y] += p
        if n:
            assert got[at : at + n] == pytest.approx(want / want.sum(axis=1, keepdims=True))
        at += n


def test_word_features_do_not_depend_on_company():
    words = ["a", "für", "wordlonger", "x" * 70, "über"]
    together = word_features(words, {"a": [1]})
    for i, w in enumerate(words):
        alone = word_features([w], {"a": [1]})
        rows = slice(together.bounds[i], together.bounds[i + 1])
        assert sorted(zip(together.index[rows], together.value[rows])) == sorted(zip(alone.index, alone.value))


def test_code_switched_text_is_cut_where_the_language_changes(make_docs):
    left, right = [f"ba{c}e" for c in "bdfgk"], [f"zu{c}i" for c in "lmnpt"]
    runs = [("l", [left[(i + j) % 5] for j in range(12)]) for i in range(80)]
    runs += [("r", [right[(i * 2 + j) % 5] for j in range(12)]) for i in range(80)]
    model = fit(runs)
    assert (np.diag(model.step) > 1.5 * model.step[[0, 1], [1, 0]]).all()
    text = " ".join([*left, *left, "1", *right, *left])
    row = identify(make_docs([(1, text)]), model).first()
    assert row.lang_pred == "l" and 0.6 < row.score < 0.9
    assert [(s.lang, s.start, s.length) for s in row.spans] == [("l", 0, 10), ("r", 10, 5), ("l", 15, 5)]


def test_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    rows = op4_conditional_random_field(spark, MEDIUM).collect()
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert len(rows) == 1000 and np.mean(held) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_edge_cases(make_docs, spark):
    docs = make_docs([(1, "le la"), (1, "le la"), (2, None), (3, ""), (4, "12 !!"), (None, "the"), (5, "é" * 5000)])
    named = docs.selectExpr("*", "CASE WHEN text LIKE 'l%' THEN 'fr' WHEN doc_id > 2 THEN 'en' END AS lang", "1 AS score")
    rows = identify(named, train(named)).collect()
    assert len(rows) == 7
    for r in rows:
        assert (r.lang_pred == "und" and r.score == 0 and r.spans == []) == (r.doc_id in (2, 3, 4))
    assert {r.lang_pred for r in identify(docs, train(named.filter("lang = 'xx'"))).collect()} == {"und"}
    assert identify(make_docs([]), train(named)).collect() == []
    assert isinstance(train(named), Model) and pa.types.is_struct(langid._SPAN)


def test_an_id_on_most_rows_counts_once(make_docs, monkeypatch):
    docs = make_docs([(7, "le la les")] * 3000 + [(i, "the of and") for i in range(100, 140)])
    named = docs.selectExpr("*", "IF(doc_id = 7, 'fr', 'en') AS lang")
    seen = []
    monkeypatch.setattr(langid, "fit", lambda runs: seen.append(runs))
    train(named)
    train(named.repartition(3))
    assert [lang for lang, _ in seen[0]].count("fr") == 1 and [lang for lang, _ in seen[0]].count("en") == 40
    assert seen[0] == seen[1]


def test_a_dirty_column_gives_a_bounded_model(spark, monkeypatch):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'some words here' AS text", "IF(id < 1000, CONCAT('x', id % 2), CONCAT('dirt', id)) AS lang")
    monkeypatch.setattr(langid, "LANGUAGES", 8)
    monkeypatch.setattr(langid, "ALL_TRAINING_DOCS", 160)
    model = train(docs)
    assert model.languages[-2:] == ["x0", "x1"] and len(model.languages) == 8
    seen = []
    monkeypatch.setattr(langid, "fit", lambda runs: seen.append(runs))
    train(docs)
    assert 6 <= len(seen[0]) < 300
