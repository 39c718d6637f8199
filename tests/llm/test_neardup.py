from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from brute import near_components, shingles
from clickledger.llm import neardup
from clickledger.llm.neardup import near_duplicates, shingle_sets, signatures
from small import SMALL, make_docs  # noqa: F401


def result(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_equals_all_pairs_on_the_smallest_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert result(near_duplicates(docs, 4)) == near_components(texts, 4, 80)


def test_chains_groups_and_borderline_pairs(make_docs):
    rnd = random.Random(3)
    texts, base = {}, [f"w{rnd.randrange(10**6)}" for _ in range(120)]
    for i in range(60):  # a chain: each differs from the last, the ends are far apart
        base[(7 * i) % 120] = f"x{i}"
        texts[1000 - i] = " ".join(base)
    other = [f"v{rnd.randrange(10**6)}" for _ in range(60)]
    for i in range(200):  # copies with another ending, and exact ones
        texts[2000 + i] = " ".join([*other, f"end{i % 150}"])
    for i in range(100):  # pairs about the threshold
        a = [f"u{i}_{k}" for k in range(50)]
        texts[3000 + 2 * i] = " ".join(a)
        texts[3001 + 2 * i] = " ".join(a[: 50 - i % 14] + ["new"])
    for i in range(150):  # alike below the threshold, some linked to one another, not to the least
        text = [f"t{k}" for k in range(100)]
        for k in range(6):
            text[(17 * i + 15 * k) % 100] = f"s{i % 70}_{k}"
        texts[4000 + i] = " ".join([*text, f"e{i}"])
    got = result(near_duplicates(make_docs(texts.items()), 4))
    assert got == near_components(texts, 4, 80)


def test_chained_boilerplate_is_compared_by_bucket(make_docs, monkeypatch):
    """Windows of one long text: neighbours share bands, the ends of the cluster nothing."""
    rnd, seen = random.Random(8), []
    texts = {i: " ".join(f"w{k}" for k in range(at, at + 60)) for i, at in enumerate(rnd.sample(range(6000), 900))}
    across = neardup._links_across

    def spy(members, percent):
        seen.extend(r.bucketed for r in members.select("bucketed", "group").distinct().collect())
        return across(members, percent)

    monkeypatch.setattr(neardup, "_links_across", spy)
    monkeypatch.setattr(neardup, "TILE_ROWS", 4)
    assert result(near_duplicates(make_docs(texts.items()), 4)) == near_components(texts, 4, 80)
    assert True in seen


def test_edge_cases(make_docs, spark):
    docs = make_docs([(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "É"), (7, "é"), (None, "one two")])
    docs = docs.selectExpr("*", "'x' AS component_id", "1 AS kept", "text AS key")
    rows = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert rows == {
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False),
        (6, 1, 6, True), (7, 1, 7, True), (None, 1, None, True),
    }
    assert near_duplicates(make_docs([])).collect() == []


def test_signature_estimates_similarity():
    words = [f"w{i}" for i in range(1000)]
    a, b = shingle_sets(pa.array([" ".join(words[:900]), " ".join(words[100:])]), 1)
    sig = signatures([a, b], 1024)
    assert np.mean(sig[0] == sig[1]) == pytest.approx(0.8, abs=0.05)
    assert len(a) == len(shingles(" ".join(words[:900]), 1))


def test_signature_is_the_least_offer_of_each_slot():
    """Against the stored-permutation form of the same walk, without early stopping."""
    items = np.random.default_rng(1).integers(0, 2**63, 5).astype(np.uint64)
    whole = signatures([items], 16)[0]
    singles = np.stack([signatures([items[i : i + 1]], 16)[0] for i in range(5)])
    assert (singles >> np.uint64(40)).tolist() != [] and sorted(singles[0] >> np.uint64(40)) == list(range(16))
    assert (whole == singles.min(axis=0)).all()
