from __future__ import annotations

import math

import numpy as np
import pytest

from clickledger.llm import ann
from clickledger.llm.ann import bounds, encode, nearest_neighbours, rotation

MEDIUM = "/root/testdata/sf0.01"


def brute(rows, every, k):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q in sorted(i for i in good if i % every == 0):
        near = sorted((float(np.sqrt(((v - good[q]) ** 2).sum())), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
        out += [(q, rank, i, d) for rank, (d, i) in enumerate(near[:k], 1)]
    return out


def collected(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def same(got, want):
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert [x[3] for x in got] == pytest.approx([x[3] for x in want], rel=1e-12, abs=1e-12)


def test_equals_brute_force_on_given_vectors(spark):
    table = spark.read.parquet(f"{MEDIUM}/embeddings.parquet")
    same(collected(nearest_neighbours(table, 10)), brute([(r.vec_id, r.embedding) for r in table.collect()], 10, 10))


def test_recall_on_spread_out_vectors_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(0)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(2000, 48)))]
    table = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>").repartition(5)
    got, want = collected(nearest_neighbours(table, 50)), brute(rows, 50, 10)
    hit = len({x[:1] + x[2:3] for x in got} & {x[:1] + x[2:3] for x in want})
    assert len(got) == len(want) and hit / len(want) > 0.99


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    vectors, queries, centre = rng.normal(size=(3000, 64)), rng.normal(size=(20, 64)), np.full(64, 0.1)
    estimate, least = bounds(*encode(vectors, centre), queries, centre)
    exact = ((vectors[:, None] - queries[None]) ** 2).sum(axis=2)
    assert abs((estimate - exact).mean()) < 0.5 and (least <= exact).mean() > 0.99
    assert (estimate - exact).std() < 0.2 * exact.mean()
    assert rotation(64) @ rotation(64).T == pytest.approx(np.eye(64), abs=1e-12)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [1.0, None]), (7, [inf, 1.0])]
    rows += [(8, []), (None, [1.0, 1.0]), (10, [3.0, 4.0, 5.0]), (20, [1.0, 0.0]), (30, [0.0] * 4)]
    table = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>").selectExpr("*", "1 AS score", "'x' AS code")
    same(collected(nearest_neighbours(table, 10, 3)), brute(rows, 10, 3))
    assert nearest_neighbours(table.limit(0)).collect() == []
    many = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)], "vec_id LONG, embedding ARRAY<DOUBLE>")
    assert collected(nearest_neighbours(many, 100, 3)) == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 3, 0.0)]
