from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest

from brute import near_components
from clickledger.llm import ngram_join as nj
from clickledger.llm.ngram_join import Trie, ngram_join, tree_links
from clickledger.llm.oracle import ORACLE
from clickledger.llm.queries import QUERIES
from compare import oracle_connection, oracle_rows, spark_rows
from small import SMALL, make_docs  # noqa: F401


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_equals_its_sql(spark):
    connection = oracle_connection(SMALL)
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    name = "op13_prefix_tree_join"
    assert spark_rows(QUERIES[name](spark, SMALL)) == oracle_rows(connection, ORACLE[name])


def chains(seed=3):
    rnd = random.Random(seed)
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
    return texts


@pytest.mark.parametrize("percent", [80, 85])
def test_chains_groups_and_borderline_pairs(make_docs, percent):
    texts = chains()
    assert result(ngram_join(make_docs(texts.items()).repartition(5), 4, percent)) == near_components(texts, 4, percent)


def test_groups_of_many_tiles(make_docs, spark, monkeypatch):
    monkeypatch.setattr(nj, "TILE_ROWS", 20)  # read on the driver
    texts = chains(4)
    assert result(ngram_join(make_docs(texts.items()), 4, 80)) == near_components(texts, 4, 80)


def test_edge_cases(make_docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "É"), (7, "é"), (None, "one two"), (8, "a b c d " * 9000)]
    rows += [(9, "A B C D " * 8000), (10, "x" * 100_000), (10, "x" * 100_000)]
    docs = make_docs(rows).selectExpr("*", "'x' AS component_id", "1 AS node", "text AS item", "true AS several", "2 AS bucket")
    got = sorted((tuple(r) for r in ngram_join(docs).collect()), key=repr)
    assert got == sorted(
        [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 7), (None, 1, None), (8, 4, 8), (9, 4, 8), (10, 1, 10), (10, 1, 10)],
        key=repr,
    )
    assert ngram_join(make_docs([])).collect() == []


def test_one_doc_id_with_several_texts_is_one_node(make_docs):
    a, b = " ".join(f"a{i}" for i in range(100)), " ".join(f"b{i}" for i in range(100))
    docs = make_docs([(7, a), (7, b), (3, a + " end"), (9, b + " end"), (9, b + " end"), (5, "alone here")])
    got = sorted(tuple(r) for r in ngram_join(docs, 4).collect())
    assert got == [(3, 98, 3), (5, 1, 5), (7, 97, 3), (7, 97, 3), (9, 98, 3), (9, 98, 3)]


def random_sets(rnd, n):
    base = [sorted(rnd.sample(range(400), rnd.randrange(1, 90))) for _ in range(n // 4)]
    out = []
    for _ in range(n):
        one = set(rnd.choice(base))
        for _ in range(rnd.randrange(4)):
            one ^= {rnd.randrange(400)}
        out.append(np.array(sorted(one or {1}), np.int64))
    return out


def test_tree_finds_all_alike():
    rnd = random.Random(1)
    for percent in (50, 85, 100):
        sets = random_sets(rnd, 80)
        sizes = np.array([len(s) + rnd.randrange(3) for s in sets])
        trie, mark = Trie(sets, sizes), np.zeros(400, np.int64)
        for x, probe in enumerate(sets):
            mark[probe] = 1
            got = sorted(trie.alike(probe, int(sizes[x]), mark, sizes, percent).tolist())
            mark[probe] = 0
            overlap = [len(np.intersect1d(probe, s)) for s in sets]
            assert got == [y for y, o in enumerate(overlap) if 100 * o >= percent * (sizes[x] + sizes[y] - o)]


def test_links_span_what_they_join():
    rows = pd.DataFrame({"node": [5, 6, 7, 8], "n": [2, 2, 2, 2], "items": [np.array([1, 2])] * 3 + [np.array([8, 9])]})
    rows["times"] = [np.array([3, 3])] * 3 + [np.array([2, 2])]
    both = rows.assign(indexed=True, probes=True)
    assert tree_links(both, 80) == [(5, 6), (5, 7)]
    assert tree_links(rows.assign(indexed=[False, False, True, True], probes=[True, True, False, False]), 80) == [(5, 7), (6, 7)]
    assert tree_links(rows.assign(indexed=False, probes=True), 80) == []
