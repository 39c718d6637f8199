from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from clickledger.llm import importance
from clickledger.llm.importance import bucket_counts, crc_after, resample
from clickledger.llm.oracle import ORACLE
from clickledger.llm.queries import QUERIES
from compare import oracle_connection, oracle_rows, spark_rows
from small import SMALL, make_docs  # noqa: F401

BUCKETS = 500


def runs(text, width):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    return len(words), [b" ".join(words[i : i + k]) for k in range(1, width + 1) for i in range(len(words) - k + 1)]


def counted(texts, width):
    return Counter(zlib.crc32(f) % BUCKETS for t in texts for f in runs(t, width)[1])


def brute(docs, target, width, percent, least):
    s, t = counted([x for _, x in docs], width), counted(target, width)
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log(float(t[b] + 1) * (all_s + BUCKETS) / (float(s[b] + 1) * (all_t + BUCKETS))))

    rows, fit = [], []
    for number, (i, text) in enumerate(docs):
        n_words, found = runs(text, width)
        weight = sum(gain(zlib.crc32(f) % BUCKETS) for f in found) // len(found) if found else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n_words >= least:
                fit.append((-score, i, number))
        rows.append([i, len(found), weight, score, None])
    for place, (_, _, number) in enumerate(sorted(fit)[: percent * len(fit) // 100], 1):
        rows[number][4] = place
    return sorted(map(tuple, rows), key=repr)


DOCS = [
    (1, None), (2, ""), (3, " \n\t\n "), (4, "one"), (5, "One\ntwo\n\nTHREE one\ntwo"), (6, "é Ünï 9x-y\r\nz"),
    (7, "two\n" * 300 + "end"), (8, "w" * 5000 + " " + "ab " * 400), (None, "alpha beta gamma delta\nepsilon"),
    (9, "same text of five words\nhere"), (10, "same text of five words\nhere"), (11, "repeated"), (11, "repeated"),
    *[(100 + i, f"line {i % 7}\nshared passage of words\nalpha {'beta ' * (i % 5)}") for i in range(60)],
]
TARGET = ["shared passage of words", None, "alpha beta beta\ntwo", ""]


def test_equals_brute_force_with_runs_across_lines(make_docs, spark):
    docs = make_docs(DOCS).selectExpr("*", "1 AS rank", "'x' AS bucket", "2L AS row", "3 AS n", "4 AS at")
    target = spark.createDataFrame([(t,) for t in TARGET], "text STRING")
    for width in (1, 2, 3):
        got = sorted((tuple(r) for r in resample(docs, target, width, BUCKETS, 40, 2).collect()), key=repr)
        assert got == brute(DOCS, TARGET, width, 40, 2)


def test_counts_are_of_all_features(make_docs):
    got = {r.bucket: r.n for r in bucket_counts(make_docs(DOCS).select("text"), 3, BUCKETS).collect()}
    assert got == counted([t for _, t in DOCS], 3)


def test_empty_tables(make_docs, spark):
    nothing = spark.createDataFrame([], "text STRING")
    assert resample(make_docs([]), nothing, 2, BUCKETS).collect() == []
    some = make_docs(DOCS)
    got = sorted((tuple(r) for r in resample(some, nothing, 2, BUCKETS, 100, 1).collect()), key=repr)
    assert got == brute(DOCS, [], 2, 100, 1)


def test_places_run_through_all_ranges(spark):
    rows = spark.range(5000).selectExpr("id % 700 AS doc_id", "id % 13 AS score", "id AS row").repartition(7)
    got = [(r.place, -r.score, r.doc_id) for r in importance._ranked(rows).orderBy("place").collect()]
    assert [p for p, *_ in got] == list(range(1, 5001))
    assert [g[1:] for g in got] == sorted(g[1:] for g in got)


def test_crc_continues():
    words = [b"", b"a", b"abc" * 50, "é".encode(), *[bytes([65 + i]) * i for i in range(20)]]
    ends = np.cumsum([len(w) for w in words])
    data = np.frombuffer(b"".join(words), np.uint8)
    before = np.array([zlib.crc32(w) for w in words], np.uint32)
    got = crc_after(before, data, ends - np.array([len(w) for w in words]), ends)
    assert got.tolist() == [zlib.crc32(w + w) for w in words]
    assert len(importance.features(importance.words_of(pa.array([], pa.string())), 3)[0]) == 0


def test_query_equals_its_sql(spark):
    connection = oracle_connection(SMALL)
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    name = "op12_segment_resampling"
    assert spark_rows(QUERIES[name](spark, SMALL)) == oracle_rows(connection, ORACLE[name])
