from __future__ import annotations

import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import compare
from clickledger.llm.oracle import ORACLE
from clickledger.llm.queries import QUERIES
from clickledger.llm.rules import (
    RULES, Rule, apply_rules, cascade, commonest_word, duplicate_lines, first_rejection, measure, ordered, repeated_words, word_chars,
)
from small import SMALL, make_docs  # noqa: F401

TEXTS = ["a b c a b c d", "x\nx\n \n\nx ", "", "é É\té\n\x0b", "a a a a", "one two", "q\x1cr \x85 s", "l\nl \nl\n\tl\nl"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    result = QUERIES[name](spark, SMALL)
    assert sorted(result.columns) == compare.column_names(connection, ORACLE[name])
    assert compare.spark_rows(result) == compare.oracle_rows(connection, ORACLE[name])


def plain_repeated(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


def plain_lines(text):
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(lines) - len(set(lines))


def test_counts_equal_plain_ones():
    texts = pa.array(TEXTS)
    assert repeated_words(texts).tolist() == [plain_repeated(t) for t in TEXTS]
    assert duplicate_lines(texts).tolist() == [plain_lines(t) for t in TEXTS]
    assert word_chars(texts).tolist() == [len("".join(re.findall(r"[^\x20\x09-\x0D]+", t))) for t in TEXTS]
    words = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in TEXTS]
    assert commonest_word(texts).tolist() == [max(map(w.count, w), default=0) for w in words]


def test_later_rules_see_only_survivors_and_order_never_changes_the_verdict():
    seen = []
    first = Rule("first", lambda t: np.array([x.startswith("a") for x in t.to_pylist()]))
    second = Rule("second", lambda t: seen.append(len(t)) or np.array([x == "" for x in t.to_pylist()]))
    texts = pa.array(TEXTS)
    assert (first_rejection(texts, [first, second]) < 2).tolist() == (first_rejection(texts, [second, first]) < 2).tolist()
    assert seen == [6, 8]


def test_order_is_rejection_per_cost(spark):
    measured = [("word_length", 2.0, 0.5), ("symbols", 1.0, 0.3), ("exclamations", 0.1, 0.0)]
    assert [r.name for r in ordered(RULES[:3], measured)] == ["symbols", "word_length", "exclamations"]
    found = measure(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert [x[0] for x in found] == [r.name for r in RULES] and all(s > 0 and 0 <= p <= 1 for _, s, p in found)


def test_edge_cases(make_docs):
    good = " ".join("word" + chr(97 + i % 10) + chr(97 + i // 10) for i in range(60))
    docs = make_docs([(1, None), (2, ""), (3, good), (3, good), (None, good + " ###" * 20)]).selectExpr("*", "1 AS kept")
    rows = {(r.doc_id, r.n_words, r.base_failed, r.rejected_by, r.kept) for r in apply_rules(docs).collect()}
    assert rows == {(1, 0, True, None, False), (2, 0, True, None, False), (3, 60, False, None, True), (None, 80, False, "symbols", False)}
    assert cascade(make_docs([]), list(RULES)).collect() == []
    assert all(s == 0 for _, s, _ in measure(make_docs([])))
