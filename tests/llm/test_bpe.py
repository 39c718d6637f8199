from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from clickledger.llm import bpe
from clickledger.llm.bpe import Block, decode, encode, ranks
from clickledger.llm.common import stage
from clickledger.llm.queries import op7_distinct_word_bpe
from small import SMALL, make_docs  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = "aZß09 \n\t.,!'sé×÷İẞ½ⅷ \u0085\x1c\x7f́日🙂%»"


@pytest.fixture(scope="module")
def whole():
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(PATH), special_tokens={})
    return lambda text: own.encode_ordinary(text or "")


def test_query_equals_the_library_on_the_smallest_documents(spark, whole):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op7_distinct_word_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = whole(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_odd_texts_over_many_blocks(make_docs, whole, monkeypatch):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(40))) for _ in range(1500)]
    texts += [None, "", " ", "\n\n  x", "a  \n", "a" * 3000, "same", "same"]
    docs = make_docs(enumerate(texts)).selectExpr("*", "1 AS ids", "2 AS block").repartition(4)
    docs = stage(docs, "docs")
    got = {r.doc_id: r for r in decode(encode(docs, PATH, public_tokenizers.PATTERN, 5), PATH).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert np.frombuffer(got[i].ids, "<u4").tolist() == whole(text), text
        assert bytes(got[i].decoded) == (text or "").encode()


def test_pre_tokens_equal_the_pattern():
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(ODD[:20]) for _ in range(rnd.randrange(30))) for _ in range(2000)]
    pattern = regex.compile(public_tokenizers.PATTERN)
    block = Block(pa.array(texts), pattern, 3)
    for text, a, b in zip(texts, block.bounds[:-1], block.bounds[1:]):
        assert [block.words[c].decode() for c in block.codes[a:b]] == pattern.findall(text)


def test_empty_table_and_repeated_rows(make_docs):
    assert encode(make_docs([]), PATH, public_tokenizers.PATTERN).collect() == []
    rows = encode(make_docs([(None, "a b"), (1, "a b"), (1, "a b")]), PATH, public_tokenizers.PATTERN).collect()
    assert len(rows) == 3 and len({bytes(r.ids) for r in rows}) == 1
    assert bpe.BLOCK_BYTES > 0


def test_another_order_on_the_second_read_is_right_or_raises(spark, tmp_path):
    """A source that gives other rows to a partition each time it is read, as a shuffled one may."""
    seen, rank_file = str(tmp_path / "seen"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = spark.range(0, 4000, numPartitions=2).selectExpr("id AS doc_id", "concat('word', id, ' and more ', id % 7) AS text")

    def other_order(batches):
        import os

        first = os.path.exists(seen)
        for batch in batches:
            yield batch.slice(1000) if first else batch.slice(0, 1000)
        open(seen, "w").close()

    moving = rows.coalesce(1).mapInArrow(other_order, "doc_id long, text string")
    try:
        encoded = encode(moving, rank_file, public_tokenizers.PATTERN, buckets=4).collect()
    except Exception as error:
        assert "changed between two reads" in str(error)
    else:
        known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(rank_file), special_tokens={})
        texts = {r.doc_id: r.text for r in rows.collect()}
        assert all(np.frombuffer(r.ids, "<u4").tolist() == known.encode_ordinary(texts[r.doc_id]) for r in encoded)
